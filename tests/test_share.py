import hashlib
import hmac
from datetime import date

import pytest
from pyspark.sql import functions as F

from logtally.plans import share

SALT = "0123456789abcdef"
LAYOUT = "metric string, category string, d date, account_id int, count bigint"


def counts(spark):
    day = date(2026, 8, 20)
    rows = [("dau", "active", day, i, i) for i in range(1, 40)] + [("bait_rock", "bait", day, None, 3)]
    return spark.createDataFrame(rows, LAYOUT)


def test_pseudonyms_are_keyed_hashes(spark):
    got = {r["count"]: r.pseudonym for r in share.shared(counts(spark), SALT).where("metric = 'dau'").collect()}
    for account, name in got.items():
        assert name == hmac.new(SALT.encode(), str(account).encode(), hashlib.sha256).hexdigest()[:32]
    for salt in ("short", "x" * 65):
        with pytest.raises(ValueError):
            share.shared(counts(spark), salt)


def test_copy_is_checked_written_and_read(spark, tmp_path):
    folder = share.publish(spark, counts(spark), str(tmp_path), SALT, "2026-08-21")
    back = share.read(spark, folder)
    assert back.columns == list(share.COLUMNS) and back.count() == 40
    assert back.where("pseudonym IS NULL").count() == 1
    plain = {str(i) for i in range(1, 40)}
    assert not plain & {r.pseudonym for r in back.collect()}
    text = "".join(p.read_text() for p in tmp_path.rglob("part-*.json"))
    assert "account" not in text and SALT not in text


def test_same_salt_joins_and_another_does_not(spark):
    one, two = share.shared(counts(spark), SALT), share.shared(counts(spark), SALT)
    other = share.shared(counts(spark), SALT[::-1])
    assert one.join(two, "pseudonym").count() == 39
    assert one.join(other, "pseudonym").count() == 0


def test_plain_ids_and_extra_columns_are_refused(spark, tmp_path, monkeypatch):
    sound = share.shared(counts(spark), SALT)
    assert share.leaks(sound).count() == 0
    plain = sound.withColumn("pseudonym", F.col("count").cast("string"))
    assert {(r.rule, r.metric, r.n) for r in share.leaks(plain).collect()} == {
        ("no pseudonym", "bait_rock", 1), ("no pseudonym", "dau", 39),
    }
    assert [r.rule for r in share.leaks(sound.withColumn("account_id", F.lit(1))).collect()] == ["column account_id"]
    monkeypatch.setattr(share, "shared", lambda c, salt: c.withColumn("pseudonym", F.col("account_id").cast("string")))
    with pytest.raises(share.LeakError):
        share.publish(spark, counts(spark), str(tmp_path), SALT, "2026-08-21")
    assert not (tmp_path / "commits").exists()
