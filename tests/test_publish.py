import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import line, ship
from logtally.operators import drilldown
from logtally.plans import checks, ingest, publish, series
from logtally.sources.store import Store

NOW = datetime(2026, 8, 22)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def fill(spark, store, tmp_path):
    lines = [
        line(i, "CREATE_USER", 100 + i, f"2026-08-{18 + i % 3}T01:00:00Z") for i in range(30)
    ]
    lines += [
        line(100 + i, "SAFARI_BAIT", None if i == 0 else 7, detail={"result": "stay"})
        for i in range(4)
    ]
    lines += [
        line(200, "SAFARI_ENTER", 7, "2026-08-18T01:00:00Z", detail={"mapId": "s001"}),
        line(201, "SAFARI_EXIT", 7, "2026-08-18T01:05:00Z", detail={"mapId": "s001"}),
        line(202, "POKEMON_CATCH_ATTEMPT", 7, "2026-08-18T01:02:00Z",
             detail={"mapId": "s001", "wildUid": "w", "rock": True}),
    ]
    ship(tmp_path / "archive", "2026-08-20", lines)
    ingest.load(spark, store, str(tmp_path / "archive"), NOW)


def array(folder, name):
    return json.loads(Path(folder, "series", f"{name}.json").read_text())


def test_publish_and_read_back(spark, store, tmp_path):
    out = str(tmp_path / "out")
    assert publish.current(spark, out) is None
    fill(spark, store, tmp_path)
    folder = publish.publish(store, out, NOW)
    assert publish.current(spark, out) == folder
    dau = array(folder, "dau")
    assert [r["d"] for r in dau] == ["2026-08-18", "2026-08-19", "2026-08-20"]
    assert list(dau[0]) == ["d", "dau", "new_users", "events"]
    assert sum(r["new_users"] for r in dau) == 30
    bait = array(folder, "bait_rock")[-1]
    assert bait["bait_n"] == 4 and bait["bait_share"] is None
    assert array(folder, "safari_session")[0]["dwell_median_min"] == 5.0
    assert array(folder, "catch_rate")[0]["catch_rate_rock"] == 1.0
    meta = array(folder, "meta")
    assert len(meta) == 1 and meta[0]["total_rows"] == 37 and meta[0]["master_sha"] == ""
    users = publish.read_details(spark, folder, "bait_rock", "2026-08-20").collect()
    assert sorted((r.category, r.account_id or 0, r["count"]) for r in users) == [
        ("bait", 0, 1), ("bait", 7, 3),
    ]
    details = publish.read_details(spark, folder, "dau", "2026-08-18")
    page = drilldown.drill_page(details, "dau", "active", "2026-08-18").collect()
    assert [(r.account_id, r["count"]) for r in page][:3] == [(7, 3), (100, 1), (103, 1)]
    explained = json.loads(Path(folder, "categories.json").read_text())
    assert {"metric": "catch_rate", "category": "fled", "series": ["fled"]} in explained
    assert not Path(folder, "staged").exists()


def test_failed_build_keeps_the_old_one(spark, store, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    fill(spark, store, tmp_path)
    first = publish.publish(store, out, NOW)
    broken = lambda shot: (_ for _ in ()).throw(publish.ContractError("no"))
    monkeypatch.setattr(publish, "_check_series", broken)
    with pytest.raises(publish.ContractError):
        publish.publish(store, out, NOW + timedelta(days=1))
    assert publish.current(spark, out) == first


def test_empty_store_publishes_empty_arrays(spark, store, tmp_path):
    ingest.load(spark, store, str(tmp_path / "nothing"), NOW)
    folder = publish.publish(store, str(tmp_path / "out"), NOW)
    assert [array(folder, n) for n in series.SERIES] == [[], [], [], []]
    assert array(folder, "meta")[0]["total_rows"] == 0


def test_meta_without_any_load(spark, store):
    dims = store.dims()
    row = series.meta(store.load_log(), store.audit(), dims.version, dims.pokemon).first()
    assert row.last_load_at is None and row.total_rows is None
    assert (row.master_sha, row.master_pokemon_rows) == ("", 0)


def test_contract_rules(spark, store, tmp_path):
    fill(spark, store, tmp_path)
    v = store.audit_v()
    source = drilldown.rollups(v)
    good = series.all_series(source)
    assert checks.series_contract(good).count() == 0
    counts = drilldown.drill_counts(source)
    assert checks.drill_invariants(good, counts).count() == 0

    bad = dict(good)
    bad["catch_rate"] = good["catch_rate"].withColumn("catch_rate", F.lit(float("inf")))
    bad["dau"] = good["dau"].union(good["dau"].where("d = '2026-08-18'"))
    found = {(r.metric, r.rule) for r in checks.series_contract(bad).collect()}
    assert found == {
        ("catch_rate", "not_finite:catch_rate"), ("dau", "days_not_contiguous"),
    }
    long = spark.sql(
        "SELECT explode(sequence(DATE'2026-01-01', DATE'2026-04-02')) AS d"
    ).selectExpr("d", "1L AS dau", "0L AS new_users", "1L AS events")
    assert [r.rule for r in checks.series_contract({"dau": long}).collect()] == ["too_many_days"]

    wrong = counts.withColumn(
        "count", F.when(F.col("category") == "rock", 9).otherwise(F.col("count"))
    ).where("category <> 'new' OR account_id <> 100")
    rules = {(r.category, r.rule) for r in checks.drill_invariants(good, wrong).collect()}
    assert ("new", "total") in rules and ("rock", "total") in rules
    doubled = counts.union(counts.where("category = 'active' AND account_id = 100"))
    rules = {(r.category, r.rule) for r in checks.drill_invariants(good, doubled).collect()}
    assert ("active", "account") in rules and ("active", "users") in rules

    row = "total_rows bigint, last_inserted bigint, last_files bigint, master_pokemon_rows bigint"
    negative = spark.createDataFrame([(1, -1, None, 0)], row)
    assert [r.rule for r in checks.meta_contract(negative).collect()] == ["negative:last_inserted"]
    assert [r.rule for r in checks.meta_contract(negative.where("false")).collect()] == ["row_count"]


def test_spoiled_preview_and_totals_are_found(spark):
    day = datetime(2026, 8, 20).date()
    rows = [("dau", "active", day, i, 20 - i) for i in range(1, 13)] + [("dau", "new", day, None, 2)]
    layout = "metric string, category string, d date, account_id int, count bigint"
    counts = spark.createDataFrame(rows, layout)
    preview, totals = drilldown.drill_preview(counts), drilldown.drill_totals(counts)

    def found(preview, totals):
        return {(r.category, r.rule, r.n) for r in checks.preview_invariants(counts, preview, totals).collect()}

    assert preview.count() == 10 and found(preview, totals) == set()
    assert found(preview.where("rank < 10"), totals) == {("active", "preview_missing", 1)}
    assert found(preview.union(preview.where("rank = 1")), totals) == {("active", "preview_extra", 1)}
    off = totals.withColumn("unidentified_records", F.col("unidentified_records") + 1)
    assert found(preview, off.where("category = 'new'")) == {
        ("active", "totals_missing", 1), ("new", "totals_missing", 1), ("new", "totals_extra", 1)
    }
