"""The streamed load against the daily one, and across restarts."""

from datetime import datetime

import pytest

from helpers import ids, line, ship
from logtally.plans import ingest, stream
from logtally.sources.store import Store

NOW = datetime(2026, 9, 1)


def facts(store):
    return sorted(str(r) for r in store.audit_v().drop("detail").collect())


def test_stream_equals_the_daily_load(spark, tmp_path):
    base = str(tmp_path / "archive")
    ship(base, "2026-08-20", [line(1), line(2, source="old"), line(3)])
    ship(base, "2026-08-21", [line(2, source="new"), line(4, account=None)])
    daily, streamed = Store(spark, str(tmp_path / "daily")), Store(spark, str(tmp_path / "streamed"))
    ingest.load(spark, daily, base, NOW)
    rows = stream.load_stream(spark, streamed, base, str(tmp_path / "progress"), NOW)
    assert facts(streamed) == facts(daily)
    assert [(r["rows_inserted"], r["total_rows"], r["files_scanned"], r["max_id"]) for r in rows] == [(4, 4, 2, 4)]
    assert str(rows[0]["scanned_from"]) == "2026-08-20"
    paths = {r.path for r in streamed.loaded_objects().collect()}
    assert paths == {r.path for r in daily.loaded_objects().collect()}


def test_restarts_read_new_objects_only(spark, tmp_path, monkeypatch):
    base, progress = str(tmp_path / "archive"), str(tmp_path / "progress")
    store = Store(spark, str(tmp_path / "store"))

    def load():
        return [r["rows_inserted"] for r in stream.load_stream(spark, store, base, progress, NOW, 1)]

    ship(base, "2026-08-20", [line(1)])
    ship(base, "2026-08-21", [line(2)])
    assert load() == [1, 1] and load() == []
    ship(base, "2026-08-22", [line(2, source="again"), line(3)])

    # The batch commits and then fails: it runs again and finds its ids known.
    whole = stream._load_batch

    def failing(*args):
        whole(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(stream, "_load_batch", failing)
    with pytest.raises(Exception, match="lost"):
        load()
    monkeypatch.setattr(stream, "_load_batch", whole)
    assert load() == [0]
    assert ids(store.audit_v()) == [1, 2, 3]
    assert [r.rows_inserted for r in store.log_rows()] == [1, 1, 1, 0]
    assert {r.source for r in store.audit().collect()} == {"api"}
