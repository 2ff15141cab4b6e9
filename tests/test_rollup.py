"""Rollups kept per run against one pass over everything."""

import random
import shutil
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import at, audit, view
from logtally.operators import drilldown, metrics
from logtally.plans import rollup, series
from logtally.sources.store import Store

START = at("2026-01-01T00:00:00")


def made(seed, days, n, first_id=0, base=0):
    """Random rows of four accounts and three creatures over ``days`` days."""
    rng, rows = random.Random(seed), []
    actions = [
        "POKEMON_CATCH_ATTEMPT", "POKEMON_CATCH_FAIL", "POKEMON_CATCH_FAIL", "SAFARI_ENTER", "SAFARI_EXIT",
        "SAFARI_BAIT", "POKEMON_CATCH", "CREATE_USER",
    ]
    for i in range(n):
        time = START + timedelta(days=base, minutes=rng.randrange(days * 1440))
        if time.timetuple().tm_yday % 13 in (2, 3):  # days without any row
            continue
        detail = {
            "mapId": rng.choice(["s000", "s001", None]), "wildUid": f"w{rng.randrange(3)}",
            "reason": rng.choice(["flee", "break_out", None]), "rock": rng.random() < 0.3, "result": "stay",
        }
        account = rng.choice([None, 1, 2, 3, 4])
        rows.append((first_id + i, account, rng.choice(actions), time.isoformat(), detail))
    return rows


def append(store, spark, rows, kind="append"):
    run = store.new_run(kind)
    run.write_audit(audit(spark, rows))
    run.commit()


def facts(frame):
    return sorted(map(str, frame.collect()))


def check(store, source):
    v = store.audit_v().cache()
    whole = drilldown.rollups(v)
    whole = whole._replace(attempts=whole.attempts.cache(), visits=whole.visits.cache())
    for name, frame in series.all_series(whole).items():
        assert facts(series.all_series(source)[name]) == facts(frame), name
    assert facts(drilldown.drill_counts(source)) == facts(drilldown.drill_counts(whole))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_builds_read_new_runs_only(spark, store):
    """Old rows are gone from disk when the next run comes; kept apart for the check."""
    # Later runs: the next days, rows for days left behind already, newest days.
    runs = [made(1, 200, 400), made(2, 2, 40, 10_000, 200), made(3, 210, 20, 20_000), made(4, 5, 60, 30_000, 203)]
    every = Store(spark, store.root + "-whole")
    for rows in runs:
        append(store, spark, rows)
        append(every, spark, rows)
        source = rollup.refresh(store)
        if rows is not runs[1]:
            check(every, source)
        for run in store.committed():
            shutil.rmtree(store.path("audit", run.name), ignore_errors=True)
    assert facts(rollup.refresh(store).attempts) == facts(source.attempts)
    # Four builds, the folders of the last two are left.
    assert len(list(Path(store.root, "rollups", "built").iterdir())) == 2
    assert len(list(Path(store.root, "rollups", "sets").iterdir())) == 4


def test_forced_and_compacted_runs(spark, store):
    append(store, spark, made(1, 100, 120))
    rollup.refresh(store)
    changed = [(i, 4, a, t, d) for i, _, a, t, d in made(1, 100, 120)[:40]]
    append(store, spark, changed, "force")
    check(store, rollup.refresh(store))
    store.compact()
    known = rollup._newest(store)[1]
    source = rollup.refresh(store)
    assert rollup._newest(store)[1]["sets"] == known["sets"]  # nothing was read again
    append(store, spark, made(2, 10, 50, 5000, 98))
    check(store, rollup.refresh(store))
    append(store, spark, made(3, 10, 50, 6000, 98))
    store.compact()  # rows that no build has seen, inside a run that has others too
    check(store, rollup.refresh(store))
    assert source.spans.count() == 4


def test_many_sets_become_one(spark, store, monkeypatch):
    monkeypatch.setattr(rollup, "MERGE_SETS", 2)
    for i in range(4):
        append(store, spark, made(i, 40, 40, 1000 * i, 25 * i))
        source = rollup.refresh(store)
    assert len(rollup._newest(store)[1]["sets"]) <= 2
    check(store, source)


def test_empty_store_and_rows_without_time(spark, store):
    assert rollup.refresh(store).spans.count() == 0
    append(store, spark, [(1, 1, "POKEMON_CATCH_ATTEMPT", None, {"wildUid": "w"}), (2, 1, "SAFARI_ENTER", None, {})])
    check(store, rollup.refresh(store))


def test_only_one_of_two_refreshes_counts(spark, store, monkeypatch):
    append(store, spark, made(1, 3, 20))
    seen = rollup._newest(store)
    rollup.refresh(store)
    append(store, spark, made(2, 3, 20, 1000))
    rollup.refresh(store)
    monkeypatch.setattr(rollup, "_newest", lambda _: (seen[0], None))
    with pytest.raises(FileExistsError):
        rollup.refresh(store)


@pytest.mark.parametrize("seed", [1, 2])
def test_carried_ordinals_replace_older_rows(spark, seed):
    v = view(spark, made(seed, 60, 800))
    events = metrics.pairing_events(v).cache()
    border = F.lit(str((START + timedelta(days=40)).date())).cast("date")
    later = F.col("created_at_kst").cast("date") >= border
    whole = metrics.paired(events).where(later)
    state = metrics.carried(events.where(~later))
    assert facts(metrics.paired(events.where(later), state)) == facts(whole)
    # The state itself can be carried on from an earlier border.
    early = F.col("created_at_kst").cast("date") < F.lit("2026-01-15").cast("date")
    step = metrics.carried(events.where(~later & ~early), metrics.carried(events.where(early)))
    assert facts(step.pending) == facts(state.pending)
    assert facts(step.ordinals.where("attempts + fails > 0")) == facts(state.ordinals)
