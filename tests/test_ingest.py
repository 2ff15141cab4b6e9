"""The load against archives on disk: increments, failures, repairs."""

import gzip
from datetime import date, datetime, timedelta

import pytest

from helpers import ids, line, ship
from logtally.plans import checks, ingest, recipes, reconcile
from logtally.sources import archive, files
from logtally.sources.store import Store

NOW = datetime(2026, 8, 22, 0, 30)
DAY = "2026-08-20"


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "archive")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def load(spark, store, base, now=NOW, **options):
    return ingest.load(spark, store, base, now, **options)


def test_repeat_load_reads_nothing(spark, store, base):
    ship(base, DAY, [line(1), line(2)])
    first = load(spark, store, base)
    assert (first.files_scanned, first.rows_inserted, first.total_rows, first.max_id) == (1, 2, 2, 2)
    again = load(spark, store, base, NOW + timedelta(days=1))
    assert (again.files_scanned, again.rows_inserted, again.total_rows) == (0, 0, 2)
    assert store.load_log().count() == 2 and ids(store.audit()) == [1, 2]


def test_overlapping_batches_and_their_winner(spark, store, base):
    ship(base, DAY, [line(i) for i in range(1, 6)])
    ship(base, "2026-08-21", [line(4, action="LATE"), line(5, action="LATE"), line(6)])
    assert load(spark, store, base).rows_inserted == 6
    late = store.audit().where("action = 'LATE'")
    assert ids(late) == [4, 5]
    ship(base, "2026-08-22", [line(6, action="TOO_LATE"), line(7)])
    assert load(spark, store, base).rows_inserted == 1
    assert store.audit().where("action = 'TOO_LATE'").count() == 0


def test_forced_load_replaces_and_counts_nothing(spark, store, base):
    path = ship(base, DAY, [line(1), line(2), line(3)])
    load(spark, store, base)
    ship(base, DAY, [line(1), line(2, action="LOGIN_LOCAL")], name=path.name)
    assert load(spark, store, base).files_scanned == 0  # objects are taken as final
    forced = load(spark, store, base, force=True)
    assert (forced.files_scanned, forced.rows_inserted, forced.total_rows) == (1, 0, 3)
    got = {r.id: r.action for r in store.audit().collect()}
    assert got == {1: "CREATE_USER", 2: "LOGIN_LOCAL", 3: "CREATE_USER"}
    ship(base, "2026-08-21", [line(2, action="OLD"), line(9)])
    assert load(spark, store, base).rows_inserted == 1
    store.compact()
    got = {r.id: r.action for r in store.audit().collect()}
    assert got == {1: "CREATE_USER", 2: "LOGIN_LOCAL", 3: "CREATE_USER", 9: "CREATE_USER"}
    assert load(spark, store, base).files_scanned == 0  # history outlives compaction


def test_bad_line_leaves_no_trace_and_retry_works(spark, store, base):
    ship(base, DAY, [line(1)])
    load(spark, store, base)
    path = ship(base, "2026-08-21", [line(2)], tail="not valid json\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        load(spark, store, base)
    assert ids(store.audit()) == [1] and store.load_log().count() == 1
    assert store.loaded_objects().count() == 1
    ship(base, "2026-08-21", [line(2)], name=path.name)
    assert load(spark, store, base).rows_inserted == 1


def test_line_without_id_fails_the_load(spark, store, base):
    ship(base, DAY, [line(1)], tail='{"action": "X"}\n')
    with pytest.raises(Exception, match="without id"):
        load(spark, store, base)
    assert store.last_number() == 0


def test_failure_before_commit_shows_nothing(spark, store, base, monkeypatch):
    ship(base, DAY, [line(1)])
    load(spark, store, base)
    ship(base, "2026-08-21", [line(2)])
    with monkeypatch.context() as broken:
        broken.setattr(files, "create", lambda *a: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            load(spark, store, base)
    assert ids(store.audit()) == [1] and store.loaded_objects().count() == 1
    load(spark, store, base)
    assert ids(store.audit()) == [1, 2]


def test_second_writer_cannot_take_the_same_commit(spark, store, base):
    ship(base, DAY, [line(1)])
    load(spark, store, base)
    with pytest.raises(FileExistsError):
        files.create(spark, f"{store.root}/commits/{1:012d}.json", "{}")


def test_long_outage_widens_the_window(spark, store, base):
    ship(base, "2026-07-20", [line(1)])
    load(spark, store, base, datetime(2026, 7, 21))
    ship(base, "2026-08-01", [line(2)])  # 21 days before the next run
    row = load(spark, store, base)
    assert row.scanned_from == date(2026, 7, 14) and row.rows_inserted == 1
    ship(base, "2026-08-02", [line(3)])
    assert load(spark, store, base).rows_inserted == 0  # now out of the window
    assert load(spark, store, base, force=True).files_scanned == 0


def test_scan_window():
    day = datetime(2026, 8, 22)
    assert ingest.scan_from(0, day, day) == date(2026, 1, 1)
    assert ingest.scan_from(5, None, day) == date(2026, 1, 1)
    assert ingest.scan_from(5, day, day) == date(2026, 8, 15)
    assert ingest.scan_from(5, day - timedelta(days=30), day) == date(2026, 7, 16)


def test_empty_archive_is_logged(spark, store, base):
    row = load(spark, store, base)
    assert (row.files_scanned, row.total_rows, row.max_id) == (0, 0, None)
    assert store.audit().count() == 0 and store.load_log().count() == 1


def test_stored_rows(spark, store, base):
    odd = [
        line(1, user_agent=""), line(2, user_agent=None),
        line(3, detail="plain"), line(4, detail=[1, 2]), line(5, detail=None),
        line(6, created="never"), line(7, created="2026-08-20T23:30:00.5+00:00", status=404),
        line(8, detail='{"mapId": "x"}'),
    ]
    ship(base, "2026-08-21", odd)
    load(spark, store, base)
    got = {r.id: r for r in store.audit_v().collect()}
    assert len(got) == 8 and "ip" not in store.audit_v().columns
    assert got[1].user_agent == "" and got[2].user_agent is None
    assert got[5].detail is None and got[3].detail is not None
    assert got[6].created_at is None and got[7].status == 404
    assert got[8].map_id is None  # a string that looks like an object is a string
    assert got[7].created_at_kst == datetime(2026, 8, 21, 8, 30, 0, 500000)
    one_day = store.audit_v(days=("2026-08-21", "2026-08-21"))
    assert ids(one_day) == [7]
    shape = store.source_shape().first()
    assert "ip" in shape["columns"] and shape["columns"] == sorted(shape["columns"])


def test_frozen_store_sees_one_version(spark, store, base):
    ship(base, DAY, [line(1)])
    load(spark, store, base)
    frozen = store.snapshot()
    ship(base, "2026-08-21", [line(2)])
    load(spark, store, base)
    assert ids(frozen.audit()) == [1] and ids(store.audit()) == [1, 2]
    assert frozen.load_log().count() == 1


def test_listing_parses_paths(spark, base):
    ship(base, DAY, [line(41)])
    ship(base, DAY, [line(1)], name="audit-odd.jsonl.gz")
    ship(base, "2026-13-45", [line(1)])
    ship(base, DAY, [line(1)], name="notes.txt")
    got = archive.list_objects(spark, base).collect()
    assert sorted((str(r.batch_date), r.cutoff_id or 0) for r in got) == [(DAY, 0), (DAY, 41)]


def dims(base, sha, pokemon, item):
    from pathlib import Path

    folder = Path(base) / "master" / f"v={sha}"
    folder.mkdir(parents=True)
    (folder / "pokemon.csv").write_bytes(pokemon.encode())
    (folder / "item.csv").write_bytes(item.encode())
    (folder.parent / "LATEST").write_text(sha + "\n")


def test_dimensions_arrive_and_stay(spark, store, base, tmp_path):
    assert ingest.load_dims(spark, store, base, NOW) is False
    assert store.dims().pokemon.count() == 0 and len(store.dims().pokemon.columns) == 12
    dims(
        base, "abc",
        'id,comment,tier\r\n1,"a, ""b""",S\r\n0058_hisui,c,A',
        "id,buy,purchasable\r\nball,10,TRUE",
    )
    assert ingest.load_dims(spark, store, base, NOW)
    got = store.dims()
    assert {r.id: (r.comment, r.tier) for r in got.pokemon.collect()} == {
        "1": ('a, "b"', "S"), "0058_hisui": ("c", "A"),
    }
    assert got.version.first().sha == "abc"
    assert ingest.load_dims(spark, store, str(tmp_path / "gone"), NOW) is False
    assert store.dims().pokemon.count() == 2


def test_reconcile_finds_lost_rows_and_source_gaps(spark, store, base):
    ship(base, DAY, [line(i) for i in range(1, 21)])
    load(spark, store, base)
    archived = lambda: reconcile.archived_ids(spark, base, NOW)
    assert reconcile.reconcile(archived(), store.audit()).count() == 0
    lossy = store.audit().where("id not in (3, 4, 19)")
    got = reconcile.reconcile(archived(), lossy).collect()
    assert [(r.kind, r.from_id, r.to_id, r.n) for r in got] == [("missing", 3, 19, 3)]
    ship(base, "2026-08-21", [line(50_020), line(50_021)])
    load(spark, store, base)
    got = reconcile.reconcile(archived(), store.audit()).collect()
    assert [(r.kind, r.from_id, r.to_id) for r in got] == [("gap", 20, 50_020)]
    nothing = reconcile.archived_ids(spark, base, NOW + timedelta(days=90))
    assert reconcile.reconcile(nothing, store.audit()).count() == 0


def test_assertions_and_drift_on_a_loaded_store(spark, store, base):
    from logtally.operators.dimensions import pokemon_dim

    ship(
        base, "2026-08-21",
        [
            line(1, "POKEMON_CATCH", detail={"pokedexId": "9999"}),
            line(2, "REQUEST_REJECTED", detail={"url": "/a?b"}),
            line(3, "LOGIN_FAILED", account=None, detail={"body": {"username": "me"}}),
            line(50_003),
        ],
    )
    load(spark, store, base)

    def found():
        dim = pokemon_dim(store.dims().pokemon)
        out = checks.assertions(spark, store.audit(), store.audit_v(), dim, NOW)
        return [(r.check_name, r.detail) for r in out.collect()]

    assert found() == [("gap", "3→50003")]  # no dimension yet, so no orphans
    dims(base, "abc", "id,comment,tier,type1,type2,generation,growth_group,rate_capture,"
         "rate_flee,height_m,weight_kg,base_exp\r\n1,a,S,,,,,,,,,", "id\r\nball")
    ingest.load_dims(spark, store, base, NOW)
    assert found() == [("gap", "3→50003"), ("orphan_pokedex", "9999")]
    drift = checks.contract_drift(
        store.audit(), store.source_shape(), store.dims().pokemon, store.dims().version, NOW
    )
    actual = [r.actual for r in drift.collect()]
    assert actual[0] == "yes" and actual[1].startswith("[account_id, action")
    assert actual[2:] == ["yes: 1 rows", "yes: 1 rows", "yes: 1 rows", "no", "no"]
    bare = checks.contract_drift(
        store.audit().where("false"), store.source_shape().where("false"),
        store.dims().pokemon.where("false"), store.dims().version.where("false"), NOW,
    )
    assert [r.actual for r in bare.collect()] == ["no", "(no sample)", *["no"] * 5]


def test_daily_run_loads_and_checks(spark, store, base):
    row, found = ingest.daily(spark, store, base, NOW)
    assert row.files_scanned == 0 and found.count() == 0
    ship(base, "2026-08-21", [line(1), line(2), line(5_000, created="2026-08-21T00:00:00Z")])
    row, found = ingest.daily(spark, store, base, NOW)
    assert row.rows_inserted == 3
    assert [tuple(r) for r in found.collect()] == [("gap", "2→5000")]


def test_doubled_ids_are_found_after_later_loads(spark, store, base):
    ship(base, DAY, [line(1), line(2)])
    load(spark, store, base)
    twice = store.new_run("append")
    twice.write_audit(store.audit().where("id = 1"))
    twice.commit()
    ship(base, "2026-08-22", [line(900)])
    _, found = ingest.daily(spark, store, base, NOW)
    assert ("dup", "1") in [tuple(r) for r in found.collect()]


def test_overlapping_runs_cannot_both_commit(spark, store, base):
    ship(base, DAY, [line(1), line(2)])
    load(spark, store, base)
    first, second = store.new_run("append"), store.new_run("compact")
    for run, number in ((first, 3), (second, 4)):
        run.write_audit(store.audit().where("id = 1").selectExpr(f"{number} AS id", "* EXCEPT (id)"))
    first.commit()
    with pytest.raises(FileExistsError):
        second.commit()
    assert ids(store.audit_v()) == [1, 2, 3]


def test_scans_do_not_grow_with_forced_loads(spark, store, base):
    ship(base, DAY, [line(1), line(2)])
    scans = []
    for _ in range(4):
        ingest.load(spark, store, base, NOW, force=True)
        plan = store.audit_v()._jdf.queryExecution().optimizedPlan().toString()
        scans.append(plan.count("Relation ["))
        assert ids(store.audit_v()) == [1, 2]
    assert len(set(scans[1:])) == 1 and scans[-1] <= 2


def test_schema_checks(spark):
    from helpers import audit

    fact = audit(spark, [(1, 1, "X", None, None)])
    assert checks.ip_column(spark, fact).count() == 0
    leaky = fact.selectExpr("*", "'x' AS IP", "'y' AS body_username")
    assert [r.detail for r in checks.ip_column(spark, leaky).collect()] == ["IP"]
    assert [r.detail for r in checks.username_column(spark, leaky).collect()] == ["body_username"]


def test_funnel_on_loaded_rows(spark, store, base):
    ship(
        base, DAY,
        [line(1, "LOGIN_OAUTH", 1), line(2, "CREATE_USER", 1), line(3, "POKEMON_CATCH", 2),
         line(4, "CREATE_USER", None)],
    )
    load(spark, store, base)
    row = recipes.funnel(store.audit_v(), NOW).first()
    assert (row.signup, row.avatar, row.first_catch) == (1, 2, 1)


def test_gzip_fixture_is_gzip(base):
    path = ship(base, DAY, [line(1)])
    assert gzip.open(path, "rt").read().count("\n") == 1


def test_objects_with_known_ids_only_add_nothing(spark, tmp_path):
    store, archive_ = Store(spark, str(tmp_path / "store")), str(tmp_path / "archive")
    ship(archive_, "2026-08-20", [line(1), line(2)])
    ingest.load(spark, store, archive_, datetime(2026, 8, 21))
    ship(archive_, "2026-08-21", [line(1, source="again"), line(2)])
    row = ingest.load(spark, store, archive_, datetime(2026, 8, 22))
    assert (row.rows_inserted, row.total_rows, row.files_scanned) == (0, 2, 1)
    assert {r.source for r in store.audit().collect()} == {"api"}
    assert ids(store.audit_v()) == [1, 2]


def test_forced_rows_replace_rows_in_their_range_only(spark, tmp_path):
    store, archive_ = Store(spark, str(tmp_path / "store")), str(tmp_path / "archive")
    ship(archive_, "2026-08-20", [line(i) for i in range(1, 60)])
    ingest.load(spark, store, archive_, datetime(2026, 8, 21))
    ship(archive_, "2026-08-25", [line(i, source="new") for i in (10, 20, 30)])
    ingest.load(spark, store, archive_, datetime(2026, 9, 1), force=True)
    found = {r.id: r.source for r in store.audit().collect()}
    assert sorted(found) == list(range(1, 60))
    assert {i for i, s in found.items() if s == "new"} == {10, 20, 30}
