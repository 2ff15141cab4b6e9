"""Rollups kept per run, so that a build reads no fact row it has read before.

    <root>/rollups/sets/<name>/<part>/     what one or more runs add, in order of days
    <root>/rollups/states/<name>/          pairing state at a day border
    <root>/rollups/built/<name>/<part>/    the last 90 days, all sets together
    <root>/rollups/records/<number>.json   which of them belong to a commit

A refresh reads the rows of runs it has not seen, writes their set, and builds
the published days from all sets:

    activity  counts per (day, account); counts of sets add up
    pairing   attempts and failures, narrow; paired from a day border on, with
              the ordinals of everything before it carried along
    moves     entries and exits, narrow; an entry looks ahead only, so those of
              the published days need nothing older

The border moves with the newest attempt; its state is brought forward by the
days it passes. Rows that arrive for days before the border make the state anew
from the sets. Forced runs replace rows that sets have counted already: then one
set is made of the whole table, as at the first refresh.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from logtally.functions.values import kst_day
from logtally.operators import metrics
from logtally.operators.drilldown import Rollups
from logtally.operators.metrics import BY_ACCOUNT, Carried
from logtally.plans.jobs import together
from logtally.schema import SERIES_DAYS
from logtally.sources import files
from logtally.sources.store import Run, Store

MERGE_SETS = 30  # more sets than this become one, read from the sets themselves
PARTS = ("activity", "pairing", "moves")
_BUILT = ("activity", "attempts", "sessions", "visits")

Days = list[str] | None  # first and last, ISO


def _root(store: Store) -> str:
    return f"{store.root}/rollups"


def _records(store: Store) -> str:
    return f"{_root(store)}/records"


def _record(store: Store, number: int) -> dict:
    return json.loads(files.read_text(store.spark, f"{_records(store)}/{number:012d}.json"))


def _newest(store: Store) -> tuple[int, dict | None]:
    number = files.last_number(store.spark, _records(store))
    return number, _record(store, number) if number else None


def refresh(store: Store) -> Rollups:
    """The rollups of the store's newest commit, built from what is new in it.

    Of two refreshes at the same time one fails with ``FileExistsError``.
    """
    return refreshed(store)[0]


def refreshed(store: Store) -> tuple[Rollups, Store]:
    """As ``refresh``, with the store frozen at the commit they belong to."""
    fixed = store.snapshot()
    number, known = _newest(store)
    if known is None or known["commit"] != fixed.at:
        known = _next_record(fixed, known)
        files.create(store.spark, f"{_records(store)}/{number + 1:012d}.json", json.dumps(known))
        _sweep(store, number + 1)
    return _read(store, known), fixed


def _sweep(store: Store, number: int) -> None:
    """Remove what only the record before the last one has: readers of that are done."""
    if number < 3:
        return

    def folders(record: dict) -> set[str]:
        state = {f"states/{record['state']}"} if record["state"] else set()
        return {f"built/{record['built']['name']}", *state, *[f"sets/{s['name']}" for s in record["sets"]]}

    kept = folders(_record(store, number)) | folders(_record(store, number - 1))
    for folder in folders(_record(store, number - 2)) - kept:
        files.remove(store.spark, f"{_root(store)}/{folder}")


def _next_record(store: Store, known: dict | None) -> dict:
    runs = [r for r in store.committed() if r.min_id is not None]
    seen = set(known["runs"]) if known else set()
    fresh = _unseen(runs, seen)
    whole = known is None or fresh is None
    sets = [] if whole else list(known["sets"])
    if whole:
        sets.append(_write_set(store, _parts_of(store.audit_v())))
    elif fresh:
        sets.append(_write_set(store, _parts_of(_rows_of(store, fresh))))
    added = sets[-1]["days"] if whole or fresh else {}
    if len(sets) > MERGE_SETS:
        sets = [_write_set(store, {p: _part(store, sets, p) for p in PARTS})]
    days = {name: _span([s["days"][name] for s in sets]) for name in _DAYS}
    record = {
        "commit": store.at,
        "runs": [r.name for r in runs],
        "sets": sets,
        "days": days,
        **_state(store, sets, days, None if whole else known, added.get("pairing")),
    }
    return record | {"built": _build(store, record)}


def _unseen(runs: list[Run], seen: set[str]) -> list[Run] | None:
    """Runs whose rows no set has; None if their rows can't just be added."""
    fresh, complete = [], True
    for run in runs:
        if run.name in seen:
            continue
        if run.kind == "compact" and complete:
            continue  # the rows of the runs before it
        if run.kind != "append" or "audit" not in run.parts:
            return None
        fresh.append(run)
        complete = False
    return fresh


# --- sets -------------------------------------------------------------------


def _rows_of(store: Store, runs: list[Run]) -> DataFrame:
    layout = Store(store.spark, store.root, 0).audit_v().schema  # of no commit: opens nothing
    return store.spark.read.schema(layout).parquet(*[store.path("audit", r.name) for r in runs])


def _parts_of(v: DataFrame) -> dict[str, DataFrame]:
    day = kst_day().alias("d_kst")
    return {
        "activity": metrics.activity_by_account(v),
        "pairing": metrics.pairing_events(v).select("*", day),
        "moves": metrics.moves(v).select("*", day),
    }


_DAYS = {
    "activity": ("activity", "true"),
    "known": ("activity", "account_id IS NOT NULL"),
    "pairing": ("pairing", "true"),
    "attempts": ("pairing", "action = 'POKEMON_CATCH_ATTEMPT' AND NOT map_id <=> 's000'"),
    "entries": ("moves", "action = 'SAFARI_ENTER'"),
}


def _write_set(store: Store, parts: dict[str, DataFrame]) -> dict:
    """Put a set down; its record tells the days it has, by kind of row."""
    name = uuid.uuid4().hex
    folder = f"{_root(store)}/sets/{name}"

    def put(part: str, rows: DataFrame) -> dict:
        path = f"{folder}/{part}"
        rows.hint("rebalance", "d_kst").sortWithinPartitions("d_kst").write.parquet(path)
        kinds = {n: F.expr(f"CASE WHEN {rule} THEN d_kst END") for n, (p, rule) in _DAYS.items() if p == part}
        written = store.spark.read.schema(rows.schema).parquet(path)
        ends = [f(day).cast("string").alias(f"{n}_{f.__name__}") for n, day in kinds.items() for f in (F.min, F.max)]
        found = written.agg(*ends).first()
        return {n: [found[f"{n}_min"], found[f"{n}_max"]] if found[f"{n}_min"] else None for n in kinds}

    spans = together(store.spark, *[lambda p=p, r=r: put(p, r) for p, r in parts.items()])
    layouts = {p: r.schema.jsonValue() for p, r in parts.items()}
    return {"name": name, "days": {n: d for found in spans for n, d in found.items()}, "layouts": layouts}


def _part(store: Store, sets: list[dict], part: str, since: date | None = None) -> DataFrame:
    """One part of all sets, from the day ``since`` on and of unknown days.

    Rows lie in order of days, so Parquet skips the older ones.
    """
    paths = [f"{_root(store)}/sets/{s['name']}/{part}" for s in sets]
    layout = _layout(sets[-1]["layouts"][part])
    rows = store.spark.read.schema(layout).parquet(*paths)
    if since is not None:
        rows = rows.where(f"d_kst >= DATE'{since}' OR d_kst IS NULL")
    if part != "activity":
        return rows
    counts = [c for c in rows.columns if c not in BY_ACCOUNT]
    return rows.groupBy(*BY_ACCOUNT).agg(*[F.sum(c).alias(c) for c in counts])


def _layout(value: dict) -> StructType:
    return StructType.fromJson(value)


def _span(found: list[Days]) -> Days:
    known = [d for d in found if d]
    return [min(d[0] for d in known), max(d[1] for d in known)] if known else None


# --- pairing state -----------------------------------------------------------


def _first_published(days: Days) -> date | None:
    return date.fromisoformat(days[1]) - timedelta(days=SERIES_DAYS - 1) if days else None


def _state(store: Store, sets: list[dict], days: dict, known: dict | None, added: Days) -> dict:
    """Border and name of the state of all pairing events before it."""
    border = _first_published(days["attempts"])
    if border is None or days["pairing"][0] >= str(border):
        return {"border": border and str(border), "state": None}
    old = known and known["border"]
    if old == str(border) and not (added and added[0] < old):
        return {"border": old, "state": known["state"]}
    before = f"d_kst < DATE'{border}'"
    if old is None or old > str(border) or (added and added[0] < old):
        state = metrics.carried(_part(store, sets, "pairing").where(before).drop("d_kst"))
    else:
        passed = _part(store, sets, "pairing").where(f"d_kst >= DATE'{old}' AND {before}").drop("d_kst")
        state = metrics.carried(passed, _carried(store, known["state"]))
    name = uuid.uuid4().hex
    for part, rows in state._asdict().items():
        rows.write.parquet(f"{_root(store)}/states/{name}/{part}")
    return {"border": str(border), "state": name}


def _carried(store: Store, name: str | None) -> Carried | None:
    if name is None:
        return None
    read = store.spark.read.parquet
    return Carried(*[read(f"{_root(store)}/states/{name}/{p}") for p in Carried._fields])


# --- published days ----------------------------------------------------------


def _build(store: Store, record: dict) -> dict:
    """Write the rollups of the published days; returns name and layouts."""
    spark, sets, days = store.spark, record["sets"], record["days"]
    name = uuid.uuid4().hex
    firsts = {n: _first_published(days[n]) for n in ("activity", "known", "attempts", "entries")}

    def put(part: str, rows: DataFrame) -> dict:
        rows.write.parquet(f"{_root(store)}/built/{name}/{part}")
        return rows.schema.jsonValue()

    def activity() -> dict:
        # Also for the observed catches beside the attempts.
        since = min((firsts[n] for n in ("activity", "known", "attempts") if firsts[n]), default=None)
        rows = _part(store, sets, "activity", since)
        older = days["known"] and since and days["known"][0] < str(since)
        # The eve has a known account (none's id) where days of known accounts go back.
        rows = _from_before(rows, since, days["activity"], -1 if older else None)
        return {"activity": put("activity", rows)}

    def attempts() -> dict:
        events = _part(store, sets, "pairing", firsts["attempts"]).drop("d_kst")
        state = _carried(store, record["state"])
        rows = metrics.attempts_by_account(metrics.paired(events, state))
        return {"attempts": put("attempts", _from_before(rows, firsts["attempts"], days["attempts"], None))}

    def sessions() -> dict:
        moves = _part(store, sets, "moves", firsts["entries"]).drop("d_kst")
        layouts = {"visits": put("visits", metrics.sessions_of(moves))}
        visits = spark.read.schema(_layout(layouts["visits"])).parquet(f"{_root(store)}/built/{name}/visits")
        rows = metrics.sessions_by_account(visits)
        return layouts | {"sessions": put("sessions", _from_before(rows, firsts["entries"], days["entries"], None))}

    layouts = {}
    for found in together(spark, activity, attempts, sessions):
        layouts |= found
    return {"name": name, "layouts": layouts}


def _from_before(rows: DataFrame, since: date | None, days: Days, account: int | None) -> DataFrame:
    """A row without counts on the eve of the published days, if older ones had any.

    A series starts with its first day, but not after the first published day
    where it goes back further; older rows are not read any more.
    """
    if since is None or days is None or days[0] >= str(since):
        return rows
    eve = rows.sparkSession.range(1).select(
        F.lit(str(since - timedelta(days=1))).cast("date").alias("d_kst"),
        F.lit(account).cast("int").alias("account_id"),
        *[F.lit(0).cast("bigint").alias(c) for c in rows.columns if c not in BY_ACCOUNT],
    )
    return rows.unionByName(eve)


_METRIC_DAYS = {"dau": "known", "bait_rock": "activity", "catch_rate": "attempts", "safari_session": "entries"}


def _read(store: Store, record: dict) -> Rollups:
    built = record["built"]
    frames = {
        p: store.spark.read.schema(_layout(built["layouts"][p])).parquet(f"{_root(store)}/built/{built['name']}/{p}")
        for p in _BUILT
    }
    spans = [
        (metric, max(date.fromisoformat(days[0]), _first_published(days)), date.fromisoformat(days[1]))
        for metric, days in ((m, record["days"][n]) for m, n in _METRIC_DAYS.items())
        if days
    ]
    layout = "metric string, _lo date, _hi date"
    return Rollups(**frames, spans=store.spark.createDataFrame(spans, layout))
