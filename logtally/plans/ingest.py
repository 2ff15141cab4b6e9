"""The daily load: archive objects to a committed run."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from logtally import schema
from logtally.functions.values import instant
from logtally.operators.dimensions import pokemon_dim
from logtally.plans.checks import assertions
from logtally.sources import archive, files
from logtally.sources.dims import read_dims
from logtally.sources.store import RunWriter, Store, count_rows, in_id_range

WINDOW_DAYS = 7


def scan_from(rows_before: int, last_run_at: datetime | None, as_of: datetime) -> date:
    """First archive day of this run's window.

    Everything if nothing is loaded yet; else seven days back from today or
    from the last run, whichever is earlier, so an outage widens the window.
    """
    start = date.fromisoformat(schema.ARCHIVE_EPOCH)
    if rows_before == 0:
        return start
    back = timedelta(days=WINDOW_DAYS)
    last = last_run_at.date() - back if last_run_at else start
    return min(as_of.date() - back, last)


def new_rows(batch: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of the batch whose id the fact lacks."""
    return batch.join(fact.select("id"), "id", "left_anti")


def upsert(fact: DataFrame, batch: DataFrame) -> DataFrame:
    """The fact with every row of the batch added or put in place of its id."""
    return new_rows(fact, batch).unionByName(batch)


def log_row(last: Row | None, as_of, window, objects: int, inserted: int, max_id) -> Row:
    """Load history row; totals follow from the last row, not from a rescan."""
    known = [i for i in (last.max_id if last else None, max_id) if i is not None]
    return Row(
        run_at=as_of,
        scanned_from=window,
        files_scanned=objects,
        rows_inserted=inserted,
        total_rows=(last.total_rows if last else 0) + inserted,
        max_id=max(known, default=None),
    )


def load(
    spark: SparkSession, store: Store, base: str, as_of: datetime, force: bool = False
) -> Row:
    """Load what the archive has and the store lacks. Returns the log row.

    ``force`` reads the whole window again and replaces rows of the same id.
    Nothing is visible unless everything was written: rows, objects and log
    become visible with one commit.
    """
    store = store.snapshot()  # one version for the log, the manifest and the known ids
    last = (store.log_rows() or [None])[-1]
    rows_before = last.total_rows if last else 0
    window = scan_from(rows_before, last.run_at if last else None, as_of)
    plan = archive.plan_scan(
        archive.list_objects(spark, base, window),
        store.loaded_objects(),
        window,
        everything=force or rows_before == 0,
    )
    # File names only, as the reader needs them on the driver anyway.
    paths = [r.path for r in plan.orderBy(F.desc("batch_date"), F.desc("path")).collect()]

    run = store.new_run("force" if force else "append")
    inserted = 0
    if paths:
        events = archive.read_events(spark, paths)
        inserted = write_rows(spark, store, run, events, force, rows_before)
        loaded = spark.createDataFrame([(p,) for p in paths], "path string")
        run.write("objects", loaded.withColumn("loaded_at", instant(as_of)).coalesce(1))
        run.shape = {
            "observed_at": as_of,
            "sampled": paths[0],
            "columns": archive.source_columns(spark, paths[0]),
        }
    row = log_row(last, as_of, window, len(paths), inserted, run.max_id)
    run.log = row.asDict()
    run.commit()
    return row


def write_rows(
    spark: SparkSession,
    store: Store,
    run: RunWriter,
    events: DataFrame,
    force: bool,
    rows_before: int,
) -> int:
    """Write the events read; return how many of their ids are new."""
    batch = archive.latest_per_id(events).drop("path")
    if rows_before == 0:
        run.write_audit(batch)
        return _written_rows(run)
    # Parsed once and put down, as the comparison below needs its id range.
    batch.write.parquet(run.path("staged"))
    staged = spark.read.parquet(run.path("staged"))
    low, high = staged.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return 0
    fresh = new_rows(staged, in_id_range(store.audit_v(), low, high))
    if force:
        run.write_audit(staged)
        inserted = count_rows(fresh)
    else:
        run.write_audit(fresh)
        inserted = _written_rows(run)
    files.remove(spark, run.path("staged"))
    return inserted


def _written_rows(run: RunWriter) -> int:
    """Also of a run without any row, which has no file to tell a schema."""
    return count_rows(run.store.spark.read.schema("id bigint").parquet(run.path("audit")))


def load_dims(spark: SparkSession, store: Store, base: str, as_of: datetime) -> bool:
    """Load the newest dimension files; False, and no change, where none are."""
    dims = read_dims(spark, base, as_of)
    if dims is None:
        return False
    run = store.new_run("dims")
    for name, table in dims._asdict().items():
        run.write(name, table)
    run.commit()
    return True


def daily(
    spark: SparkSession, store: Store, base: str, as_of: datetime, force: bool = False
) -> tuple[Row, DataFrame]:
    """The whole daily run: load rows, load dimensions, check.

    Returns the log row and the violations found (none in sound data). Missing
    dimension files stop nothing, and a violation rolls nothing back.
    """
    row = load(spark, store, base, as_of, force)
    load_dims(spark, store, base, as_of)
    now = store.snapshot()
    v = now.audit_v()
    dim = pokemon_dim(now.dims().pokemon)
    found = assertions(spark, now.audit(), v, dim, as_of)
    return row, found
