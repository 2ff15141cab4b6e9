"""The fact table, load history and dimensions as committed runs on Parquet.

    <root>/audit/run=<name>/d_kst=.../   rows, typed columns beside ``detail``
    <root>/<part>/run=<name>/            objects, pokemon, item, version
    <root>/commits/<number>.json         all runs that count, with their log rows

A run's files are written first, then one rename adds a commit file that lists
them. What no commit lists is not there: a failed run leaves nothing visible,
and a retry writes new folders. Readers open one small file, the newest commit,
or an older one for an older version. A run is pinned to the commit it has read
and can only become the next one: of two overlapping writers one fails.

    append   new rows, ids unseen before
    force    rows that replace earlier rows of the same id
    compact  all rows so far; earlier runs' rows are not read any more
    dims     a version of the dimension files
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from datetime import date, datetime
from functools import cache, reduce
from operator import or_

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F, types as T

from logtally import schema
from logtally.functions.values import instant, kst_day, rows, to_kst
from logtally.operators.audit_view import audit_v
from logtally.sources import files
from logtally.sources.dims import Dims, stub

_AUDIT_COLUMNS = [f.name for f in schema.AUDIT.fields]


@dataclass(frozen=True)
class Run:
    name: str
    kind: str
    parts: tuple[str, ...] = ()
    min_id: int | None = None
    max_id: int | None = None
    latest_event: str | None = None
    log: dict | None = None  # the load history row
    shape: dict | None = None  # columns of the newest object read


@dataclass
class RunWriter:
    """Collects the parts of one run; nothing is visible before ``commit``."""

    store: "Store"
    kind: str
    base: int  # the commit that this run has read; it becomes the next one
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    parts: list[str] = field(default_factory=list)
    min_id: int | None = None
    max_id: int | None = None
    latest_event: str | None = None
    log: dict | None = None
    shape: dict | None = None

    def path(self, part: str) -> str:
        return self.store.path(part, self.name)

    def write(self, part: str, df: DataFrame) -> None:
        df.write.parquet(self.path(part))
        self.parts.append(part)

    def write_audit(self, audit: DataFrame) -> None:
        """Typed rows by day, in id order.

        The rebalance hint lets AQE split a day that holds much of the batch
        and join small days to files of the advisory size; rows in id order
        give Parquet tight min/max ranges on id and time.
        """
        self.write_typed(audit_v(audit))

    def write_typed(self, typed: DataFrame) -> None:
        (
            typed.withColumn("d_kst", kst_day())
            .hint("rebalance", "d_kst")
            .sortWithinPartitions("d_kst", "id")
            .write.partitionBy("d_kst")
            .parquet(self.path("audit"))
        )
        self.parts.append("audit")
        written = self.store.spark.read.schema(_typed_columns(self.store.spark))
        self.min_id, self.max_id, self.latest_event = (
            written.parquet(self.path("audit"))
            .agg(F.min("id"), F.max("id"), F.max("created_at").cast("string"))
            .first()
        )

    def commit(self) -> None:
        """Become commit ``base + 1``, or fail if another run already has.

        What came after the commit this run has read is unknown to it: neither
        could it tell known ids from new ones, nor replace rows it has not seen.
        """
        store = Store(self.store.spark, self.store.root, self.base)
        number, runs = self.base, store.committed()
        if self.kind == "compact":
            runs = [replace(r, parts=tuple(p for p in r.parts if p != "audit")) for r in runs]
        runs.append(
            Run(
                self.name,
                self.kind,
                tuple(self.parts),
                self.min_id,
                self.max_id,
                self.latest_event,
                self.log,
                self.shape,
            )
        )
        text = json.dumps([asdict(r) for r in runs], default=str)
        files.create(store.spark, store.commit_path(number + 1), text)


@cache
def _typed_columns(spark: SparkSession) -> T.StructType:
    """Schema of the stored rows, folders included."""
    empty = audit_v(spark.createDataFrame([], schema.AUDIT))
    return empty.withColumns({"run": F.lit(""), "d_kst": kst_day()}).schema


class Store:
    """Reads what is committed, or exactly the commits up to ``at``."""

    def __init__(self, spark: SparkSession, root: str, at: int | None = None) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.at = at

    # --- commits ---------------------------------------------------------

    def commit_path(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def last_number(self) -> int:
        return files.last_number(self.spark, f"{self.root}/commits")

    def snapshot(self) -> "Store":
        """This store frozen at its newest commit: one version for many reads."""
        return Store(self.spark, self.root, self.last_number())

    def committed(self) -> list[Run]:
        """The runs that count, oldest first: one small record per load."""
        number = self.last_number() if self.at is None else self.at
        if number == 0:
            return []
        records = json.loads(files.read_text(self.spark, self.commit_path(number)))
        return [Run(**{**r, "parts": tuple(r["parts"])}) for r in records]

    def new_run(self, kind: str) -> RunWriter:
        return RunWriter(self, kind, self.last_number() if self.at is None else self.at)

    def path(self, part: str, name: str) -> str:
        return f"{self.root}/{part}/run={name}"

    def _part(self, run: Run, part: str) -> str:
        return self.path(part, run.name)

    # --- facts -----------------------------------------------------------

    def _stored(self) -> DataFrame:
        """Rows of all runs, less those that a later forced run replaced.

        Whatever the number of forced runs: rows in the ranges of their ids meet
        once by id, with the newest run that forced it. All others pass as they are.
        """
        typed = _typed_columns(self.spark)
        runs = [r for r in self.committed() if "audit" in r.parts]
        if not runs:
            return self.spark.createDataFrame([], typed)

        reader = self.spark.read.schema(typed).option("basePath", f"{self.root}/audit")
        table = reader.parquet(*[self._part(r, "audit") for r in runs])
        forced = [r for r in runs if r.kind == "force"]
        if not forced:
            return table
        order = self.spark.createDataFrame(
            [(r.name, i) for i, r in enumerate(runs)], "run string, _order int"
        )
        near = reduce(
            or_, [F.col("id").between(r.min_id, r.max_id) for r in forced if r.min_id is not None], F.lit(False)
        )
        ordered = table.where(near).join(order, "run")
        force = F.when(F.col("run").isin([r.name for r in forced]), F.col("_order"))
        newest = F.max(force).over(Window.partitionBy("id"))
        kept = ordered.withColumn("_by", newest).where("_by IS NULL OR _order >= _by")
        return table.where(~near).unionByName(kept.select(*table.columns)).select(*typed.fieldNames())

    def audit_v(self, days: tuple | None = None) -> DataFrame:
        """The typed view. ``days`` (first, last), KST, prunes whole folders."""
        stored = self._stored()
        if days is not None:
            first, last = (F.lit(str(d)).cast("date") for d in days)
            stored = stored.where(F.col("d_kst").between(first, last))
        return stored.drop("run", "d_kst")

    def audit(self, days: tuple | None = None) -> DataFrame:
        """The eight stored columns of the fact table."""
        return self.audit_v(days).select(*_AUDIT_COLUMNS)

    def recent(self, as_of, days: int) -> DataFrame:
        """The typed view from ``days`` before ``as_of`` up to it, whole local days.

        For questions about a window: other day folders are not read.
        """
        first = instant(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
        ends = [to_kst(t).cast("date") for t in (first, instant(as_of))]
        return self._stored().where(F.col("d_kst").between(*ends)).drop("run", "d_kst")

    def latest_event(self) -> DataFrame:
        """Time of the newest event, one row, from the commits where they tell.

        A forced run may have replaced the newest row, so then the rows count.
        """
        runs = [r for r in self.committed() if "audit" in r.parts]
        if any(r.kind == "force" for r in runs):
            return self.audit_v().agg(F.max("created_at").alias("created_at"))
        newest = max((r.latest_event for r in runs if r.latest_event), default=None)
        return self.spark.range(1).select(
            F.lit(newest).cast("timestamp_ntz").alias("created_at")
        )

    def compact(self) -> None:
        """Rewrite all rows as one run; worth it after forced or many small runs."""
        now = self.snapshot()
        run = now.new_run("compact")
        run.write_typed(now.audit_v())
        run.commit()

    # --- history and dimensions ------------------------------------------

    def log_rows(self) -> list[Row]:
        """The load history, oldest first; one short row per load."""
        found = []
        for run in self.committed():
            if run.log:
                row = dict(run.log)
                row["run_at"] = datetime.fromisoformat(row["run_at"])
                row["scanned_from"] = date.fromisoformat(row["scanned_from"])
                found.append(Row(**row))
        return found

    def load_log(self) -> DataFrame:
        return self.spark.createDataFrame(self.log_rows(), schema.LOAD_LOG)

    def loaded_objects(self) -> DataFrame:
        paths = [self._part(r, "objects") for r in self.committed() if "objects" in r.parts]
        if not paths:
            return self.spark.createDataFrame([], schema.LOADED_OBJECTS)
        return (
            self.spark.read.schema(schema.LOADED_OBJECTS)
            .parquet(*paths)
            .groupBy("path")
            .agg(F.max("loaded_at").alias("loaded_at"))
        )

    def source_shape(self) -> DataFrame:
        """Top-level columns of the newest object of the last load that read any."""
        shapes = [r.shape for r in self.committed() if r.shape]
        rows = [
            (datetime.fromisoformat(s["observed_at"]), s["sampled"], s["columns"])
            for s in shapes[-1:]
        ]
        return self.spark.createDataFrame(rows, schema.SOURCE_SHAPE)

    def dims(self) -> Dims:
        """The dimensions loaded last; empty ones before the first delivery."""
        runs = [r for r in self.committed() if set(Dims._fields) <= set(r.parts)]
        if not runs:
            return stub(self.spark)
        return Dims(
            *[self.spark.read.parquet(self._part(runs[-1], p)) for p in Dims._fields]
        )


def in_id_range(df: DataFrame, low: int, high: int) -> DataFrame:
    """Literal bounds, so that Parquet row groups outside are skipped."""
    return df.where(F.col("id").between(low, high))


def count_rows(df: DataFrame) -> int:
    return df.agg(rows()).first()[0]
