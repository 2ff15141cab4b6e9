"""Published JSON: series as arrays, drill-down by metric and day.

    <out>/builds/<id>/series/<name>.json     one JSON array of at most 90 rows
    <out>/builds/<id>/details/metric=/d=/    JSON lines, one per account
    <out>/builds/<id>/preview/, totals/      JSON lines, a few thousand in all
    <out>/builds/<id>/categories.json        which category explains which field
    <out>/commits/<number>.json              makes one build the current one

A build that fails leaves the previous one current.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtally.operators.drilldown import CATEGORIES
from logtally.plans import checks
from logtally.plans.jobs import together
from logtally.plans.snapshot import Snapshot, staged_snapshot
from logtally.sources import files
from logtally.sources.store import Store


class ContractError(ValueError):
    """The build breaks the contract of the published output."""


def publish(store: Store, out: str, built_at) -> str:
    """Build, check and publish; returns the build's folder."""
    spark, root = store.spark, out.rstrip("/")
    build = uuid.uuid4().hex
    folder = f"{root}/builds/{build}"
    shot = staged_snapshot(store, f"{folder}/staged")
    together(
        spark,
        lambda: _check_series(shot),
        lambda: _check_drilldown(shot),
        lambda: _write_details(shot.counts, f"{folder}/details"),
        lambda: shot.totals.repartition(1).write.json(f"{folder}/totals"),
        lambda: shot.preview.repartition(1).write.json(f"{folder}/preview"),
    )
    _check_preview(shot, folder)
    for name, frame in {"meta": shot.meta, **shot.series}.items():
        files.create(spark, f"{folder}/series/{name}.json", _array(frame))
    explained = [
        {"metric": c.metric, "category": c.name, "series": c.series} for c in CATEGORIES
    ]
    files.create(spark, f"{folder}/categories.json", json.dumps(explained))
    files.remove(spark, f"{folder}/staged")
    number = files.last_number(spark, f"{root}/commits") + 1
    record = {"schema_version": 1, "build_id": build, "built_at": str(built_at)}
    files.create(spark, f"{root}/commits/{number:012d}.json", json.dumps(record))
    return folder


def current(spark: SparkSession, out: str) -> str | None:
    """Folder of the newest complete build."""
    root = out.rstrip("/")
    last = files.last_number(spark, f"{root}/commits")
    if last == 0:
        return None
    record = json.loads(files.read_text(spark, f"{root}/commits/{last:012d}.json"))
    return f"{root}/builds/{record['build_id']}"


def read_details(
    spark: SparkSession, folder: str, metric: str | None = None, day=None
) -> DataFrame:
    """Published drill-down; with metric and day, other folders are not opened."""
    layout = "category string, account_id string, count bigint, metric string, d date"
    rows = spark.read.schema(layout).json(f"{folder}/details")
    if metric is not None:
        rows = rows.where(F.col("metric") == metric)
    if day is not None:
        rows = rows.where(F.col("d") == F.lit(str(day)).cast("date"))
    return rows.withColumn("account_id", F.col("account_id").cast("int"))


def _array(frame: DataFrame) -> str:
    """A local frame of at most 90 rows, in day order, as one JSON array."""
    names = frame.columns
    order = [names[0]] if names[0] == "d" else []
    found = frame.orderBy(*order).collect() if order else frame.collect()
    return json.dumps([dict(zip(names, r)) for r in found], default=str, allow_nan=False)


def _write_details(counts: DataFrame, path: str) -> None:
    """Rebalancing splits a day with very many accounts over several files."""
    (
        counts.withColumn("account_id", F.col("account_id").cast("string"))
        .hint("rebalance", "metric", "d")
        .write.partitionBy("metric", "d")
        .json(path, ignoreNullFields=False)
    )


def _check_series(shot: Snapshot) -> None:
    broken = checks.series_contract(shot.series).unionByName(checks.meta_contract(shot.meta))
    _refuse(broken)


def _check_drilldown(shot: Snapshot) -> None:
    _refuse(checks.drill_invariants(shot.series, shot.counts))


def _check_preview(shot: Snapshot, folder: str) -> None:
    """What was written, read back, against the drill-down."""
    read = shot.counts.sparkSession.read
    preview = read.schema(shot.preview.schema).json(f"{folder}/preview")
    totals = read.schema(shot.totals.schema).json(f"{folder}/totals")
    _refuse(checks.preview_invariants(shot.counts, preview, totals))


def _refuse(violations: DataFrame) -> None:
    total = violations.count()
    if total:
        some = violations.limit(20).collect()  # as many as one message holds
        raise ContractError(f"{total} violations: " + "; ".join(str(r) for r in some))
