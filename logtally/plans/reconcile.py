"""Archive against fact table: rows we lost, rows the source lost."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtally.operators import id_sets
from logtally.operators.id_gaps import GAP_THRESHOLD
from logtally.sources import archive

WINDOW_DAYS = 14
_BUCKET = 1 << 15

FINDINGS = "kind string, from_id bigint, to_id bigint, n bigint"


def reconcile(
    archived: DataFrame, fact: DataFrame, threshold: int = GAP_THRESHOLD
) -> DataFrame:
    """Findings (kind, from_id, to_id, n); no rows mean agreement.

    ``missing``: archived ids the fact lacks, count and range. ``gap``: jumps
    between neighbouring archived ids. Both come from the archive's bitmaps,
    so the archive is read once. Facts outside the archived buckets are not
    compared: the range reaches the fact's Parquet scan.
    """
    sets = id_sets.id_sets(archived.select("id"), held=F.lit(True))
    return _missing(sets, fact).unionByName(_gaps(sets, threshold))


def _missing(sets: DataFrame, fact: DataFrame) -> DataFrame:
    """Count and range over all buckets; no row if nothing is missing."""
    span = sets.agg(
        ((F.min("bucket") - 2) * _BUCKET).alias("low"), ((F.max("bucket") + 1) * _BUCKET).alias("high")
    )
    near = fact.select("id").where(
        F.col("id").between(span.select("low").scalar(), span.select("high").scalar())
    )
    lost = id_sets.lacking(sets, id_sets.id_sets(near, held=F.lit(True)), "held")
    return lost.agg(
        F.lit("missing").alias("kind"),
        F.min("from_id").alias("from_id"),
        F.max("to_id").alias("to_id"),
        F.sum("n").alias("n"),
    ).where(F.col("n") > 0)


def _gaps(sets: DataFrame, threshold: int) -> DataFrame:
    return id_sets.jumps(sets, "held", threshold).select(
        F.lit("gap").alias("kind"),
        F.col("prev").alias("from_id"),
        F.col("id").alias("to_id"),
        (F.col("id") - F.col("prev") - 1).alias("n"),
    )


def archived_ids(
    spark: SparkSession, base: str, as_of: datetime | date, days: int = WINDOW_DAYS
) -> DataFrame:
    """Ids of the archive's last days; an empty window has none and passes."""
    today = as_of.date() if isinstance(as_of, datetime) else as_of
    first = today - timedelta(days=days)
    window = archive.since(archive.list_objects(spark, base, first), first)
    paths = [r.path for r in window.collect()]  # file names, for the reader
    if not paths:
        return spark.createDataFrame([], "id bigint")
    return archive.ids_only(spark, paths)
