"""The object archive: listing, planning, reading."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from logtally.functions.values import null_if_json_null, utc_wallclock
from logtally.schema import ARCHIVE_LINE
from logtally.sources import files

OBJECTS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("batch_date", T.DateType()),
        T.StructField("cutoff_id", T.LongType()),
    ]
)


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def list_objects(spark: SparkSession, base: str, first_day: date | None = None) -> DataFrame:
    """Archive objects by the day they were shipped (not the events' day).

    Only names are read; the content column is pruned. With ``first_day``,
    months before it are not even listed. An archive that does not exist yet
    has no objects.
    """
    root = f"{base.rstrip('/')}/audit"
    months = "*/*" if first_day is None else _months_from(spark, root, first_day)
    try:
        pattern = f"{root}/{months}/*/*.jsonl.gz"
        files_ = spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as error:
        if is_missing_path(error):
            return spark.createDataFrame([], OBJECTS)
        raise
    return parse_paths(files_)


def _months_from(spark: SparkSession, root: str, first_day: date) -> str:
    """Month folders, as a glob, that can hold ``first_day`` or later days."""
    start = first_day.strftime("%Y/%m")
    found = [
        f"{year}/{month}"
        for year in files.children(spark, root)
        if year >= start[:4]
        for month in files.children(spark, f"{root}/{year}")
    ]
    return "{" + ",".join([start, *[m for m in found if m > start]]) + "}"


def parse_paths(files: DataFrame) -> DataFrame:
    """Day and highest id out of ``path``; objects without a day are dropped."""
    day = F.regexp_extract("path", r"audit/(\d{4}/\d{2}/\d{2})/", 1)
    cutoff = F.regexp_extract("path", r"-(\d+)\.jsonl\.gz$", 1)
    return files.select(
        "path",
        F.replace(day, F.lit("/"), F.lit("-")).try_cast("date").alias("batch_date"),
        cutoff.try_cast("bigint").alias("cutoff_id"),
    ).where(F.col("batch_date").isNotNull())


def since(objects: DataFrame, day) -> DataFrame:
    return objects.where(F.col("batch_date") >= F.lit(str(day)).cast("date"))


def plan_scan(
    objects: DataFrame, loaded: DataFrame, scan_from, everything: bool
) -> DataFrame:
    """Objects of the window to read: all of them, or those not loaded yet."""
    window = since(objects, scan_from)
    return window if everything else window.join(loaded, "path", "left_anti")


def read_events(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Archive lines under the declared schema; one bad line fails the load.

    gzip objects do not split: one task reads one object. ``paths`` must not be
    empty.
    """
    return events_of(spark.read.schema(ARCHIVE_LINE).option("mode", "FAILFAST").json(paths))


def stream_events(spark: SparkSession, base: str, objects_at_once: int) -> DataFrame:
    """The same lines as a stream: each object once, found by the folder pattern."""
    return events_of(
        spark.readStream.schema(ARCHIVE_LINE)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", objects_at_once)
        .json(f"{base.rstrip('/')}/audit/*/*/*/*.jsonl.gz")
    )


def events_of(lines: DataFrame) -> DataFrame:
    """Typed events, each with the path of its object. ``ip`` is dropped here."""
    # The id is the fact's key: a line without one fails the load as well.
    id_or_fail = F.coalesce("id", F.raise_error(F.lit("archive line without id")))
    return lines.select(
        id_or_fail.cast("bigint").alias("id"),
        "account_id",
        "action",
        "status",
        null_if_json_null("detail").alias("detail"),
        "user_agent",
        "source",
        utc_wallclock(F.col("created_at")).alias("created_at"),
        F.col("_metadata.file_path").alias("path"),
    )


def latest_per_id(events: DataFrame) -> DataFrame:
    """One row per id: the copy shipped last, by day, then path.

    The rank filter also runs before the shuffle (Spark keeps the top row per
    id and task), so an id with very many copies does not meet in one task.
    """
    day = F.regexp_extract("path", r"audit/(\d{4}/\d{2}/\d{2})/", 1)
    # Copies inside one object have no order of their own; any fixed one will do.
    plain = F.xxhash64("account_id", "action", "status", "user_agent", "source", "created_at")
    newest = Window.partitionBy("id").orderBy(
        day.desc(), F.desc("path"), plain.desc(), F.to_json("detail").desc()
    )
    return (
        events.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def ids_only(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Just the ids of archive objects, for reconciliation."""
    return spark.read.schema("id bigint").option("mode", "FAILFAST").json(paths)


def source_columns(spark: SparkSession, path: str) -> list[str]:
    """Top-level columns of one object, sorted. The only inferred schema."""
    return sorted(spark.read.json(path).columns)
