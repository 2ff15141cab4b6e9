"""The archive as a stream: objects that have come since the last run, each once.

Spark's file source keeps which objects were read, so no list of loaded objects
is compared, and none passes the driver. A micro-batch becomes one run of the
same store, with its log row and object list, and becomes visible with one
commit. A batch that fails after its commit runs again and finds its ids known.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtally.functions.values import instant
from logtally.plans.ingest import log_row, write_rows
from logtally.sources import archive
from logtally.sources.store import Store

OBJECTS_AT_ONCE = 1000


def load_stream(
    spark: SparkSession,
    store: Store,
    base: str,
    progress: str,
    as_of: datetime,
    objects_at_once: int = OBJECTS_AT_ONCE,
) -> list[dict]:
    """Load all objects that are there and not read yet; returns the log rows.

    ``progress`` is the folder of the stream's checkpoint, on shared storage.
    Unlike the daily load it has no window: objects of any age are read.
    """
    done: list[dict] = []

    def batch(events: DataFrame, _number: int) -> None:
        done.append(_load_batch(spark, store, events, as_of))

    query = (
        archive.stream_events(spark, base, objects_at_once)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def _load_batch(spark: SparkSession, store: Store, events: DataFrame, as_of: datetime) -> dict:
    now = store.snapshot()
    last = (now.log_rows() or [None])[-1]
    run = now.new_run("append")
    # Read once: the objects' names come from the rows that were put down.
    events.write.parquet(run.path("read"))
    read = spark.read.schema(events.schema).parquet(run.path("read"))
    objects = read.select("path").distinct().withColumn("loaded_at", instant(as_of))
    run.write("objects", objects)
    inserted = write_rows(spark, now, run, read, False, last.total_rows if last else 0)
    days = archive.parse_paths(objects).agg(F.min("batch_date").alias("first"), F.count("path").alias("n")).first()
    row = log_row(last, as_of, days.first, days.n, inserted, run.max_id)
    run.log = row.asDict()
    run.commit()
    return run.log
