"""Intermediate tables in the folder all executors share, and connected components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from logtally.sources import files

ROUNDS = 64  # star rounds double the reach; a chain of 2^60 links ends before


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, read often.

    A lost executor costs a rerun of the task that wrote, never the table.
    """
    path = f"{files.shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def held(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the shared folder: for narrow tables of a step, read once or twice.

    As safe as ``written``; a small part costs a third of a Parquet file's time.
    """
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(files.shared_dir(spark))
    return df.checkpoint()


def dropped(spark: SparkSession, table: DataFrame) -> None:
    """Remove a ``written`` table that nothing reads any more, and shuffles that nothing holds.

    Spark removes a shuffle's files once the driver's collector finds it
    unused, which on a quiet driver may be after all work is done.
    """
    folders = {name.rsplit("/", 1)[0] for name in table.inputFiles()}
    for folder in folders:
        files.remove(spark, folder)
    gc.collect()  # the driver's handles of shuffled tables
    spark._jvm.System.gc()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b: long).

    Returns (id, root), root the smallest id reachable, one row per vertex.
    Alternating large-star and small-star rounds; a round moves at most one
    row per edge and takes three shuffles. Minima are combined before they are
    shuffled, and the join back in the large star carries no aggregate, so a
    vertex with very many links is split by AQE like any skewed key. The small
    star has one shuffle for copies, minima and the join; copies are dropped
    before it. No link comes to the driver: it sees a count and a sum per round.
    """

    def kept(links: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()  # taken as the links are written, not in a job of its own
        table = held(
            spark,
            links.where("a <> b").observe(
                seen,
                F.count("a").alias("n"),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
            ),
        )
        return table, seen.get

    now, seen = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    for _ in range(ROUNDS):
        turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
        both = now.select(F.inline(F.array(F.struct("a", "b"), turned)))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours of a vertex point to its minimum, each once
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").repartition("a").distinct()
        # small star: a vertex and its smaller neighbours point to the minimum, the vertex by the minimum's row
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        now, state = kept(small)
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)
