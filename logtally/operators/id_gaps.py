"""Jumps in a sequence of ids without sorting all ids in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

GAP_THRESHOLD = 1000
_BUCKET_BITS = 21


def id_gaps(ids: DataFrame, threshold: int = GAP_THRESHOLD) -> DataFrame:
    """Neighbouring ids further apart than ``threshold``, as (prev, id).

    ``ids`` holds distinct values in column ``id``. Buckets of 2^21 ids are
    compared inside; each bucket then stands for one interval, and the same
    runs over buckets of intervals. A task sees 2^21 rows at most at each of
    the three levels, which together span all 63 bits.
    """
    level = ids.where(F.col("id").isNotNull()).select(
        F.col("id").alias("_first"), F.col("id").alias("_last")
    )
    return interval_gaps(level, threshold, (_BUCKET_BITS, 2 * _BUCKET_BITS, None))


def interval_gaps(
    level: DataFrame, threshold: int, shifts: tuple = (2 * _BUCKET_BITS - 6, None)
) -> DataFrame:
    """Jumps between neighbouring intervals (_first, _last), as (prev, id).

    The given shifts suit intervals of 2^15 ids: a task sees 2^21 of them at
    most, then up to 2^27 at the top, if ids span all 63 bits.
    """
    found = []
    for shift in shifts:
        if shift is None:
            near = Window.orderBy("_first")
        else:
            level = level.withColumn("_bucket", F.shiftright("_first", shift))
            near = Window.partitionBy("_bucket").orderBy("_first")
        compared = level.withColumn("_prev", F.lag("_last").over(near))
        found.append(
            compared.where(F.col("_first") - F.col("_prev") > threshold).select(
                F.col("_prev").alias("prev"), F.col("_first").alias("id")
            )
        )
        if shift is not None:
            level = level.groupBy("_bucket").agg(
                F.min("_first").alias("_first"), F.max("_last").alias("_last")
            )
            level = level.drop("_bucket")
    return reduce(DataFrame.union, found)
