"""Exact interpolated quantiles without a per-group buffer of values.

The built-in exact percentile keeps every distinct value of a group in one
buffer. Here values are whole numbers. A first pass counts coarse cells
(value >> shift) and finds those that hold a wanted rank; a second pass counts
single values inside these cells only. No task ever holds more than one
group's cells or one cell's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtally.functions.values import rows


def exact_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    quantiles: dict[str, float],
    shift: int = 22,
    few_groups: bool = False,
    unit: float = 1.0,
) -> DataFrame:
    """``key`` plus one double column per entry of ``quantiles``.

    ``value`` is a bigint column. NULL values and NULL keys are skipped; a
    group without values is absent. Interpolation is linear between the two
    order statistics around ``p * (n - 1)``, in values divided by ``unit``.
    ``few_groups`` says that the number of groups is bounded (days, say), so
    the found cells, at most two per group and quantile, are broadcast.
    """
    values = df.where(F.col(value).isNotNull() & F.col(key).isNotNull()).select(
        key,
        F.col(value).alias("_value"),
        F.shiftright(F.col(value), shift).alias("_cell"),
    )
    if few_groups:
        counted = values.withColumn("_n", F.lit(1))  # no shuffle before grouping
    else:
        # Equal values of a hot group meet as counts, not as rows, in the join.
        counted = values.groupBy(key, "_cell", "_value").agg(rows().alias("_n"))
    in_group = Window.partitionBy(key)
    total = F.sum("_n").over(in_group)
    cells = (
        counted.groupBy(key, "_cell")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_total", total)
        .withColumn("_to", F.sum("_n").over(in_group.orderBy("_cell")))
        .select(key, "_cell", _ranks_inside(_ranks(quantiles)).alias("_ranks"))
        .where(F.size("_ranks") > 0)
    )
    in_cell = Window.partitionBy(key, "_cell").orderBy("_value")
    hits = (
        counted.join(F.broadcast(cells) if few_groups else cells, [key, "_cell"])
        .groupBy(key, "_cell", "_value", "_ranks")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_to", F.sum("_n").over(in_cell))
        .select(key, "_value", F.inline(_ranks_inside(F.col("_ranks"))))
    )
    return hits.groupBy(key).agg(*[_interpolated(n, unit).alias(n) for n in quantiles])


def _ranks(quantiles: dict[str, float]) -> Column:
    """Zero-based ranks below and above each quantile, with the share between."""
    out = []
    for name, p in quantiles.items():
        spot = F.lit(float(p)) * (F.col("_total") - 1)
        for end, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            out.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(end).alias("end"),
                    rank.alias("rank"),
                    (spot - F.floor(spot)).alias("share"),
                )
            )
    return F.array(*out)


def _ranks_inside(ranks: Column) -> Column:
    """Those ranks that fall on this row, relative to its first one."""
    first = F.col("_to") - F.col("_n")
    found = F.filter(ranks, lambda r: (r.rank >= first) & (r.rank < F.col("_to")))
    return F.transform(found, lambda r: r.withField("rank", r.rank - first))


def _interpolated(name: str, unit: float) -> Column:
    def at(end: str, column: str) -> Column:
        hit = (F.col("name") == name) & (F.col("end") == end)
        return F.max(F.when(hit, F.col(column)))

    low, high = at("lo", "_value") / F.lit(unit), at("hi", "_value") / F.lit(unit)
    return low + (high - low) * at("lo", "share")
