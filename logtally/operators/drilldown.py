"""Who is behind each published number, per day and category."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from logtally.operators import metrics
from logtally.schema import SERIES_DAYS

PREVIEW_ROWS = 10
PAGE_ROWS = 50
SCOPE = ["metric", "category", "d"]


class Category(NamedTuple):
    metric: str
    name: str
    source: str  # the rollup that has the count
    column: str
    series: tuple[str, ...]  # published fields that this category explains
    identified_only: bool = False


# Names and fields of the published drill-down.
CATEGORIES = (
    Category("dau", "active", "activity", "events", ("dau",), True),
    Category("dau", "new", "activity", "new_users", ("new_users",), True),
    Category("bait_rock", "bait", "activity", "bait_n", ("bait_n", "bait_stay_rate")),
    Category("bait_rock", "rock", "activity", "rock_n", ("rock_n", "rock_stay_rate")),
    Category(
        "bait_rock", "attempts", "activity", "attempts",
        ("bait_share", "rock_share", "plain_share"),
    ),
    Category("catch_rate", "caught", "attempts", "caught", ("caught",)),
    Category("catch_rate", "fled", "attempts", "fled", ("fled",)),
    Category("catch_rate", "broke_out", "attempts", "broke_out", ("broke_out",)),
    Category(
        "catch_rate", "all", "attempts", "attempts",
        ("catch_rate", "flee_rate", "break_out_rate"),
    ),
    Category("catch_rate", "bait", "attempts", "attempts_bait", ("catch_rate_bait",)),
    Category("catch_rate", "rock", "attempts", "attempts_rock", ("catch_rate_rock",)),
    Category("catch_rate", "plain", "attempts", "attempts_plain", ("catch_rate_plain",)),
    Category(
        "safari_session", "completed", "sessions", "completed",
        ("dwell_median_min", "dwell_p90_min"),
    ),
    Category(
        "safari_session", "all", "sessions", "sessions", ("sessions", "unclosed_rate")
    ),
)


class Rollups(NamedTuple):
    """Counts per (day, account), the common ground of series and drill-down,
    and the sessions themselves, for their quantiles. ``spans`` are the
    published days per metric where they are known already."""

    activity: DataFrame
    attempts: DataFrame
    sessions: DataFrame
    visits: DataFrame
    spans: DataFrame | None = None


def rollups(v: DataFrame) -> Rollups:
    visits = metrics.safari_session(v)
    return Rollups(
        metrics.activity_by_account(v),
        metrics.attempts_by_account(metrics.catch_attempt(v)),
        metrics.sessions_by_account(visits),
        visits,
    )


def published_days(source: Rollups) -> DataFrame:
    """First and last published day per metric: four rows."""
    if source.spans is not None:
        return source.spans
    day = F.col("d_kst")
    known_day = F.when(F.col("account_id").isNotNull(), day)
    days = {
        "activity": {"dau": known_day, "bait_rock": day},
        "attempts": {"catch_rate": day},
        "sessions": {"safari_session": day},
    }
    spans = []
    for name, metric_days in days.items():
        ends = [
            F.struct(
                F.lit(metric).alias("metric"),
                F.greatest(F.min(d), F.date_sub(F.max(d), SERIES_DAYS - 1)).alias("_lo"),
                F.max(d).alias("_hi"),
            )
            for metric, d in metric_days.items()
        ]
        spans.append(
            getattr(source, name).agg(F.array(*ends).alias("_ends")).select(F.inline("_ends"))
        )
    return reduce(DataFrame.union, spans)


def drill_counts(source: Rollups) -> DataFrame:
    """(metric, category, d, account_id, count) for all published days.

    Each rollup row turns into one row per category it counts in, so nothing
    is grouped again. A NULL account stays a record of its own.
    """
    spans = F.broadcast(published_days(source))  # four rows
    parts = []
    for name in ("activity", "attempts", "sessions"):
        tagged = F.array(
            *[
                F.struct(
                    F.lit(c.metric).alias("metric"),
                    F.lit(c.name).alias("category"),
                    _counted(c).alias("count"),
                )
                for c in CATEGORIES
                if c.source == name
            ]
        )
        parts.append(
            getattr(source, name).select(
                F.col("d_kst").alias("d"), "account_id", F.inline(tagged)
            )
        )
    return (
        reduce(DataFrame.union, parts)
        .where(F.col("count") > 0)
        .join(spans, "metric")
        .where(F.col("d").between(F.col("_lo"), F.col("_hi")))
        .select("metric", "category", "d", "account_id", "count")
    )


def _counted(category: Category) -> Column:
    count = F.col(category.column)
    if category.identified_only:
        return F.when(F.col("account_id").isNotNull(), count).otherwise(F.lit(0))
    return count


def _rank_order() -> list[Column]:
    return [F.desc("count"), F.asc("account_id")]


def drill_totals(counts: DataFrame) -> DataFrame:
    """Identified accounts and unidentified records per metric, category, day."""
    unknown = F.col("account_id").isNull()
    return counts.groupBy(*SCOPE).agg(
        F.count("account_id").alias("total_users"),
        F.coalesce(F.sum(F.when(unknown, F.col("count"))), F.lit(0)).alias(
            "unidentified_records"
        ),
    )


def drill_preview(counts: DataFrame, size: int = PREVIEW_ROWS) -> DataFrame:
    """Top accounts per metric, category and day, ranked from 1.

    Spark applies the rank limit before the shuffle too, so a day with very
    many accounts sends only a few rows per task.
    """
    ranked = Window.partitionBy(*SCOPE).orderBy(*_rank_order())
    return (
        counts.where(F.col("account_id").isNotNull())
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= size)
        .select(*SCOPE, "rank", "account_id", "count")
    )


def drill_page(
    counts: DataFrame,
    metric: str,
    category: str,
    day,
    term: str = "",
    page: int = 0,
    size: int = PAGE_ROWS,
) -> DataFrame:
    """One page of the accounts whose id contains ``term``, biggest first."""
    wanted = (
        (F.col("metric") == metric)
        & (F.col("category") == category)
        & (F.col("d") == F.lit(str(day)).cast("date"))
    )
    text = F.col("account_id").cast("string")
    return (
        counts.where(wanted & text.contains(term.strip()))
        .select("account_id", "count")
        .orderBy(*_rank_order())
        .offset(page * size)
        .limit(size)
    )


def series_categories(spark: SparkSession) -> DataFrame:
    """(metric, series, category): which category explains which field."""
    pairs = [(c.metric, s, c.name) for c in CATEGORIES for s in c.series]
    return spark.createDataFrame(pairs, "metric string, series string, category string")


def drill_by_series(counts: DataFrame, spark: SparkSession) -> DataFrame:
    """Drill-down totals addressed by published field instead of category."""
    lookup = F.broadcast(series_categories(spark))  # fixed, 22 rows
    return (
        drill_totals(counts)
        .join(lookup, ["metric", "category"])
        .select("metric", "series", "category", "d", "total_users", "unidentified_records")
    )
