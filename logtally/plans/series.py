"""Published daily series, period figures and the banner row."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtally.functions.values import instant, ratio, round_to, rows
from logtally.operators import metrics
from logtally.operators.drilldown import Rollups
from logtally.schema import SERIES_DAYS

STALE_HOURS = 36
GAP_SHARE = 0.1


class Field(NamedTuple):
    """A published field: a zero-filled count, or a rate that may be unknown."""

    name: str
    digits: int | None = None  # None: a count
    source: str | None = None
    divisor: float = 1.0


def _counts(names: str) -> list[Field]:
    return [Field(n) for n in names.split()]


def _rates(names: str) -> list[Field]:
    return [Field(n, 4) for n in names.split()]


# Published fields in their order.
SERIES: dict[str, list[Field]] = {
    "bait_rock": [
        *_counts("bait_n rock_n users_bait users_rock"),
        *_counts("attempts attempts_bait attempts_rock attempts_plain"),
        *_rates("bait_share rock_share plain_share bait_stay_rate rock_stay_rate"),
    ],
    "dau": _counts("dau new_users events"),
    "catch_rate": [
        *_counts("attempts users caught fled broke_out"),
        *_rates("catch_rate flee_rate break_out_rate"),
        *_counts("attempts_bait attempts_rock attempts_plain"),
        *_rates("catch_rate_bait catch_rate_rock catch_rate_plain"),
        *_counts("caught_observed caught_gap"),
    ],
    "safari_session": [
        *_counts("sessions users closed_sessions"),
        *_rates("unclosed_rate"),
        Field("dwell_median_min", 2, "dwell_median_sec", 60.0),
        Field("dwell_p90_min", 2, "dwell_p90_sec", 60.0),
    ],
}


def to_series(daily: DataFrame, metric: str) -> DataFrame:
    """The last 90 days of a daily metric without holes, ascending by ``d``.

    A day without rows has counts of 0 and unknown rates: "no attempts" is not
    "a rate of 0". Each day is repeated over the hole behind it, which needs
    one pass over ``daily`` instead of a join with a calendar. The window
    without partitions sees one row per day.
    """
    by_day = Window.orderBy("d_kst")
    last = F.max("d_kst").over(Window.partitionBy())
    start = F.greatest("d_kst", F.date_sub("_last", SERIES_DAYS - 1))
    stop = F.coalesce(F.date_sub("_next", 1), F.col("d_kst"))
    days = (
        daily.where(F.col("d_kst").isNotNull())
        .withColumn("_next", F.lead("d_kst").over(by_day))
        .withColumn("_last", last)
        .where(start <= stop)
        .withColumn("d", F.explode(F.sequence(start, stop)))
    )
    own = F.col("d") == F.col("d_kst")

    def publish(field: Field) -> Column:
        value = F.when(own, F.col(field.source or field.name))
        if field.digits is None:
            value = F.coalesce(value, F.lit(0))
        else:
            value = round_to(value / F.lit(field.divisor), field.digits)
        return value.alias(field.name)

    return days.select("d", *[publish(f) for f in SERIES[metric]]).orderBy("d")


def all_series(source: Rollups) -> dict[str, DataFrame]:
    """All four series."""
    observed = metrics.observed_from(source.activity)
    return {
        "bait_rock": to_series(metrics.bait_rock_from(source.activity), "bait_rock"),
        "dau": to_series(metrics.dau_from(source.activity), "dau"),
        "catch_rate": to_series(metrics.catch_rate_from(source.attempts, observed), "catch_rate"),
        "safari_session": to_series(
            metrics.safari_session_from(source.sessions, source.visits), "safari_session"
        ),
    }


# --- periods: everything below reads series of at most 90 rows ------------


def period(series: dict[str, DataFrame], days: int) -> dict[str, DataFrame]:
    """The last ``days`` days of all series, up to the newest day of any."""
    newest = reduce(DataFrame.union, [s.agg(F.max("d").alias("d")) for s in series.values()])
    first = newest.agg(F.date_sub(F.max("d"), days - 1)).scalar()
    return {name: s.where(F.col("d") >= first) for name, s in series.items()}


def _period_rows(
    series: dict[str, DataFrame], days: int, fields: dict[str, dict[str, str]]
) -> DataFrame:
    """Chosen fields of all series in the period, each under a name of its own.

    One frame of at most four times 90 rows: every series is computed once, and
    all of them, chosen or not, decide which day is the newest.
    """
    parts = [
        frame.select("d", *[F.col(c).alias(n) for n, c in fields.get(metric, {}).items()])
        for metric, frame in series.items()
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    newest = F.max("d").over(Window.partitionBy())
    return together.withColumn("_newest", newest).where(
        F.col("d") >= F.date_sub("_newest", days - 1)
    )


def period_summary(series: dict[str, DataFrame], days: int) -> DataFrame:
    """Mean active users, sign-ups, attempts and pooled catch rate: one row."""
    fields = {
        "dau": {"dau": "dau", "new_users": "new_users"},
        "catch_rate": {"attempts": "attempts", "caught": "caught"},
    }
    return _period_rows(series, days, fields).agg(
        F.avg("dau").alias("mean_dau"),
        F.sum("new_users").alias("new_users"),
        F.sum("attempts").alias("attempts"),
        ratio(F.sum("caught"), F.sum("attempts")).alias("catch_rate"),
    )


def period_notes(series: dict[str, DataFrame], days: int) -> DataFrame:
    """The remarks under each chart as one row of numbers and one flag."""
    fields = {
        "bait_rock": {
            "bait_n": "bait_n",
            "rock_n": "rock_n",
            "tries": "attempts",
            "tries_bait": "attempts_bait",
            "tries_rock": "attempts_rock",
        },
        "dau": {"new_users": "new_users", "dau": "dau"},
        "catch_rate": {"attempts": "attempts", "caught": "caught", "gap": "caught_gap"},
        "safari_session": {"sessions": "sessions", "closed": "closed_sessions"},
    }
    attempts, gap = F.sum("attempts"), F.sum(F.abs("gap"))
    used = F.sum("tries_bait") + F.sum("tries_rock")
    return _period_rows(series, days, fields).agg(
        F.sum("bait_n").alias("bait_n"),
        F.sum("rock_n").alias("rock_n"),
        ratio(used, F.sum("tries")).alias("used_share"),
        F.sum("new_users").alias("new_users"),
        F.max("dau").alias("max_dau"),
        attempts.alias("attempts"),
        F.sum("caught").alias("caught"),
        ratio(F.sum("caught"), attempts).alias("catch_rate"),
        gap.alias("gap"),
        F.coalesce(ratio(gap, attempts) > GAP_SHARE, F.lit(False)).alias("gap_flag"),
        F.sum("sessions").alias("sessions"),
        ratio(F.sum("sessions") - F.sum("closed"), F.sum("sessions")).alias(
            "unclosed_share"
        ),
    )


# --- banner ---------------------------------------------------------------


def freshness(load_log: DataFrame, as_of) -> DataFrame:
    """Hours since the last load; stale after 36, or if there was none."""
    age = F.timestamp_diff("MICROSECOND", F.max("run_at"), instant(as_of)) / F.lit(3.6e9)
    return load_log.agg(
        F.max("run_at").alias("last_load_at"),
        age.alias("age_hours"),
        F.coalesce(age > STALE_HOURS, F.lit(True)).alias("stale"),
    )


def meta(
    load_log: DataFrame, audit: DataFrame, dim_version: DataFrame, dim: DataFrame
) -> DataFrame:
    """One row about the last load, also when no load ever ran."""
    newest = F.max_by(
        F.struct("run_at", "total_rows", "rows_inserted", "files_scanned"),
        F.struct("run_at", "total_rows"),
    )
    last = load_log.agg(newest.alias("last"))
    return last.select(
        F.col("last.run_at").alias("last_load_at"),
        F.col("last.total_rows").alias("total_rows"),
        F.col("last.rows_inserted").alias("last_inserted"),
        F.col("last.files_scanned").alias("last_files"),
        audit.agg(F.max("created_at")).scalar().alias("latest_event_utc"),
        F.coalesce(dim_version.agg(F.max("sha")).scalar(), F.lit("")).alias("master_sha"),
        dim.agg(rows()).scalar().alias("master_pokemon_rows"),
    )
