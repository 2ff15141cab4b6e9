"""Column expressions: defensive casts, payload paths, clocks, ratios.

None of them raises on bad input, whatever ``spark.sql.ansi.enabled`` says,
and none depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from logtally.schema import KST_OFFSET_HOURS, TUTORIAL_MAP


# --- casts ---------------------------------------------------------------


def _try_whole(text: Column, kind: str) -> Column:
    """Whole number from text; fractions round half away from zero."""
    return F.round(text.try_cast("decimal(38,18)")).try_cast(kind)


def try_int(text: Column) -> Column:
    return _try_whole(text, "int")


def try_bigint(text: Column) -> Column:
    return _try_whole(text, "bigint")


def try_double(text: Column) -> Column:
    """Double from text. Java's type suffixes (``1.5d``) are not numbers here."""
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def try_bool(text: Column) -> Column:
    return text.try_cast("boolean")


# --- payload -------------------------------------------------------------


def payload(path: str, column: str = "detail") -> Column:
    """Text at ``path`` of a variant column; NULL where there is none."""
    return F.try_variant_get(F.col(column), f"$.{path}", "string")


def null_if_json_null(column: str) -> Column:
    """A variant holding JSON null becomes SQL NULL."""
    return F.when(~F.is_variant_null(F.col(column)), F.col(column))


# --- clocks --------------------------------------------------------------

_HAS_OFFSET = r":\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)\s*$"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a wall clock, without a time-zone lookup."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)


def utc_wallclock(text: Column) -> Column:
    """ISO text to a UTC wall clock. Text without an offset counts as UTC."""
    instant = text.try_cast("timestamp")
    shifted = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))
    return F.when(text.rlike(_HAS_OFFSET), shifted).otherwise(
        text.try_cast("timestamp_ntz")
    )


def to_kst(utc: Column) -> Column:
    return utc + F.expr(f"INTERVAL {KST_OFFSET_HOURS} HOURS")


def kst_day(name: str = "created_at_kst") -> Column:
    return F.col(name).cast("date")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def instant(as_of) -> Column:
    """A ``datetime`` or ISO string (UTC) as a wall-clock literal."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def within_days(as_of, days: int, name: str = "created_at") -> Column:
    """After ``days`` before ``as_of`` and not after ``as_of``; reaches the Parquet scan."""
    end = instant(as_of)
    return (F.col(name) > end - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(name) <= end)


# --- numbers and predicates ----------------------------------------------


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; NULL, not an error, when ``whole`` is 0."""
    return part / F.nullif(whole, F.lit(0)).cast("double")


def round_to(value: Column, digits: int) -> Column:
    """Binary rounding: scale, round half away from zero, scale back."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def outside_tutorial() -> Column:
    """True also where the map is unknown."""
    return F.coalesce(F.col("map_id") != TUTORIAL_MAP, F.lit(True))


def is_plain() -> Column:
    """Neither bait nor rock; an unknown flag counts as not used."""
    return ~F.coalesce(F.col("used_bait"), F.lit(False)) & ~F.coalesce(
        F.col("used_rock"), F.lit(False)
    )


def rows() -> Column:
    return F.count(F.lit(1))
