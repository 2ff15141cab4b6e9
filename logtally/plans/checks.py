"""Checks whose rows are violations; sound data give no rows.

A violation is reported and rolls nothing back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtally.functions.values import kst_day, payload, rows, within_days
from logtally.operators import id_sets
from logtally.operators.dimensions import orphan_keys
from logtally.operators.drilldown import CATEGORIES, SCOPE, drill_preview, drill_totals
from logtally.operators.id_gaps import GAP_THRESHOLD
from logtally.plans.series import SERIES
from logtally.schema import ARCHIVE_LINE, SERIES_DAYS


def _found(df: DataFrame, check: str, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), detail.cast("string").alias("detail"))


# --- assertions after a load ---------------------------------------------
# The names that findings carry (check_name) and the drift items.


def duplicate_ids(audit: DataFrame) -> DataFrame:
    sets = id_sets.id_sets(audit, every=F.lit(True))
    return _found(id_sets.repeated(audit, sets, "every"), "dup", F.col("id"))


def _columns_like(spark: SparkSession, df: DataFrame, check: str, test) -> DataFrame:
    """One row per column name that must not exist; no data are read."""
    names = [(check, c) for c in df.columns if test(c.lower())]
    return spark.createDataFrame(names, "check_name string, detail string")


def ip_column(spark: SparkSession, audit: DataFrame) -> DataFrame:
    return _columns_like(spark, audit, "ip_column_present", lambda c: c == "ip")


def username_column(spark: SparkSession, v: DataFrame) -> DataFrame:
    return _columns_like(spark, v, "username_column_exposed", lambda c: "username" in c)


def unmasked_urls(v: DataFrame) -> DataFrame:
    return _found(v.where(F.col("req_url").contains("?")), "unmasked_url", F.col("id"))


def recent_gaps(
    audit: DataFrame, as_of, days: int = 3, threshold: int = GAP_THRESHOLD
) -> DataFrame:
    sets = id_sets.id_sets(audit.where(within_days(as_of, days)), recent=F.lit(True))
    return _found(id_sets.jumps(sets, "recent", threshold), "gap", _arrow())


def orphan_pokedex(v: DataFrame, dim: DataFrame) -> DataFrame:
    orphans = orphan_keys(v, dim, "pokedex_id")
    return _found(orphans, "orphan_pokedex", F.col("pokedex_id"))


def carriage_returns(dim: DataFrame) -> DataFrame:
    """Line ends that survived in a dimension's key or tier."""
    dirty = F.col("pokedex_id_raw").contains("\r") | F.col("tier").contains("\r")
    return _found(dim.where(dirty), "crlf_residue", F.col("pokedex_id_raw"))


def assertions(
    spark: SparkSession,
    audit: DataFrame,
    v: DataFrame,
    dim: DataFrame,
    as_of,
    gap_days: int = 3,
    gap_threshold: int = GAP_THRESHOLD,
) -> DataFrame:
    """All assertions over the whole table as (check_name, detail), ordered by both.

    Repeated ids and id jumps come from one set of bitmaps, urls and orphans
    from one pass over the view.
    """
    recent = F.coalesce(within_days(as_of, gap_days), F.lit(False))
    sets = id_sets.id_sets(audit, every=F.lit(True), recent=recent)
    checks = [
        _id_rules(audit, sets, gap_threshold),
        ip_column(spark, audit),
        username_column(spark, v),
        _row_rules(v, dim),
        carriage_returns(dim),
    ]
    return reduce(DataFrame.unionByName, checks).orderBy("check_name", "detail")


def _id_rules(audit: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    gaps = id_sets.jumps(sets, "recent", threshold)
    twice = id_sets.repeated(audit, sets, "every")
    return _found(twice, "dup", F.col("id")).unionByName(_found(gaps, "gap", _arrow()))


def _row_rules(v: DataFrame, dim: DataFrame) -> DataFrame:
    """Rules on single rows, as one list of flagged rules per row.

    Keys meet the dimension as the other rules' rows pass beside them: a row
    with a broken rule has no key, so no dimension row takes it away.
    """
    rules = F.array(
        F.struct(
            F.lit("unmasked_url").alias("check_name"),
            F.col("id").cast("string").alias("detail"),
            F.lit(None).cast("string").alias("_key"),
            F.col("req_url").contains("?").alias("_broken"),
        ),
        F.struct(
            F.lit("orphan_pokedex").alias("check_name"),
            F.col("pokedex_id").alias("detail"),
            F.col("pokedex_id").alias("_key"),
            F.col("pokedex_id").isNotNull().alias("_broken"),
        ),
    )
    flagged = v.select(F.inline(F.filter(rules, lambda r: F.coalesce(r["_broken"], F.lit(False)))))
    known = dim.select(F.col("pokedex_id").alias("_key"))
    # An empty dimension is not delivered yet and makes no orphans.
    asked = flagged.where(F.col("_key").isNull() | known.exists())
    return asked.join(known, "_key", "left_anti").select("check_name", "detail")


def _arrow() -> Column:
    return F.concat(F.col("prev").cast("string"), F.lit("→"), F.col("id").cast("string"))


# --- contract drift -------------------------------------------------------


def contract_drift(
    audit: DataFrame,
    shape: DataFrame,
    dim_file: DataFrame,
    dim_version: DataFrame,
    as_of,
    days: int = 30,
) -> DataFrame:
    """What the sending side does today, next to what is expected of it.

    A change is news, not an alarm. One pass counts all payload items.
    """
    action = F.col("action")
    seen = audit.where(within_days(as_of, days)).agg(
        F.count_if((action == "REQUEST_REJECTED") & payload("url").contains("?")).alias("urls"),
        F.count_if(
            (action == "LOGIN_FAILED") & payload("body.username").isNotNull()
        ).alias("names"),
        F.count_if((action == "POKEMON_CATCH") & payload("wildUid").isNotNull()).alias("uids"),
        F.count_if(
            action.isin("SAFARI_BAIT", "SAFARI_ROCK") & payload("mapId").isNotNull()
        ).alias("maps"),
    )
    one = seen.select(
        "*",
        shape.select("columns").scalar().alias("columns"),
        shape.select("sampled").scalar().alias("sampled"),
        shape.select(F.col("observed_at").cast("string")).scalar().alias("observed"),
        dim_file.agg(rows()).scalar().alias("dim_rows"),
        dim_version.agg(F.max("sha")).scalar().alias("sha"),
    )
    none = F.lit("")

    def counted(name: str) -> Column:
        many = F.concat(F.lit("yes: "), F.col(name).cast("string"), F.lit(" rows"))
        return F.when(F.col(name) > 0, many).otherwise("no")

    def yes_no(test: Column) -> Column:
        return F.when(test, "yes").otherwise("no")

    items = [
        (
            "1. source carries ip",
            "yes",
            yes_no(F.array_contains("columns", "ip")),
            F.col("sampled"),
        ),
        (
            "2. source columns",
            "[" + ", ".join(sorted(ARCHIVE_LINE.names)) + "]",
            F.coalesce(F.col("columns").cast("string"), F.lit("(no sample)")),
            F.coalesce("observed", none),
        ),
        ("3. REQUEST_REJECTED url keeps its query string", "yes", counted("urls"), none),
        ("4. LOGIN_FAILED body has a plain username", "yes", counted("names"), none),
        ("5. dimension files are delivered", "no", counted("dim_rows"), F.coalesce("sha", none)),
        ("6. POKEMON_CATCH has wildUid", "no", counted("uids"), none),
        ("7. SAFARI_BAIT and SAFARI_ROCK have mapId", "no", yes_no(F.col("maps") > 0), none),
    ]
    lines = [
        F.struct(
            F.lit(item).alias("item"),
            F.lit(expected).alias("expected"),
            actual.alias("actual"),
            evidence.cast("string").alias("evidence"),
        )
        for item, expected, actual, evidence in items
    ]
    return one.select(F.inline(F.array(*lines))).orderBy("item")


# --- published output ------------------------------------------------------


def series_contract(series: dict[str, DataFrame]) -> DataFrame:
    """Too many days, holes in the days, numbers that are not finite.

    One row per broken rule, metric and field, with the first bad day.
    """
    return reduce(DataFrame.unionByName, [_broken_rules(m, f) for m, f in series.items()])


def _broken_rules(metric: str, frame: DataFrame) -> DataFrame:
    n, distinct = rows(), F.count_distinct("d")
    span = F.datediff(F.max("d"), F.min("d")) + 1
    rules = [
        _rule("too_many_days", n, n > SERIES_DAYS),
        _rule("days_not_contiguous", F.concat_ws("/", n, distinct, span),
              (n != span) | (n != distinct)),
    ]
    for field in SERIES[metric]:
        first = F.min(F.when(_not_finite(field.name), F.col("d")))
        rules.append(_rule(f"not_finite:{field.name}", first, first.isNotNull()))
    return (
        frame.agg(F.array(*rules).alias("_rules"))
        .select(F.lit(metric).alias("metric"), F.inline("_rules"))
        .where("_bad")
        .drop("_bad")
    )


def _rule(name: str, detail: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(name).alias("rule"),
        detail.cast("string").alias("detail"),
        F.coalesce(bad, F.lit(False)).alias("_bad"),
    )


def _not_finite(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.isnan(value) | (F.abs(value) == float("inf"))


def meta_contract(meta: DataFrame) -> DataFrame:
    """Negative counts in the banner row, or not exactly one row."""
    counts = ("total_rows", "last_inserted", "last_files", "master_pokemon_rows")
    negative = [
        F.struct(
            F.concat(F.lit("negative:"), F.lit(c)).alias("rule"),
            F.col(c).cast("string").alias("detail"),
        )
        for c in counts
    ]
    bad = meta.select(F.inline(F.array(*negative))).where(F.col("detail").startswith("-"))
    size = meta.agg(rows().alias("n")).where(F.col("n") != 1)
    wrong = size.select(F.lit("row_count").alias("rule"), F.col("n").cast("string").alias("detail"))
    return bad.unionByName(wrong).select(F.lit("meta").alias("metric"), "rule", "detail")


# Which published total each category must add up to.
DRILL_TOTALS = {
    ("dau", "active"): "events",
    ("dau", "new"): "new_users",
    ("bait_rock", "bait"): "bait_n",
    ("bait_rock", "rock"): "rock_n",
    ("bait_rock", "attempts"): "attempts",
    ("catch_rate", "caught"): "caught",
    ("catch_rate", "fled"): "fled",
    ("catch_rate", "broke_out"): "broke_out",
    ("catch_rate", "all"): "attempts",
    ("catch_rate", "bait"): "attempts_bait",
    ("catch_rate", "rock"): "attempts_rock",
    ("catch_rate", "plain"): "attempts_plain",
    ("safari_session", "completed"): "closed_sessions",
    ("safari_session", "all"): "sessions",
}


def drill_invariants(series: dict[str, DataFrame], counts: DataFrame) -> DataFrame:
    """Where the drill-down does not add up to what was published."""
    published = []
    for metric, frame in series.items():
        totals = F.array(
            *[
                F.struct(
                    F.lit(c.name).alias("category"),
                    F.col(DRILL_TOTALS[metric, c.name]).alias("published"),
                    (F.col("dau") if c.name == "active" else F.lit(None).cast("bigint")).alias(
                        "published_users"
                    ),
                )
                for c in CATEGORIES
                if c.metric == metric
            ]
        )
        published.append(frame.select(F.lit(metric).alias("metric"), "d", F.inline(totals)))
    found = counts.groupBy(*SCOPE).agg(
        F.sum("count").alias("found"), F.count("account_id").alias("found_users")
    )
    rules = F.array(
        _mismatch("total", F.col("published"), F.col("found"), F.lit(True)),
        _mismatch(
            "users",
            F.col("published_users"),
            F.col("found_users"),
            F.col("published_users").isNotNull(),
        ),
    )
    off = (
        reduce(DataFrame.unionByName, published)
        .join(found, SCOPE, "full")
        .select(*SCOPE, F.inline(rules))
        .where("_bad")
        .drop("_bad")
    )
    twice = (
        counts.groupBy(*SCOPE, "account_id")
        .agg(rows().alias("n"), F.min("count").alias("least"))
        .where((F.col("n") > 1) | (F.col("least") <= 0))
    )
    return off.union(twice.select(*SCOPE, F.lit("account"), F.col("least"), F.col("n")))


def preview_invariants(counts: DataFrame, preview: DataFrame, totals: DataFrame) -> DataFrame:
    """Where a published preview or total is not what the drill-down gives.

    One row per metric, category, day and rule with the number of rows that
    are missing or too many: a preview holds the first ten accounts by count
    and id, each once, and a total the accounts and unidentified records.
    """
    pairs = {"preview": (drill_preview(counts), preview), "totals": (drill_totals(counts), totals)}
    parts = []
    for name, (expected, published) in pairs.items():
        published = published.select(*expected.columns)
        for rule, more, less in (("missing", expected, published), ("extra", published, expected)):
            parts.append(more.exceptAll(less).select(*SCOPE, F.lit(f"{name}_{rule}").alias("rule")))
    return reduce(DataFrame.unionByName, parts).groupBy(*SCOPE, "rule").agg(rows().alias("n"))


def _mismatch(name: str, published: Column, found: Column, applies: Column) -> Column:
    number = F.coalesce(found, F.lit(0))
    return F.struct(
        F.lit(name).alias("rule"),
        published.alias("published"),
        number.alias("found"),
        (applies & ~published.eqNullSafe(number)).alias("_bad"),
    )


# --- plausibility ----------------------------------------------------------


def sanity(
    v: DataFrame, catch_daily: DataFrame, sessions: DataFrame, money: DataFrame
) -> DataFrame:
    """Repeated sign-ups, rates above 1, negative stays, broken balances."""
    twice = (
        v.where(F.col("action") == "CREATE_USER")
        .groupBy("account_id")
        .agg(rows().alias("_n"))
        .where(F.col("_n") > 1)
    )
    amount = F.col("trade_amount")
    own = F.when(F.col("action") == "ITEM_BUY", amount).otherwise(-amount)
    broken = money.where(F.col("money_before").isNotNull() & (F.col("money_delta") + own != 0))
    parts = [
        _found(twice, "created_twice", F.col("account_id")),
        _found(catch_daily.where(F.col("catch_rate") > 1), "rate_above_one", F.col("d_kst")),
        _found(
            sessions.where(F.col("dwell_sec") < 0), "negative_dwell", kst_day("entered_at_kst")
        ),
        _found(broken, "balance_broken", F.col("id")),
    ]
    return reduce(DataFrame.unionByName, parts)
