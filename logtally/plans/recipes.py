"""Product and abuse questions.

Windows end at ``as_of`` (UTC) and reach back the given days. Thresholds are
first screens: what they show needs a look, not an action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtally.functions.values import (
    epoch_micros,
    kst_day,
    outside_tutorial,
    ratio,
    round_to,
    rows,
    within_days,
)
from logtally.operators.metrics import TRADES
from logtally.operators.ordered import Ordered, account_group
from logtally.operators.quantiles import exact_quantiles
from logtally.schema import TICKET_ITEM

SHINY_ODDS = 4096.0  # fixed value: one in 4096


def _is(*names: str) -> Column:
    return F.col("action").isin(*names)


def recent_dau(v: DataFrame, as_of, days: int = 30) -> DataFrame:
    recent = v.where(within_days(as_of, days) & F.col("account_id").isNotNull())
    return (
        recent.select(kst_day().alias("d_kst"), "account_id")
        .distinct()
        .groupBy("d_kst")
        .agg(rows().alias("dau"))
        .orderBy("d_kst")
    )


def funnel(v: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Accounts that signed up, made a character, caught something.

    Steps are counted each for itself, in no order; rows without an account
    count as one account.
    """
    steps = {
        "signup": _is("REGISTER_LOCAL", "LOGIN_OAUTH"),
        "avatar": _is("CREATE_USER"),
        "first_catch": _is("POKEMON_CATCH"),
    }
    first = (
        v.where(within_days(as_of, days))
        .groupBy("account_id")
        .agg(*[F.min(F.when(c, F.col("created_at"))).alias(n) for n, c in steps.items()])
    )
    return first.agg(*[F.count(n).alias(n) for n in steps])


def faucet_sink(v: DataFrame, as_of, days: int = 30) -> DataFrame:
    amount = F.col("trade_amount")
    return (
        v.where(_is(*TRADES) & within_days(as_of, days))
        .groupBy(kst_day().alias("d_kst"))
        .agg(
            F.sum(F.when(_is("ITEM_SELL"), amount)).alias("faucet"),
            F.sum(F.when(_is("ITEM_BUY"), amount)).alias("sink"),
        )
        .orderBy("d_kst")
    )


def catch_composition(v: DataFrame, dim: DataFrame, as_of, days: int = 14) -> DataFrame:
    """What was caught where, by name and tier, without tutorial catches.

    Catches are summed per creature id before the join, so the join meets a
    few thousand rows however popular one creature is.
    """
    per_id = (
        v.where(_is("POKEMON_CATCH") & within_days(as_of, days) & ~F.col("is_starter"))
        .groupBy("map_id", "pokedex_id")
        .agg(
            rows().alias("catches"),
            F.count_if("is_shiny").alias("shiny"),
            F.sum("level").alias("_levels"),
            F.count("level").alias("_leveled"),
        )
    )
    return (
        per_id.join(dim.select("pokedex_id", "name_ko", "tier"), "pokedex_id", "left")
        .groupBy("map_id", "name_ko", "tier")
        .agg(
            F.sum("catches").alias("catches"),
            F.sum("shiny").alias("shiny"),
            round_to(ratio(F.sum("_levels"), F.sum("_leveled")), 1).alias("avg_level"),
        )
        .orderBy(F.desc("catches"))
    )


def reentry_gap(v: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Time from each entry to the account's next one."""
    entries = (
        v.where(_is("SAFARI_ENTER") & within_days(as_of, days))
        .select("id", "account_id", "created_at")
        .withColumn("_account", account_group())
    )
    linked = Ordered(entries, ["_account"]).neighbour(
        ["created_at"], "_next", ahead=True
    )
    return linked.select(
        "account_id",
        F.col("created_at").alias("entered"),
        (F.col("_next.created_at") - F.col("created_at")).alias("gap"),
    ).orderBy(F.col("account_id").asc_nulls_last(), "entered")


def map_edges(v: DataFrame, as_of, days: int = 7, top: int = 50) -> DataFrame:
    return (
        v.where(_is("MAP_CHANGE") & within_days(as_of, days))
        .groupBy(F.col("map_from").alias("src"), F.col("map_to").alias("dst"))
        .agg(rows().alias("n"))
        .orderBy(F.desc("n"), "src", "dst")
        .limit(top)
    )


def shiny_screen(
    v: DataFrame, as_of, days: int = 30, min_catches: int = 200, factor: float = 4
) -> DataFrame:
    """Accounts with far more rare catches than the fixed odds allow.

    The screen compares with the expectation as shown, rounded to 3 digits.
    """
    chance = F.col("catches") / F.lit(SHINY_ODDS)
    return (
        v.where(_is("POKEMON_CATCH") & ~F.col("is_starter") & within_days(as_of, days))
        .groupBy("account_id")
        .agg(rows().alias("catches"), F.count_if("is_shiny").alias("shiny"))
        .withColumn("expected", round_to(chance, 3))
        .withColumn("x_expected", round_to(F.col("shiny") / chance, 1))
        .where(
            (F.col("catches") >= min_catches)
            & (F.col("shiny") > F.col("expected") * factor)
        )
        .orderBy(F.desc(F.col("shiny") - F.col("expected")))
    )


def money_unexplained(
    money: DataFrame, as_of, days: int = 30, threshold: int = 100_000, top: int = 50
) -> DataFrame:
    """Balance changes that the trade itself does not explain."""
    amount = F.col("trade_amount")
    own = F.when(_is("ITEM_BUY"), amount).otherwise(-amount)
    return (
        money.where(within_days(as_of, days) & F.col("money_before").isNotNull())
        .withColumn("unexplained", F.col("money_delta") + own)
        .where(F.abs("unexplained") > threshold)
        .orderBy(F.desc(F.abs("unexplained")), "id")
        .limit(top)
        .select(
            "account_id",
            "created_at_kst",
            "action",
            "item_id",
            "trade_amount",
            "money_before",
            "money_after",
            "money_delta",
            "unexplained",
        )
    )


def money_net_gain(money: DataFrame, as_of, days: int = 30, top: int = 30) -> DataFrame:
    """Accounts whose balance grew most within one day."""
    return (
        money.where(within_days(as_of, days))
        .groupBy("account_id", kst_day().alias("d_kst"))
        .agg(
            F.min("money_before").alias("money_start"),
            F.max("money_after").alias("money_end"),
            (F.max("money_after") - F.min("money_before")).alias("net_gain"),
            rows().alias("trades"),
        )
        .where(F.col("net_gain") > 0)
        .orderBy(F.desc("net_gain"), "account_id", "d_kst")
        .limit(top)
    )


def bot_screen(
    v: DataFrame,
    as_of,
    days: int = 7,
    min_gap: float = 0.1,
    max_gap: float = 300,
    min_events: int = 300,
    top: int = 20,
) -> DataFrame:
    """Accounts whose events follow each other too evenly."""
    events = v.where(within_days(as_of, days) & F.col("account_id").isNotNull()).select(
        "id", "account_id", "created_at"
    )
    linked = Ordered(events, ["account_id"]).neighbour(
        ["created_at"], "_prev", ahead=False
    )
    micros = epoch_micros(F.col("created_at")) - epoch_micros(F.col("_prev.created_at"))
    gaps = linked.select("account_id", micros.alias("_gap")).where(
        (F.col("_gap") / 1e6).between(min_gap, max_gap)
    )
    spread = (
        gaps.groupBy("account_id")
        .agg(rows().alias("n"), F.stddev_samp(F.col("_gap") / 1e6).alias("_sd"))
        .where(F.col("n") >= min_events)
    )
    # Cells of the first pass: 2^15 at most for gaps up to ``max_gap``.
    widest = max(1, int(max_gap * 1e6)).bit_length()
    middle = exact_quantiles(
        gaps.join(spread.select("account_id"), "account_id", "left_semi"),
        "account_id",
        "_gap",
        {"_median": 0.5},
        shift=max(14, widest - 15),
        unit=1e6,
    )
    median, sd = F.col("_median"), F.col("_sd")
    return (
        spread.join(middle, "account_id")
        .select(
            "account_id",
            "n",
            round_to(median, 2).alias("median_s"),
            round_to(sd, 2).alias("sd_s"),
            round_to(sd / F.nullif(median, F.lit(0.0)), 3).alias("cv"),
        )
        .orderBy(F.asc_nulls_last("sd_s"), "account_id")
        .limit(top)
    )


def ticket_ledger(v: DataFrame, as_of, days: int = 30, top: int = 30) -> DataFrame:
    """Accounts that entered more often than they got tickets.

    Tickets are counted in pieces: a claim or a purchase may bring several.
    """
    claimed = F.when(_is("SAFARI_TICKET_CLAIM"), F.col("ticket_claimed"))
    bought = F.when(
        _is("ITEM_BUY") & (F.col("item_id") == TICKET_ITEM), F.col("quantity")
    )
    nothing = F.lit(0)
    return (
        v.where(within_days(as_of, days) & F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count_if(_is("SAFARI_ENTER")).alias("enters"),
            (
                F.coalesce(F.sum(claimed), nothing) + F.coalesce(F.sum(bought), nothing)
            ).alias("acquired"),
            F.min("created_at").alias("first_seen"),
            F.max("created_at").alias("last_seen"),
        )
        .withColumn("deficit", F.col("enters") - F.col("acquired"))
        .where(F.col("deficit") > 0)
        .orderBy(F.desc("deficit"), "account_id")
        .limit(top)
        .select("account_id", "enters", "acquired", "deficit", "first_seen", "last_seen")
    )


_HOUR = 3_600_000_000  # microseconds


def attempt_zscore(
    v: DataFrame,
    as_of,
    days: int = 14,
    baseline_hours: int = 168,
    min_hours: int = 24,
    min_attempts: int = 60,
    min_z: float = 4.0,
    top: int = 50,
) -> DataFrame:
    """Hours in which an account tried far more often than in the hours before.

    Attempts are those that ``catch_attempt`` pairs. An hour is compared with
    the account's own ``baseline_hours`` hours before it, or with those since
    its first attempt in the window, at least ``min_hours``. Hours without an
    attempt count as zero: they add nothing to the sums, only to the number of
    hours, so no calendar is joined. Sums are whole numbers, z is taken from
    them in one step; without any variation there is no z. Windows run over
    one row per account and hour, however many attempts an account has.
    """
    attempts = v.where(
        _is("POKEMON_CATCH_ATTEMPT")
        & within_days(as_of, days)
        & outside_tutorial()
        & F.col("account_id").isNotNull()
        & F.col("wild_uid").isNotNull()
    )
    hour = F.floor(epoch_micros(F.col("created_at")) / _HOUR)
    per_hour = attempts.groupBy("account_id", hour.alias("_hour")).agg(rows().alias("attempts"))
    account = Window.partitionBy("account_id").orderBy("_hour")
    before = account.rangeBetween(-baseline_hours, -1)
    n = F.col("attempts")
    first = F.min("_hour").over(account.rowsBetween(Window.unboundedPreceding, 0))
    seen = (
        per_hour.withColumn("_sum", F.coalesce(F.sum(n).over(before), F.lit(0)))
        .withColumn("_squares", F.coalesce(F.sum(n * n).over(before), F.lit(0)))
        .withColumn("hours", F.least(F.lit(baseline_hours).cast("bigint"), F.col("_hour") - first))
    )
    hours, total = F.col("hours"), F.col("_sum")
    spread = F.sqrt((hours * F.col("_squares") - total * total) / (hours * (hours - 1)).cast("double"))
    start = F.timestamp_add("MICROSECOND", F.col("_hour") * _HOUR, F.expr("TIMESTAMP_NTZ'1970-01-01'"))
    return (
        seen.where((hours >= max(2, min_hours)) & (n >= min_attempts))
        .withColumn("_mean", ratio(total, hours))
        .withColumn("_sd", F.nullif(spread, F.lit(0.0)))
        .withColumn("z", (n - F.col("_mean")) / F.col("_sd"))
        .where(F.col("z") >= min_z)
        .orderBy(F.desc("z"), "account_id", "_hour")
        .limit(top)
        .select(
            "account_id",
            start.alias("hour_utc"),
            "attempts",
            "hours",
            round_to(F.col("_mean"), 4).alias("mean"),
            round_to(F.col("_sd"), 4).alias("sd"),
            round_to(F.col("z"), 3).alias("z"),
        )
    )
