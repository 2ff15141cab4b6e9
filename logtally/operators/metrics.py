"""Row-level and daily metrics over the audit view.

Daily metrics come in two steps: a rollup per (day, account), then one per
day. Distinct accounts are then a count of rollup rows, the first step combines
before its shuffle, and the drill-down reads the same rollups.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from logtally.functions.values import (
    epoch_micros,
    is_plain,
    kst_day,
    outside_tutorial,
    ratio,
    rows,
    seconds_between,
)
from logtally.operators.ordered import Ordered, account_group
from logtally.operators.quantiles import exact_quantiles

TRADES = ("ITEM_BUY", "ITEM_SELL")
BY_DAY = ["d_kst"]
BY_ACCOUNT = ["d_kst", "account_id"]


def _action(*names: str) -> Column:
    return F.col("action").isin(*names)


def _known_account() -> Column:
    return F.col("account_id").isNotNull()


# --- economy -------------------------------------------------------------


def money_series(v: DataFrame) -> DataFrame:
    """Trades with a balance, each with the account's balance before it."""
    trades = (
        v.where(_action(*TRADES) & F.col("money_after").isNotNull())
        .select(
            "id",
            "account_id",
            "created_at",
            "created_at_kst",
            "action",
            "item_id",
            "quantity",
            "trade_amount",
            "money_after",
        )
        .withColumn("_account", account_group())
    )
    ordered = Ordered(trades, ["_account"])
    linked = ordered.neighbour(["money_after", "created_at"], "_prev", ahead=False)
    before, then = F.col("_prev.money_after"), F.col("_prev.created_at")
    return linked.select(
        *[c for c in trades.columns if c != "_account"],
        (F.col("money_after") - before).alias("money_delta"),
        before.alias("money_before"),
        seconds_between(then, F.col("created_at")).alias("secs_since_prev"),
    )


def economy_daily(v: DataFrame) -> DataFrame:
    """Money created and destroyed per day; NULL, not 0, on a day without."""
    sold, bought = _action("ITEM_SELL"), _action("ITEM_BUY")
    per_account = (
        v.where(sold | bought)
        .groupBy(kst_day().alias("d_kst"), "account_id")
        .agg(
            F.sum(F.when(sold, F.col("trade_amount"))).alias("faucet"),
            F.sum(F.when(bought, F.col("trade_amount"))).alias("sink"),
            F.count_if(sold).alias("n_sell"),
            F.count_if(bought).alias("n_buy"),
        )
    )
    return per_account.groupBy("d_kst").agg(
        *[F.sum(c).alias(c) for c in ("faucet", "sink", "n_sell", "n_buy")],
        F.count("account_id").alias("traders"),
    )


# --- activity, bait and rock ---------------------------------------------


def activity_by_account(v: DataFrame) -> DataFrame:
    """What each account did per day. A NULL account is a row of its own."""
    bait, rock = _action("SAFARI_BAIT"), _action("SAFARI_ROCK")
    stayed = F.col("flee_result") == "stay"
    tried = _action("POKEMON_CATCH_ATTEMPT") & outside_tutorial()
    return v.groupBy(kst_day().alias("d_kst"), "account_id").agg(
        rows().alias("events"),
        F.count_if(_action("CREATE_USER")).alias("new_users"),
        F.count_if(bait).alias("bait_n"),
        F.count_if(rock).alias("rock_n"),
        F.count_if(bait & stayed).alias("bait_stay"),
        F.count_if(rock & stayed).alias("rock_stay"),
        F.count_if(tried).alias("attempts"),
        F.count_if(tried & F.col("used_bait")).alias("attempts_bait"),
        F.count_if(tried & F.col("used_rock")).alias("attempts_rock"),
        F.count_if(tried & is_plain()).alias("attempts_plain"),
        F.count_if(_observed_catch()).alias("caught_observed"),
    )


def _observed_catch() -> Column:
    return _action("POKEMON_CATCH") & ~F.col("is_starter")


def dau_daily(v: DataFrame) -> DataFrame:
    return dau_from(activity_by_account(v))


def dau_from(activity: DataFrame) -> DataFrame:
    return (
        activity.where(_known_account())
        .groupBy("d_kst")
        .agg(
            rows().alias("dau"),
            F.sum("new_users").alias("new_users"),
            F.sum("events").alias("events"),
        )
    )


def bait_rock_daily(v: DataFrame) -> DataFrame:
    return bait_rock_from(activity_by_account(v))


def bait_rock_from(activity: DataFrame) -> DataFrame:
    """Every day with any event appears, also one without bait or rock."""
    totals = (
        "bait_n rock_n bait_stay rock_stay"
        " attempts attempts_bait attempts_rock attempts_plain"
    ).split()
    day = activity.groupBy("d_kst").agg(
        *[F.sum(c).alias(c) for c in totals],
        F.count_if(_known_account() & (F.col("bait_n") > 0)).alias("users_bait"),
        F.count_if(_known_account() & (F.col("rock_n") > 0)).alias("users_rock"),
    )
    c = F.col
    return day.select(
        "d_kst",
        "bait_n",
        "rock_n",
        "users_bait",
        "users_rock",
        "attempts",
        "attempts_bait",
        "attempts_rock",
        "attempts_plain",
        ratio(c("attempts_bait"), c("attempts")).alias("bait_share"),
        ratio(c("attempts_rock"), c("attempts")).alias("rock_share"),
        ratio(c("attempts_plain"), c("attempts")).alias("plain_share"),
        ratio(c("bait_stay"), c("bait_n")).alias("bait_stay_rate"),
        ratio(c("rock_stay"), c("rock_n")).alias("rock_stay_rate"),
    )


# --- catching ------------------------------------------------------------


_PAIR = ["account_id", "wild_uid"]
_ATTEMPT = (
    "id account_id created_at created_at_kst map_id wild_uid"
    " pokedex_id level is_shiny used_bait used_rock party_bonus"
).split()


class Carried(NamedTuple):
    """What the pairing of later events needs to know of all earlier ones.

    ``ordinals``: attempts and failures so far per account and creature.
    ``pending``: failures whose attempt is still to come, with their ordinal.
    """

    ordinals: DataFrame
    pending: DataFrame


def pairing_events(v: DataFrame) -> DataFrame:
    """Attempts and failures that have an account and a creature."""
    return v.where(
        _action("POKEMON_CATCH_ATTEMPT", "POKEMON_CATCH_FAIL")
        & _known_account()
        & F.col("wild_uid").isNotNull()
    ).select(*_ATTEMPT, "catch_reason", "action")


def _numbered(events: DataFrame, before: Carried | None) -> DataFrame:
    """Events with their ordinal among the pair's attempts, or its failures."""
    numbered = Ordered(events, [*_PAIR, "action"]).number("_nth")
    if before is None:
        return numbered
    earlier = F.when(_action("POKEMON_CATCH_ATTEMPT"), F.col("attempts")).otherwise(F.col("fails"))
    return (
        numbered.join(before.ordinals, _PAIR, "left")
        .withColumn("_nth", F.col("_nth") + F.coalesce(earlier, F.lit(0)))
        .drop("attempts", "fails")
    )


def catch_attempt(v: DataFrame) -> DataFrame:
    """Attempts with their outcome.

    The n-th attempt of an account on one wild creature belongs to the n-th
    failure of the pair. An attempt without a failure reason counts as caught,
    and ``outcome_inferred`` says that nobody observed it.
    """
    return paired(pairing_events(v))


def paired(events: DataFrame, before: Carried | None = None) -> DataFrame:
    """The attempts among ``events`` with their outcome.

    ``before`` stands for all events that come earlier than these; the result
    is the same as if they had been read.
    """
    tries, fails = _action("POKEMON_CATCH_ATTEMPT"), _action("POKEMON_CATCH_FAIL")
    attempt = F.struct(*_ATTEMPT)
    failure = F.struct(F.col("created_at").alias("failed_at"), "catch_reason")
    # The ordinal is part of the key, so hot pairs spread over tasks.
    sides = _numbered(events, before).select(
        *_PAIR, "_nth", F.when(tries, attempt).alias("_try"), F.when(fails, failure).alias("_fail")
    )
    if before is not None:
        waiting = before.pending.select(
            *_PAIR, "_nth", F.struct("failed_at", "catch_reason").alias("_fail")
        )
        sides = sides.unionByName(waiting, allowMissingColumns=True)
    both = sides.groupBy(*_PAIR, "_nth").agg(
        F.any_value("_try", ignoreNulls=True).alias("_try"),
        F.any_value("_fail", ignoreNulls=True).alias("_fail"),
    )
    reason = F.col("_fail.catch_reason")
    return both.where(F.col("_try").isNotNull()).select(
        *[F.col(f"_try.{c}").alias(c) for c in _ATTEMPT],
        F.col("_fail.failed_at").alias("failed_at"),
        F.coalesce(reason, F.lit("caught")).alias("outcome"),
        reason.isNull().alias("outcome_inferred"),
    )


def carried(events: DataFrame, before: Carried | None = None) -> Carried:
    """The state behind ``events``, which follow those that ``before`` stands for."""
    tries, fails = _action("POKEMON_CATCH_ATTEMPT"), _action("POKEMON_CATCH_FAIL")
    ordinals = events.groupBy(*_PAIR).agg(
        F.count_if(tries).alias("attempts"), F.count_if(fails).alias("fails")
    )
    waiting = (
        _numbered(events, before)
        .where(fails)
        .select(*_PAIR, "_nth", F.col("created_at").alias("failed_at"), "catch_reason")
    )
    if before is not None:
        waiting = waiting.unionByName(before.pending)
        ordinals = (
            ordinals.unionByName(before.ordinals)
            .groupBy(*_PAIR)
            .agg(F.sum("attempts").alias("attempts"), F.sum("fails").alias("fails"))
        )
    ahead = ordinals.where("fails > attempts").select(*_PAIR, "attempts")
    pending = waiting.join(ahead, _PAIR).where("_nth > attempts").drop("attempts")
    return Carried(ordinals, pending)


def attempts_by_account(attempts: DataFrame) -> DataFrame:
    """Outcome counts per day and account, tutorial map left out."""
    caught = F.col("outcome") == "caught"
    bait, rock, plain = F.col("used_bait"), F.col("used_rock"), is_plain()
    return (
        attempts.where(outside_tutorial())
        .groupBy(kst_day().alias("d_kst"), "account_id")
        .agg(
            rows().alias("attempts"),
            F.count_if(caught).alias("caught"),
            F.count_if(F.col("outcome") == "flee").alias("fled"),
            F.count_if(F.col("outcome") == "break_out").alias("broke_out"),
            F.count_if(bait).alias("attempts_bait"),
            F.count_if(rock).alias("attempts_rock"),
            F.count_if(plain).alias("attempts_plain"),
            F.count_if(bait & caught).alias("caught_bait"),
            F.count_if(rock & caught).alias("caught_rock"),
            F.count_if(plain & caught).alias("caught_plain"),
        )
    )


def catch_rate_daily(v: DataFrame) -> DataFrame:
    observed = (
        v.where(_observed_catch())
        .groupBy(kst_day().alias("d_kst"))
        .agg(rows().alias("caught_observed"))
    )
    return catch_rate_from(attempts_by_account(catch_attempt(v)), observed)


def observed_from(activity: DataFrame) -> DataFrame:
    return activity.groupBy("d_kst").agg(F.sum("caught_observed").alias("caught_observed"))


def catch_rate_from(per_account: DataFrame, observed: DataFrame) -> DataFrame:
    totals = [c for c in per_account.columns if c not in BY_ACCOUNT]
    day = per_account.groupBy("d_kst").agg(
        *[F.sum(c).alias(c) for c in totals], F.count("account_id").alias("users")
    )
    c = F.col
    seen = F.coalesce("caught_observed", F.lit(0))
    return day.join(observed, "d_kst", "left").select(
        "d_kst",
        "attempts",
        "users",
        "caught",
        "fled",
        "broke_out",
        ratio(c("caught"), c("attempts")).alias("catch_rate"),
        ratio(c("fled"), c("attempts")).alias("flee_rate"),
        ratio(c("broke_out"), c("attempts")).alias("break_out_rate"),
        "attempts_bait",
        "attempts_rock",
        "attempts_plain",
        ratio(c("caught_bait"), c("attempts_bait")).alias("catch_rate_bait"),
        ratio(c("caught_rock"), c("attempts_rock")).alias("catch_rate_rock"),
        ratio(c("caught_plain"), c("attempts_plain")).alias("catch_rate_plain"),
        seen.alias("caught_observed"),
        (c("caught") - seen).alias("caught_gap"),
    )


# --- sessions ------------------------------------------------------------


def safari_session(v: DataFrame) -> DataFrame:
    """Each entry with the exit that directly follows it, if one does."""
    return sessions_of(moves(v))


def moves(v: DataFrame) -> DataFrame:
    """Entries and exits that have an account, outside the tutorial."""
    return v.where(
        _action("SAFARI_ENTER", "SAFARI_EXIT") & _known_account() & outside_tutorial()
    ).select("id", "account_id", "action", "map_id", "created_at", "created_at_kst")


def sessions_of(moves: DataFrame) -> DataFrame:
    linked = Ordered(moves, ["account_id"]).neighbour(
        ["action", "created_at", "map_id"], "_next", ahead=True
    )
    left = F.coalesce(F.col("_next.action") == "SAFARI_EXIT", F.lit(False))
    out_at = F.when(left, F.col("_next.created_at"))
    return linked.where(_action("SAFARI_ENTER")).select(
        "account_id",
        F.col("map_id").alias("entry_map"),
        F.when(left, F.col("_next.map_id")).alias("exit_map"),
        F.col("created_at").alias("entered_at"),
        F.col("created_at_kst").alias("entered_at_kst"),
        out_at.alias("exited_at"),
        seconds_between(F.col("created_at"), out_at).alias("dwell_sec"),
        left.alias("closed"),
    )


def sessions_by_account(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(
        kst_day("entered_at_kst").alias("d_kst"), "account_id"
    ).agg(
        rows().alias("sessions"),
        F.count_if("closed").alias("closed_sessions"),
        F.count("dwell_sec").alias("completed"),
    )


def safari_session_daily(sessions: DataFrame) -> DataFrame:
    return safari_session_from(sessions_by_account(sessions), sessions)


def safari_session_from(per_account: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions by day of entry, with exact median and 0.9 quantile of dwell."""
    day = per_account.groupBy("d_kst").agg(
        F.sum("sessions").alias("sessions"),
        F.count("account_id").alias("users"),
        F.sum("closed_sessions").alias("closed_sessions"),
    )
    stay = epoch_micros(F.col("exited_at")) - epoch_micros(F.col("entered_at"))
    dwell = exact_quantiles(
        sessions.select(kst_day("entered_at_kst").alias("d_kst"), stay.alias("_stay")),
        "d_kst",
        "_stay",
        {"dwell_median_sec": 0.5, "dwell_p90_sec": 0.9},
        few_groups=True,
        unit=1e6,
    )
    return day.join(dwell, "d_kst", "left").select(
        "d_kst",
        "sessions",
        "users",
        "closed_sessions",
        (1.0 - ratio(F.col("closed_sessions"), F.col("sessions"))).alias(
            "unclosed_rate"
        ),
        "dwell_median_sec",
        "dwell_p90_sec",
    )
