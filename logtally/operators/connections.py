"""How long accounts stay connected: sessions by gap.

Every event of an account is a sign that it is there; signs no further apart
than the gap make one session. A session with a disconnect as its last sign is
closed, others ended without one or go on. A disconnect of a socket that did
not own the account's slot says nothing about the account and is left out.

Sessions are found inside cells of an account and an hour first; then the few
sessions of the cells are merged, so an account with very many events is spread
over its hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtally.functions.values import (
    epoch_micros,
    payload,
    ratio,
    rows,
    seconds_between,
    to_kst,
    try_bool,
)
from logtally.operators.quantiles import exact_quantiles

CONNECT, DISCONNECT = "SOCKET_CONNECT", "SOCKET_DISCONNECT"
GAP_MINUTES = 30
_MINUTE = 60_000_000  # microseconds
_CELL_MINUTES = 60


def connection_session(v: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """One row per session; ``length_sec`` from its first to its last sign.

    Signs exactly one gap apart still belong together. Rows without account or
    time are no signs. Of signs at the same time the one with the greatest id
    is the last.
    """
    owned = F.coalesce(try_bool(payload("ownedSlot")), F.lit(True))
    connect, disconnect = F.col("action") == CONNECT, F.col("action") == DISCONNECT
    time = F.col("created_at")
    signs = v.where(
        F.col("account_id").isNotNull() & time.isNotNull() & (owned | ~disconnect)
    ).select(
        "account_id",
        "created_at",
        "id",
        connect.alias("_in"),
        disconnect.alias("_out"),
        F.floor(epoch_micros(time) / (_CELL_MINUTES * _MINUTE)).alias("_cell"),
    )
    reach = F.session_window("created_at", f"{gap_minutes} minutes")
    pieces = signs.groupBy("account_id", "_cell", reach.alias("_reach")).agg(
        F.min("created_at").alias("_from"),
        F.max("created_at").alias("_to"),
        rows().alias("events"),
        F.count_if("_in").alias("connects"),
        F.count_if("_out").alias("disconnects"),
        F.max(F.struct("created_at", "id", F.col("_out").alias("out"))).alias("_last"),
    )
    account = Window.partitionBy("account_id").orderBy("_from")
    since = epoch_micros(F.col("_from")) - epoch_micros(F.lag("_to").over(account))
    opens = F.coalesce(since > gap_minutes * _MINUTE, F.lit(True)).cast("int")
    return (
        pieces.withColumn("_opens", opens)
        .withColumn("_session", F.sum("_opens").over(account))
        .groupBy("account_id", "_session")
        .agg(
            F.min("_from").alias("started_at"),
            F.max("_to").alias("ended_at"),
            *[F.sum(c).alias(c) for c in ("events", "connects", "disconnects")],
            F.max("_last").alias("_last"),
        )
        .select(
            "account_id",
            "started_at",
            "ended_at",
            seconds_between(F.col("started_at"), F.col("ended_at")).alias("length_sec"),
            "events",
            "connects",
            "disconnects",
            F.col("_last.out").alias("closed"),
        )
    )


def connection_daily(sessions: DataFrame) -> DataFrame:
    """Sessions by local day of their start; exact median and 0.9 quantile of length."""
    day = to_kst(F.col("started_at")).cast("date")
    length: Column = epoch_micros(F.col("ended_at")) - epoch_micros(F.col("started_at"))
    dated = sessions.select("account_id", "closed", day.alias("d_kst"), length.alias("_length"))
    per_account = dated.groupBy("d_kst", "account_id").agg(
        rows().alias("sessions"), F.count_if("closed").alias("closed"), F.sum("_length").alias("_time")
    )
    totals = per_account.groupBy("d_kst").agg(
        rows().alias("users"),
        F.sum("sessions").alias("sessions"),
        F.sum("closed").alias("closed_sessions"),
        F.sum("_time").alias("_time"),
    )
    spread = exact_quantiles(
        dated, "d_kst", "_length", {"length_median_sec": 0.5, "length_p90_sec": 0.9}, few_groups=True, unit=1e6
    )
    return totals.join(spread, "d_kst", "left").select(
        "d_kst",
        "sessions",
        "users",
        "closed_sessions",
        ratio(F.col("_time"), F.col("users") * 1_000_000).alias("mean_sec_per_user"),
        "length_median_sec",
        "length_p90_sec",
    )
