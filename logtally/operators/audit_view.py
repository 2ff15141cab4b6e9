"""The typed, masked view of the fact table that everything else reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtally.functions.values import to_kst, try_bigint, try_bool, try_double, try_int

# Payload keys, fetched as text in one pass over the variant. A payload that is
# no object, a missing key and a JSON null all give NULL.
_KEYS = (
    "mapId from to pokedexId level isShiny isS000Starter wildUid uid bait rock"
    " partyBonus reason fled result count claimed money item quantity totalCost"
    " totalGain url method errorCode"
).split()
_WANTED = (
    "struct<"
    + ", ".join(f"`{k}`: string" for k in _KEYS)
    + ", body: struct<_truncated: string>>"
)


def audit_v(audit: DataFrame) -> DataFrame:
    """Typed columns out of ``detail``; a missing or odd key gives NULL.

    Personal data stop here: URLs lose their query string, request bodies are
    not exposed (the login name sits in them), and ``ip`` never got this far.
    """

    def payload(path: str) -> Column:
        return F.col(f"_payload.{path}")

    fetched = F.try_variant_get("detail", "$", _WANTED)
    return audit.withColumn("_payload", fetched).select(
        "id",
        "account_id",
        "action",
        "status",
        "user_agent",
        "source",
        "created_at",
        to_kst(F.col("created_at")).alias("created_at_kst"),
        "detail",
        F.coalesce(payload("mapId"), payload("to")).alias("map_id"),
        payload("from").alias("map_from"),
        payload("to").alias("map_to"),
        # Stays text: variant forms such as "0058_hisui" have no number.
        payload("pokedexId").alias("pokedex_id"),
        try_int(payload("level")).alias("level"),
        try_bool(payload("isShiny")).alias("is_shiny"),
        F.coalesce(try_bool(payload("isS000Starter")), F.lit(False)).alias(
            "is_starter"
        ),
        F.coalesce(payload("wildUid"), payload("uid")).alias("wild_uid"),
        try_bool(payload("bait")).alias("used_bait"),
        try_bool(payload("rock")).alias("used_rock"),
        try_double(payload("partyBonus")).alias("party_bonus"),
        payload("reason").alias("catch_reason"),
        try_bool(payload("fled")).alias("catch_fled"),
        payload("result").alias("flee_result"),
        try_int(payload("count")).alias("spawn_count"),
        try_int(payload("claimed")).alias("ticket_claimed"),
        # Balance after the trade.
        try_bigint(payload("money")).alias("money_after"),
        payload("item").alias("item_id"),
        try_int(payload("quantity")).alias("quantity"),
        # The amount's key depends on the direction; pick first, then cast.
        try_bigint(F.coalesce(payload("totalCost"), payload("totalGain"))).alias(
            "trade_amount"
        ),
        F.split_part(payload("url"), F.lit("?"), F.lit(1)).alias("req_url"),
        payload("method").alias("req_method"),
        payload("errorCode").alias("error_code"),
        payload("body._truncated").isNotNull().alias("body_truncated"),
    )
