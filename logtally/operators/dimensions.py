"""Dimension views and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtally.functions.values import try_bigint, try_double, try_int


def _clean(name: str) -> Column:
    """The files have CRLF ends; strip what the reader leaves behind."""
    return F.regexp_replace(F.col(name), r"\r+$", "")


def _padded_key(raw: Column) -> Column:
    """Digits-only ids get at least four digits; other ids stay verbatim."""
    short_number = raw.rlike(r"\A[0-9]{1,3}\z")
    return F.when(short_number, F.lpad(raw, 4, "0")).otherwise(raw)


def pokemon_dim(master: DataFrame) -> DataFrame:
    raw = _clean("id")
    return master.select(
        _padded_key(raw).alias("pokedex_id"),
        raw.alias("pokedex_id_raw"),
        try_int(raw).alias("pokedex_num"),
        _clean("comment").alias("name_ko"),
        _clean("type1").alias("type1"),
        F.nullif(_clean("type2"), F.lit("")).alias("type2"),
        *[_clean(c).alias(c) for c in ("tier", "generation", "growth_group")],
        *[
            try_double(_clean(c)).alias(c)
            for c in ("rate_capture", "rate_flee", "height_m", "weight_kg")
        ],
        try_int(_clean("base_exp")).alias("base_exp"),
    )


def item_dim(master: DataFrame) -> DataFrame:
    def flag(name: str) -> Column:
        return (F.upper(_clean(name)) == "TRUE").alias(name)

    return master.select(
        _clean("id").alias("item_id"),
        _clean("comment").alias("name_ko"),
        _clean("category").alias("category"),
        _clean("tier").alias("tier"),
        try_bigint(_clean("buy")).alias("buy_price"),
        try_bigint(_clean("sell")).alias("sell_price"),
        flag("purchasable"),
        flag("sellable"),
    )


def orphan_keys(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """One row per fact whose key the dimension lacks.

    An empty dimension means "not delivered yet" and reports nothing. No
    broadcast hint: Spark broadcasts by measured size, and otherwise splits
    the hot keys of the left side (AQE does so for anti joins).
    """
    known = dim.select(key)
    return (
        facts.where(F.col(key).isNotNull())
        .select(key)
        .where(known.exists())
        .join(known, key, "left_anti")
    )
