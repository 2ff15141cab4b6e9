"""Versioned dimension files next to the archive."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from logtally.schema import DIM_VERSION, ITEM_FILE, POKEMON_FILE
from logtally.functions.values import instant
from logtally.sources.archive import is_missing_path


class Dims(NamedTuple):
    pokemon: DataFrame
    item: DataFrame
    version: DataFrame


def stub(spark: SparkSession) -> Dims:
    """Empty dimensions: the normal state until files are delivered."""
    return Dims(*[spark.createDataFrame([], s) for s in (POKEMON_FILE, ITEM_FILE, DIM_VERSION)])


def read_dims(spark: SparkSession, base: str, as_of) -> Dims | None:
    """The version that ``master/LATEST`` names; None where there is none.

    All columns stay strings; the views cast them. ``LATEST`` is one short
    line, so reading it on the driver is bounded.
    """
    root = f"{base.rstrip('/')}/master"

    def table(name: str) -> DataFrame:
        return spark.read.csv(f"{root}/v={sha}/{name}.csv", header=True, escape='"')

    try:
        latest = spark.read.text(f"{root}/LATEST", wholetext=True).first()
        sha = latest.value.strip() if latest else ""
        if not sha:
            return None
        pokemon, item = table("pokemon"), table("item")
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise
    version = spark.range(1).select(
        F.lit(sha).alias("sha"), instant(as_of).alias("loaded_at")
    )
    return Dims(pokemon, item, version)
