"""A copy of the drill-down for others, with pseudonyms in place of account ids.

    <out>/copies/<id>/metric=/d=/   JSON lines: category, pseudonym, count

A pseudonym is a keyed hash (HMAC-SHA256, half of it) of the id. Copies made
with the same salt can be joined on it, copies with different salts can't, and
without the salt the few possible ids can't be tried one after the other. A
record without an account keeps NULL. What was written is read back and checked
before a commit makes the copy the current one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtally.functions.values import rows
from logtally.sources import files

MIN_SALT = 16  # bytes
DIGITS = 32
_BLOCK = 64  # bytes of a SHA-256 block
COLUMNS = ("metric", "category", "d", "pseudonym", "count")
_LAYOUT = "category string, pseudonym string, count bigint, metric string, d date"


class LeakError(ValueError):
    """The copy still holds what must not leave."""


def pseudonym(account: Column, salt: str) -> Column:
    """Keyed hash of an id as hex text; NULL for NULL."""
    key = salt.encode()
    if not MIN_SALT <= len(key) <= _BLOCK:
        raise ValueError(f"a salt has {MIN_SALT} to {_BLOCK} bytes")
    key = key.ljust(_BLOCK, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in key)) for pad in (0x36, 0x5C))
    message = account.cast("string").cast("binary")
    hashed = F.sha2(F.concat(inner, message), 256)
    return F.left(F.sha2(F.concat(outer, F.unhex(hashed)), 256), F.lit(DIGITS))


def shared(counts: DataFrame, salt: str) -> DataFrame:
    """Contributor counts as they may leave."""
    return counts.withColumn("pseudonym", pseudonym(F.col("account_id"), salt)).select(*COLUMNS)


def leaks(copy: DataFrame) -> DataFrame:
    """(rule, metric, n): columns that are not meant to leave, and values that
    are no pseudonym, such as a plain id, counted per metric. Empty if sound."""
    whole = F.col("pseudonym").rlike(f"^[0-9a-f]{{{DIGITS}}}$")
    odd = (
        copy.where(F.col("pseudonym").isNotNull() & ~whole)
        .groupBy("metric")
        .agg(rows().alias("n"))
        .select(F.lit("no pseudonym").alias("rule"), "metric", "n")
    )
    extra = [(f"column {c}", None, 1) for c in copy.columns if c not in COLUMNS]
    layout = "rule string, metric string, n bigint"
    return copy.sparkSession.createDataFrame(extra, layout).unionByName(odd)


def publish(spark: SparkSession, counts: DataFrame, out: str, salt: str, made_at) -> str:
    """Write and check a copy; returns its folder. The salt is written nowhere."""
    root = out.rstrip("/")
    name = uuid.uuid4().hex
    folder = f"{root}/copies/{name}"
    (
        shared(counts, salt)
        .hint("rebalance", "metric", "d")
        .write.partitionBy("metric", "d")
        .json(folder, ignoreNullFields=False)
    )
    _refuse(leaks(_written(spark, folder)))
    number = files.last_number(spark, f"{root}/commits") + 1
    record = {"copy": name, "made_at": str(made_at)}
    files.create(spark, f"{root}/commits/{number:012d}.json", json.dumps(record))
    return folder


def _written(spark: SparkSession, folder: str) -> DataFrame:
    """All columns that the files have, whatever was meant; text stays text."""
    return spark.read.option("primitivesAsString", True).json(folder)


def _refuse(found: DataFrame) -> None:
    some = found.limit(20).collect()
    if some:
        raise LeakError("; ".join(str(r) for r in some))


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_LAYOUT).json(folder).select(*COLUMNS)
