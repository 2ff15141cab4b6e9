"""Sets of ids as bitmaps: repeats, jumps and differences without shuffling ids.

Ids come from a sequence, so they are dense. A bucket of 2^15 neighbouring ids
is one bitmap of 4 KB; rows lie in id order, so a task has few buckets, fills
their bitmaps itself and sends these, not its ids. Everything asked about ids
then follows from the bitmaps of a bucket, or from the first and last ids of
neighbouring buckets. Sparse ids would cost a bitmap each: ``id_gaps`` is the
operator for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtally.functions.values import rows
from logtally.operators.id_gaps import GAP_THRESHOLD, interval_gaps

_BITS = 1 << 15  # of one bitmap, as the built-in functions have it
_BYTES = _BITS // 8

JUMP = "struct<prev:bigint,id:bigint>"


def bucket(id_: Column) -> Column:
    return F.bitmap_bucket_number(id_)


def id_sets(ids: DataFrame, **named: Column) -> DataFrame:
    """One row per bucket: ``n`` rows and, per name, the bitmap of the ids for
    which its condition holds, with the ``_first`` and ``_last`` of them."""
    bit, sets = F.bitmap_bit_position("id"), []
    for name, test in named.items():
        held = F.when(test, F.col("id"))
        sets.append(F.bitmap_construct_agg(F.when(test, bit)).alias(name))
        sets += [F.min(held).alias(f"{name}_first"), F.max(held).alias(f"{name}_last")]
    return (
        ids.where(F.col("id").isNotNull()).groupBy(bucket(F.col("id")).alias("bucket")).agg(rows().alias("n"), *sets)
    )


def members(bitmap: Column, number: Column) -> Column:
    """The ids of a bitmap, ascending."""
    byte = F.transform(
        F.sequence(F.lit(0), F.lit(_BYTES - 1)),
        lambda i: F.struct(
            i.alias("at"), F.conv(F.hex(F.substring(bitmap, i + 1, F.lit(1))), 16, 10).cast("int").alias("bits")
        ),
    )
    eight = F.array(*[F.lit(k) for k in range(8)])

    def bits_of(b: Column) -> Column:
        kept = F.filter(eight, lambda k: F.getbit(b.bits, k) == 1)
        return F.transform(kept, lambda k: b.at * 8 + k)

    bits = F.flatten(F.transform(F.filter(byte, lambda b: b.bits > 0), bits_of))
    first = (number - 1) * _BITS + 1
    # Ids below 1 are counted away from zero.
    below = F.sort_array(F.transform(bits, lambda p: number * _BITS - p))
    return F.when(number > 0, F.transform(bits, lambda p: first + p)).otherwise(below)


def jumps_inside(ids: Column, threshold: int) -> Column:
    """Neighbours in an ascending array that lie further apart than ``threshold``."""
    behind = F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))
    pairs = F.zip_with(
        F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0))),
        behind,
        lambda a, b: F.struct(a.alias("prev"), b.alias("id")),
    )
    return F.filter(pairs, lambda p: p.id - p.prev > threshold).cast(f"array<{JUMP}>")


def jumps(sets: DataFrame, name: str, threshold: int = GAP_THRESHOLD) -> DataFrame:
    """(prev, id): neighbouring ids of the named sets further apart than ``threshold``.

    One row per bucket tells its jumps and its ends; between buckets the ends
    are compared. Only bitmaps with as many zero bytes in a row as such a jump
    leaves are looked into.
    """
    zeros = max(0, (threshold - 14) // 8)
    hollow = F.lit(True) if zeros == 0 else F.contains(F.hex(name), F.lit("00" * zeros))
    none = F.array().cast(f"array<{JUMP}>")
    ids = F.array(members(F.col(name), F.col("bucket")))
    # In a one-element array, so that the ids are unpacked once per bucket.
    inside = F.transform(ids, lambda i: jumps_inside(i, threshold))[0]
    found = sets.where(F.col(f"{name}_first").isNotNull()).select(
        F.when(hollow, inside).otherwise(none).alias("inside"),
        F.col(f"{name}_first").alias("first"),
        F.col(f"{name}_last").alias("last"),
    )
    ends = F.array(F.struct(F.col("first").alias("prev"), F.col("last").alias("id"), F.lit(True).alias("end")))
    inner = F.transform("inside", lambda j: F.struct(j.prev.alias("prev"), j.id.alias("id"), F.lit(False).alias("end")))
    tagged = found.select(F.inline(F.concat(inner, ends)))
    between = interval_gaps(
        tagged.where("end").select(F.col("prev").alias("_first"), F.col("id").alias("_last")), threshold
    )
    return tagged.where("NOT end").select("prev", "id").unionByName(between)


def repeated(ids: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """(id, n): ids that stand in more than one row; ``ids`` may have other columns.

    A bucket with more rows than bits has some. Only rows of such buckets are
    grouped by id; sound data have none.
    """
    suspect = sets.where(F.col("n") > F.bitmap_count(name)).select("bucket")
    inside = ids.select("id", bucket(F.col("id")).alias("bucket")).join(suspect, "bucket", "left_semi")
    return inside.groupBy("id").agg(rows().alias("n")).where("n > 1")


def lacking(one: DataFrame, other: DataFrame, name: str) -> DataFrame:
    """(from_id, to_id, n) per bucket with ids of ``one`` that ``other`` lacks.

    Equal bitmaps, and buckets that ``other`` has nothing of, are not looked into.
    """
    both = one.select("bucket", F.col(name).alias("a"), f"{name}_first", f"{name}_last").join(
        other.select("bucket", F.col(name).alias("b")), "bucket", "left"
    )

    def finding(first: Column, last: Column, n: Column) -> Column:
        return F.struct(first.alias("from_id"), last.alias("to_id"), n.cast("bigint").alias("n"))

    number = F.col("bucket")
    lost = F.array(F.array_except(members(F.col("a"), number), members(F.col("b"), number)))
    some = F.transform(lost, lambda i: finding(F.array_min(i), F.array_max(i), F.size(i)))[0]
    every = finding(F.col(f"{name}_first"), F.col(f"{name}_last"), F.bitmap_count("a"))
    return (
        both.where(~F.col("a").eqNullSafe(F.col("b")))
        .select(F.when(F.col("b").isNull(), every).otherwise(some).alias("lost"))
        .select("lost.*")
        .where("n > 0")
    )
