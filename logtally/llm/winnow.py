"""Document fingerprints by winnowing, with built-in functions only.

A text is a row of units: words of up to ``LONG`` code points, and the single
code points of longer ones, so that text without spaces is cut too. Every run of
``K`` units has a polynomial hash modulo a prime, the value that a rolling hash
has at this place. Array functions carry no state from one element to the next,
so the value is put together from those of half as many units. Of every
``WINDOW`` neighbouring runs the smallest is chosen, the rightmost of equal ones,
once for all windows that choose it, with its position. Two texts that share
``K + WINDOW - 1`` units in a row share a mark. Texts of up to ``SHORT`` code
points have few units, so they have a second level of marks over all their code
points, in runs of ``SHORT_K``, and share one with 15 code points in common. So
of texts of 30 code points or more, with single spaces between words, half is
always enough to share a mark. With fewer units than a run, runs are halved until
they fit; with fewer runs than a window, the smallest is chosen. A text without
words (a null or empty one too) has no marks on the first level, one without
code points none at all.

Likeness is shared hashes over all hashes of two texts; 1 for two texts
without any. The next document of the last one is the first; a null id has no
next document, so its second half is cut off. Of rows with equal ids one (the
greatest text) is the next document of others, and all have the same next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

K, WINDOW = 4, 8  # powers of two
LONG = 15
SHORT, SHORT_K = 512, 8
PRIME, BASE = (1 << 31) - 1, 1_000_003
_LOW = (1 << 32) - 1
_UNIT = rf"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{{1,{LONG}}}(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def smallest(values: Column, width: int) -> Column:
    """The least of each element and those behind it, windows doubled up to WINDOW."""
    if width == WINDOW:
        return values
    wider = F.transform(values, lambda v, i: F.least(v, F.get(values, i + width)))
    return let(wider, lambda w: smallest(w, width * 2))


def rolled(values: Column, k: int, width: int = 1) -> Column:
    """Polynomial hashes of all runs of ``k`` of ``values``, or of half as many until they fit."""
    if width == k:
        return values
    power = F.lit(pow(BASE, width, PRIME)).cast("bigint")
    wider = F.transform(
        F.slice(values, 1, F.size(values) - width),
        lambda v, i: (v * power + F.get(values, i + width)) % F.lit(PRIME),
    )
    return F.when(F.size(values) <= width, values).otherwise(let(wider, lambda w: rolled(w, k, width * 2)))


def _chosen(units: Column, k: int) -> Column:
    """Chosen runs of an array of units, as longs: hash above, position from the right below."""
    hashes = F.transform(units, lambda u: F.xxhash64(u).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(PRIME))

    def chosen(values: Column) -> Column:
        # With the position below the hash, the least is also the rightmost of equals.
        placed = F.transform(values, lambda v, i: F.shiftleft(v, 32) + (F.lit(_LOW) - i))
        last = F.greatest(F.size(values) - WINDOW + 1, F.lit(1))
        return let(placed, lambda p: F.array_distinct(F.slice(smallest(p, 1), 1, last)))

    return let(hashes, lambda h: let(rolled(h, k), chosen))


def marks(text: Column) -> Column:
    """Chosen runs of a text's units, and of its code points if it is short: two arrays."""
    short = F.when(
        F.char_length(text) <= SHORT,
        _chosen(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), SHORT_K),
    )
    return F.struct(
        _chosen(F.regexp_extract_all(text, F.lit(_UNIT), F.lit(0)), K).alias("units"),
        F.coalesce(short, F.array().cast("array<bigint>")).alias("points"),
    )


def fingerprint(found: Column) -> Column:
    """Chosen hashes as hash:position, in order of position; behind a bar those of code points."""

    def level(marks: Column) -> Column:
        return F.array_join(
            F.transform(
                marks,
                lambda v: F.concat_ws(":", F.lower(F.hex(F.shiftright(v, 32))), F.lit(_LOW) - v.bitwiseAND(F.lit(_LOW))),
            ),
            " ",
        )

    points = F.when(F.size(found["points"]) > 0, F.concat(F.lit("|"), level(found["points"])))
    return F.concat(level(found["units"]), F.coalesce(points, F.lit("")))


def hashes(found: Column) -> Column:
    """Distinct hashes of both levels, those of code points as negative numbers."""
    units = F.transform(found["units"], lambda v: F.shiftright(v, 32).cast("int"))
    points = F.transform(found["points"], lambda v: (-F.shiftright(v, 32) - 1).cast("int"))
    return F.array_distinct(F.concat(units, points))


def likeness(one: Column, other: Column) -> Column:
    return let(
        F.array(F.size(F.array_intersect(one, other)), F.size(one) + F.size(other)),
        lambda n: F.when(n[1] == 0, 1.0).otherwise(n[0] / (n[1] - n[0])),
    )


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id) in descending order of distinct ids, the first after the last.

    Ids only: dealt out by range, numbered neighbours inside a range, and one
    row per range for the neighbours across.
    """
    placed = ids.repartitionByRange(F.col("id")).withColumn("range", F.spark_partition_id())
    inside = F.max("id").over(
        Window.partitionBy("range").orderBy("id").rowsBetween(-1, -1)
    )
    linked = placed.select("id", "range", inside.alias("inside"))
    tops = placed.groupBy("range").agg(F.max("id").alias("top"))  # a row per partition
    below = F.lag("top").over(Window.orderBy("range"))
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    across = tops.select("range", F.coalesce(below, F.max("top").over(whole)).alias("across"))
    return linked.join(across, "range").select("id", F.coalesce("inside", "across").alias("next_id"))


def fingerprints(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of its edited text; see the module."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    # Text and marks are shuffled once, by id, and read by both joins below.
    known = rows.where("id IS NOT NULL")
    dealt = known.select("id", "text", marks(F.col("text")).alias("marks")).repartition("id")
    half = F.floor(F.char_length("text") / 2).cast("int")
    halves = known.groupBy("id").agg(F.max(half).alias("half"), F.count("id").alias("n"))
    pairs = next_ids(halves.select("id")).join(halves, "id")
    giver = dealt
    if halves.where("n > 1").take(1):
        giver = dealt.groupBy("id").agg(
            F.max("text").alias("text"), F.max_by("marks", "text").alias("marks")
        )
    heads = (
        pairs.select(F.col("id").alias("taker"), "half", F.col("next_id").alias("id"))
        .join(giver, "id")
        .select("taker", F.expr("left(text, half)").alias("head"), hashes(F.col("marks")).alias("next_set"))
    )
    n = F.char_length("text")
    edited = F.concat(F.expr("left(text, char_length(text) - int(char_length(text) / 2))"), F.expr("coalesce(left(head, int(char_length(text) / 2)), '')"))
    alone = rows.where("id IS NULL").select(
        "id", "text", marks(F.col("text")).alias("marks"), F.lit(None).cast("string").alias("head"),
        F.lit(None).cast("array<int>").alias("next_set"),
    )
    both = (
        dealt.join(heads.withColumnRenamed("taker", "id"), "id", "left")
        .unionByName(alone)
        .select("id", n.alias("n_chars"), "marks", "next_set", edited.alias("edited"))
        .select("*", marks(F.col("edited")).alias("edited_marks"))
    )
    return both.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("marks")).alias("fingerprint"),
        fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(hashes(F.col("marks")), hashes(F.col("edited_marks"))).alias("near_edited"),
        likeness(hashes(F.col("marks")), F.coalesce("next_set", F.array().cast("array<int>"))).alias("near_next"),
    )
