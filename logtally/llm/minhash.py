"""Near-duplicate texts by word shingles: fast similarity sketching, banding, exact check.

A text's set is its distinct five-word shingles (all its words as one shingle
if it has fewer, nothing without words). Texts are linked when 100 times the
intersection is at least 75 times the union; components are the closure.

* Sketching: in round i every shingle is thrown into one of the ``BINS`` bins
  by a hash of its own, carrying (i, value); a bin keeps the minimum. Rounds go
  on until all bins are full; from round ``BINS`` on, round i throws all
  shingles into bin i - BINS, so after twice as many rounds none is empty.
* Banding: ``ROWS`` bins make a band key; texts sharing a key are candidates.
* Equal sets are one class first, found by a 128-bit digest, so a crowd of
  copies is one row below.
* Inside a bucket every member is compared with the bucket's hub, a linear
  number of pairs. Hubs are drawn by a hash of bucket and id, so the buckets
  of a crowd of near copies have many different ones. Members of a bucket that
  are still in different components are compared with two more hubs at once.
  What is open after that is gathered into groups that share buckets, cut
  into blocks of ``SIDE``, and every two blocks of a group meet in a task that
  counts intersections of full sets and returns spanning links only: no pair
  that shares a bucket stays unanswered unless it is already connected, and no
  pair becomes a row.
* Every link is confirmed on full sets. ``BINS`` and ``ROWS`` lose a pair at
  similarity 0.75 with a probability of about 5e-6.

Null texts count as empty; texts without words are alone. Rows with equal ids
are copies of one id and share its component, with the larger of their sets;
a null id is never linked and keeps itself out of the result's ``kept`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtally.llm.shared import components, held, written
from logtally.llm.words import Words, lists, mix, parts, seeds, shingles

K = 5
BINS, ROWS = 128, 4
OF_100 = 75
HUBS = 3
SIDE = 256  # rows of a block

_ROUND = seeds(2 * BINS, 3)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BINS values per set; rows of empty sets are all ones."""
    out = np.full((len(sets), BINS), _FULL)
    todo = np.array([i for i, s in enumerate(sets) if len(s)], dtype=np.int64)
    for i in range(2 * BINS):
        if not len(todo):
            break
        sizes = np.array([len(sets[d]) for d in todo])
        h = mix(np.concatenate([sets[d] for d in todo]) ^ _ROUND[i])
        bins = (h & np.uint64(BINS - 1)).astype(np.int64) if i < BINS else i - BINS
        value = (np.uint64(i) << np.uint64(48)) | (h >> np.uint64(16))
        np.minimum.at(out.reshape(-1), np.repeat(todo, sizes) * BINS + bins, value)
        todo = todo[(out[todo] == _FULL).any(axis=1)]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    n = len(sketch)
    grouped = sketch.reshape(n, BINS // ROWS, ROWS)
    keys = np.zeros((n, BINS // ROWS), dtype=np.uint64)
    for r in range(ROWS):
        keys = mix(keys ^ grouped[:, :, r])
    return mix(keys + seeds(BINS // ROWS, 4)[None, :])


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "n", "d1", "d2", "bands"]
    for part in parts(batches):
        sets = list(shingles(Words(part.column("text")), K))
        keys = band_keys(sketches(sets))
        bands = [keys[i] if len(s) else keys[i, :0] for i, s in enumerate(sets)]
        digest = [
            np.array([mix(s ^ salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            for salt in seeds(2, 5)
        ]
        sizes = pa.array([len(s) for s in sets], pa.int64())
        columns = [part.column("id"), sizes, *map(pa.array, digest), lists(bands, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches):
        sets = list(shingles(Words(part.column("text")), K))
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), lists(sets, pa.int64())], names=["id", "items"]
        )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .where(both * 100 >= (F.size("x") + F.size("y") - both) * OF_100)
        .select("a", "b")
    )


def _block_links(table: pa.Table) -> pa.Table:
    """Links between components among the rows of two blocks, as many as join them."""
    ids, roots = (table.column(c).to_numpy() for c in ("id", "root"))
    first = table.column("first").to_numpy(zero_copy_only=False)
    items = table.column("items").combine_chunks()
    values, sizes = items.flatten().to_numpy(), np.diff(items.offsets.to_numpy())
    starts = np.cumsum(sizes) - sizes
    _, values = np.unique(values, return_inverse=True)
    group = {r: r for r in roots.tolist()}

    def top(r: int) -> int:
        while group[r] != r:
            r = group[r]
        return r

    cross = first.any() and not first.all()
    others = np.flatnonzero(~first) if cross else np.arange(len(ids))
    links: list[tuple[int, int]] = []
    inside = np.zeros(int(values.max(initial=0)) + 1, dtype=np.int64)
    for i in np.flatnonzero(first) if cross else range(len(ids)):
        own = values[starts[i] : starts[i] + sizes[i]]
        inside[own] = 1
        both = np.add.reduceat(inside[values], starts)[others]
        inside[own] = 0
        near = both * 100 >= (sizes[i] + sizes[others] - both) * OF_100
        for j in others[near].tolist():
            a, b = top(int(roots[i])), top(int(roots[j]))
            if a != b:
                group[max(a, b)] = min(a, b)
                links.append((int(ids[i]), int(ids[j])))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _in_blocks(spark: SparkSession, open_rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components among rows (band, id, root) that share bands."""
    low = open_rows.groupBy("band").agg(F.min("id").alias("low"))
    met = open_rows.join(low, "band").select(F.col("low").alias("a"), F.col("id").alias("b"))
    groups = components(spark, met.distinct())  # bands name the same two again
    named = open_rows.select("id", F.col("root").alias("component")).distinct().join(groups, "id")
    sizes = named.groupBy(F.col("root")).agg(F.ceil(F.count("id") / SIDE).alias("blocks"))
    own = named.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        F.col("root").alias("group"),
        F.least("block", "other").alias("lo"),
        F.greatest("block", "other").alias("hi"),
        "id",
        F.col("component").alias("root"),
        (F.col("block") <= F.col("other")).alias("first"),
    )
    return (
        dealt.join(sets, "id")
        .select("group", "lo", "hi", "id", "root", "first", "items")
        .groupBy("group", "lo", "hi")
        .applyInArrow(_block_links, "a long, b long")
    )


def _hub(turn: int) -> Column:
    return F.min(F.struct(F.xxhash64("band", "id", F.lit(turn)), "id"))["id"]


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per id: (id, n_shingles, component_id)."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = "id long, n long, d1 long, d2 long, bands array<long>"
    sketch = written(spark, texts.mapInArrow(_sketch_rows, rows), "sketch")

    filled = sketch.where("n > 0 AND id IS NOT NULL").select("id", "n", "d1", "d2")
    classes = filled.groupBy("n", "d1", "d2").agg(
        F.min("id").alias("rep"), F.count("id").alias("copies")
    )
    crowds = written(spark, classes.where("copies > 1").drop("copies"), "classes")
    copies = written(
        spark,
        filled.join(crowds, ["n", "d1", "d2"]).select("id", "rep").where("id <> rep"),
        "copies",
    )

    # Buckets of class representatives; sizes too far apart can't be linked.
    reps = sketch.where("n > 0 AND id IS NOT NULL").join(copies.select("id"), "id", "left_anti")
    banded = reps.select("id", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), *[_hub(i).alias(f"hub{i}") for i in range(HUBS)]
    ).where("low <> high").drop("low", "high")
    member = written(spark, banded.join(shared, "band").distinct(), "buckets")
    sized = member.select("id", "n").distinct()

    def close(pairs: DataFrame) -> DataFrame:
        """Distinct unordered pairs whose sizes allow the threshold."""
        pairs = pairs.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).distinct()
        one, two = (sized.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
        fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * OF_100
        return pairs.join(one, "a").join(two, "b").where(fits).select("a", "b")

    wanted = member.select("id").distinct()
    sets = written(
        spark,
        texts.join(wanted, "id", "left_semi")
        .mapInArrow(_set_rows, "id long, items array<long>")
        .groupBy("id").agg(F.max_by("items", F.size("items")).alias("items"))
        if _repeated(filled)
        else texts.join(wanted, "id", "left_semi").mapInArrow(_set_rows, "id long, items array<long>"),
        "sets",
    )
    root = components(spark, _verified(close(member.select(F.col("hub0").alias("a"), F.col("id").alias("b"))), sets))
    others = [f"hub{i}" for i in range(1, HUBS)]
    for hubs in (others, []):
        placed = written(
            spark,
            member.join(root, "id", "left").select(*hubs, "band", "id", F.coalesce("root", "id").alias("root")),
            "placed",
        )
        ends = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        mixed = held(spark, ends.where("lo <> hi").select("band"))
        if mixed.isEmpty():  # every bucket lies in one component
            break
        open_rows = placed.join(mixed, "band", "left_semi")
        if hubs:
            hub = placed.select("band", F.col("id").alias("a"), F.col("root").alias("r_hub"))
            drawn = open_rows.withColumn("a", F.explode(F.array_distinct(F.array(*hubs))))
            pairs = drawn.join(hub, ["band", "a"]).where("root <> r_hub")
            found = _verified(close(pairs.select("a", F.col("id").alias("b"))), sets)
        else:
            found = _in_blocks(spark, open_rows, sets)
        late = held(spark, found)
        if not late.isEmpty():  # else the components stay as they are
            tied = root.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
            root = components(spark, tied.unionByName(late))

    roots = (
        copies.join(root.withColumnRenamed("id", "rep"), "rep", "left")
        .select("id", F.coalesce("root", "rep").alias("root"))
        .unionByName(root)
        .distinct()
    )
    return sketch.select("id", F.col("n").alias("n_shingles")).join(roots, "id", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("root", "id").alias("component_id")
    )


def _repeated(filled: DataFrame) -> bool:
    """Whether any id comes twice with a set; ids only, no text is moved."""
    return bool(filled.groupBy("id").agg(F.count("n").alias("m")).where("m > 1").take(1))


def deduplicate(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one row per group of near-duplicates: the smallest doc_id.

    Rows with a null id are kept; of rows with equal ids one is kept.
    """
    found = near_duplicates(spark, docs)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    if _repeated(docs.select(F.col("doc_id").alias("id"), F.lit(1).alias("n")).where("id IS NOT NULL")):
        named = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        kept = named.unionByName(kept.where("doc_id IS NULL"))
    return kept
