"""Merkle dataset manifest: every row proved under one root.

Rows become leaves, leaves of one group (by id) a tree of runs of ``ARITY``
nodes, the group roots, ordered by group, a tree of the same kind on top. A run
becomes the digest of its nodes' hex texts put together, also a run of one node
while the level has others; a level of one node is the root.

Trees are built in aligned blocks of ``BLOCK`` nodes. A block keeps each of its
levels as one hex string; parents are hashes of fixed-width substrings, and the
siblings of a node are what stands left and right of it in its run. Block roots
are the nodes of the next table of blocks, until a group has one block. Only
digests are shuffled, never texts, and a group of any size is dealt out by
ranges of ids: no task sees more of it than a range or a block.

Null groups come first, null ids before others, rows of equal id in order of
their leaves. An empty table gives an empty manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from logtally.llm.shared import written

ARITY, HEIGHT = 3, 5
BLOCK = ARITY**HEIGHT
WIDTH = 64  # hex digits of a digest
_ROW_BITS = 33  # of monotonically_increasing_id: rows of a partition below, its number above

_ALL = "all"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """Digest of a row: each value as byte count, colon, text; ``-`` for null."""
    texts = [v.cast("string") for v in values]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(F.concat(*[F.coalesce(s, F.lit("-")) for s in sized]))


def group_key(value: Column) -> Column:
    """Never null, and in the order of null first, then the value's bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def numbered(spark: SparkSession, nodes: DataFrame, order: list[str]) -> DataFrame:
    """Nodes with ``pos`` (from 0) and ``total`` within ``grp``.

    ``nodes`` is a written table. It is sorted by ranges, so a large group lies
    in many partitions; the sums of the ranges before give the positions.
    """
    keys = [F.col("grp"), *[F.col(c).asc_nulls_first() for c in order]]
    at = F.monotonically_increasing_id()
    dealt = written(
        spark,
        nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", at),
        "merkle-order",
    )
    part = F.shiftright("at", _ROW_BITS).alias("part")
    row = F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranges = Window.partitionBy("grp")
    before = ranges.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        dealt.groupBy("grp", part)
        .agg(F.min(row).alias("first"), F.count("at").alias("n"))
        .select(
            "grp",
            "part",
            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("n").over(ranges).alias("total"),
        )
    )
    return (
        dealt.withColumn("part", part)
        .join(spans, ["grp", "part"])
        .withColumn("pos", row + F.col("shift"))
        .select(*nodes.columns, "pos", "total")
    )


def _parents(level: Column) -> Column:
    """The next level: the digests of the runs of a level's hex string."""
    last = F.floor((F.octet_length(level) - 1) / (ARITY * WIDTH)).cast("int")
    run = lambda i: F.substr(level, i * (ARITY * WIDTH) + 1, F.lit(ARITY * WIDTH))
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: digest(run(i))), "")


def blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (grp, pos, total, digest, data) as rows of aligned blocks.

    ``members`` are the block's nodes in order, ``levels`` its levels from them
    up to one digest. All blocks of a group with several rise by ``HEIGHT``.
    """
    members = F.sort_array(F.collect_list(F.struct("pos", "digest", "data")))
    grouped = (
        nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block"))
        .agg(members.alias("members"), F.max("total").alias("total"))
    )
    ground = F.array_join(F.transform("members", lambda m: m.digest), "")
    height = sum([(F.col("total") > ARITY**k).cast("int") for k in range(HEIGHT)], F.lit(0))
    steps = F.slice(F.array(*[F.lit(k) for k in range(HEIGHT)]), F.lit(1), height)
    rise = lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1))))
    return grouped.withColumn("levels", F.aggregate(steps, F.array(ground), rise))


def _siblings(levels: Column, place: Column) -> Column:
    """What flanks a node's ancestors in their runs, level by level."""

    def flanks(level: Column, k: Column) -> Column:
        node = F.floor(place / F.pow(F.lit(ARITY), k)).cast("int")
        inside = node % ARITY
        left = F.substr(level, (node - inside) * WIDTH + 1, inside * WIDTH)
        right = F.substr(level, (node + 1) * WIDTH + 1, (ARITY - 1 - inside) * WIDTH)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), flanks)


def _no_siblings() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def climbed(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Blocks of the nodes, each with its ``root`` and the ``path`` from its top."""
    own = written(spark, blocks(nodes), "merkle-blocks").withColumn(
        "top", F.element_at("levels", -1)
    )
    above = own.where(F.col("total") > BLOCK).select(
        "grp",
        F.col("block").alias("pos"),
        F.ceil(F.col("total") / BLOCK).alias("total"),
        F.col("top").alias("digest"),
        F.lit(None).cast("string").alias("data"),
    )
    if above.isEmpty():
        return own.withColumns({"path": _no_siblings(), "root": F.col("top")})
    higher = proved(climbed(spark, above)).select(
        "grp", F.col("pos").alias("block"), F.col("proof").alias("path"), "root"
    )
    return (
        own.join(higher, ["grp", "block"], "left")
        .withColumn("path", F.coalesce("path", _no_siblings()))
        .withColumn("root", F.coalesce("root", "top"))
    )


def proved(found: DataFrame, *others: str) -> DataFrame:
    """Blocks as nodes again: (grp, pos, digest, data, proof, root, others)."""

    def member(m: Column) -> Column:
        place = m.pos - F.col("block") * BLOCK
        proof = F.concat(_siblings(F.col("levels"), place), F.col("path"))
        return F.struct(m.pos.alias("pos"), m.digest.alias("digest"), m.data.alias("data"), proof.alias("proof"))

    return found.select("grp", "root", *others, F.inline(F.transform("members", member)))


def manifest(
    spark: SparkSession,
    docs: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    group_col: str = "source",
    kept: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its leaf over ``fields`` and its proof.

    Returns ``id_col``, ``group_col``, leaf, subroot, root, proof (array of
    left and right: the siblings' hex texts, from the leaf's run up to the
    root's) and the columns ``kept`` (names other than these, as expressions
    over ``docs``). Other columns of ``docs`` are not returned.
    """
    kept = kept or {}
    names = [f"kept_{i}" for i in range(len(kept))]
    leaves = written(
        spark,
        docs.select(
            group_key(F.col(group_col)).alias("grp"),
            F.col(id_col).alias("id"),
            leaf(*[F.col(f) for f in fields]).alias("digest"),
            F.col(group_col).alias("grp_value"),
            *[c.alias(n) for n, c in zip(names, kept.values())],
            # Rows alike in all else can still be parted into ranges.
            F.monotonically_increasing_id().alias("tie"),
        ),
        "merkle-leaves",
    )
    data = F.struct("id", "grp_value", *names).alias("data")
    placed = numbered(spark, leaves, ["id", "digest", "tie"])
    found = climbed(spark, placed.select("grp", "pos", "total", "digest", data))
    # A group's first block has its root too: one row per group.
    groups = written(
        spark,
        found.where("block = 0").select(
            F.lit(_ALL).alias("grp"), F.col("root").alias("digest"), F.col("grp").alias("data")
        ),
        "merkle-groups",
    )
    tops = proved(climbed(spark, numbered(spark, groups, ["data"]))).select(
        F.col("data").alias("grp"), F.col("root").alias("whole"), F.col("proof").alias("rest")
    )
    upward = (
        found.join(tops, "grp")
        .withColumn("subroot", F.col("root"))
        .withColumn("path", F.concat("path", "rest"))
        .withColumn("root", F.col("whole"))
    )
    return proved(upward, "subroot").select(
        F.col("data.id").alias(id_col),
        F.col("data.grp_value").alias(group_col),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "proof",
        *[F.col(f"data.{n}").alias(c) for n, c in zip(names, kept)],
    )


def folded(claimed: Column, proof: Column) -> Column:
    """The root that a claimed leaf and its siblings give."""
    return F.aggregate(proof, claimed, lambda h, s: digest(F.concat(s.left, h, s.right)))


def proof_text(proof: Column) -> Column:
    """All siblings after each other, from the leaf's run upward."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s.left, s.right)), "")
