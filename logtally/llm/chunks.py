"""Substring dedup: anchors at gear-hash cuts, then exact runs of words around them.

A text is cut before a word where a gear hash of the 16 bytes in front has its
top bits zero, and at the smallest hashes of every ``WINDOW`` words where none
has. Cuts depend on nearby bytes only, so an insertion shifts no other cut, and
text of a short period is cut as well. The ``ANCHOR_WORDS`` words behind a cut
are an anchor. A passage of ``PASSAGE`` words that stands in two documents byte
by byte has an anchor of both in its first and in its last ``REACH`` words (16
bytes are 8 words at most, then a window, then the anchor).

Anchors of several documents only say where to look: around them, every run of
``PASSAGE`` words is hashed and goes unless no document of a smaller id has it.
A passage of over 50 words is the sum of such runs, so it is cut at its exact
ends, with the white space behind it, and shorter repeats stay. The document of
the smallest id keeps the passage. Repeats inside the document that keeps it
stay.

Null and empty texts stay as they are. Rows with a null id are neither cut nor
compared. Rows with equal ids are one document: they never cut each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from logtally.llm.shared import dropped, written
from logtally.llm.words import Words, _BYTE, _SPACE, _powers, distinct, flat, lists, mix, parts

PASSAGE = 51  # words: over 50
WINDOW, ANCHOR_WORDS = 16, 8
REACH = 8 + WINDOW + ANCHOR_WORDS
TOP_BITS = 3  # a cut before every eighth word

_GEAR = (_BYTE >> np.uint64(40)).astype(np.uint16)
_BASE = int(_powers(1)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)


def cuts(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the words that begin at ``start`` have a cut in front."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):  # windows of 2, 4, 8, 16 bytes
        h[step:] = h[step:] + (h[:-step] << np.uint16(step))
    value = h[np.maximum(start - 1, 0)]
    chosen = value >> np.uint16(16 - TOP_BITS) == 0
    n = len(value) - WINDOW + 1  # windows
    if n > 0:
        low = value[:n].copy()
        for k in range(1, WINDOW):
            np.minimum(low, value[k : k + n], out=low)
        high = np.zeros(len(value), dtype=np.uint16)
        for k in range(WINDOW):
            np.maximum(high[k : k + n], low, out=high[k : k + n])
        chosen |= value == high  # the smallest of a window
    return chosen


def ends(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text (UTF-8 bytes), the last one its length."""
    if len(data) == 0:
        return np.zeros(0, dtype=np.int64)
    inside = ~_SPACE[data]
    inside[1:] &= _SPACE[data[:-1]]  # first bytes of words
    start = np.flatnonzero(inside)
    found = start[cuts(data, start)] if len(start) else start
    return np.append(found[found > 0], len(data))


def digests(data: np.ndarray, cut: np.ndarray) -> np.ndarray:
    lengths = np.diff(cut, prepend=0)
    starts = cut - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    powers = _powers(int(lengths.max(initial=0)) + 1)
    return mix(np.add.reduceat(_BYTE[data] * powers[place], starts) + lengths.astype(np.uint64))


class Runs:
    """Words of a part as they are written, and hashes of runs of words."""

    def __init__(self, texts: pa.Array) -> None:
        self.words = Words(texts, hashes=False)
        self.words.data, _ = flat(texts)
        h = self.words._hash()
        self.size = len(h)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.words.bounds))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self._ladder(_BASE))])
        self.back = self._ladder(_INVERSE)

    def _ladder(self, base: int) -> np.ndarray:
        return np.multiply.accumulate(np.full(self.size, base, dtype=np.uint64))

    def hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        """Of the n words from each of ``at``."""
        return mix((self.sums[at + n] - self.sums[at]) * self.back[at] + np.uint64(n)).view(np.int64)

    def whole(self, n: int) -> np.ndarray:
        """Words with n - 1 more behind them in their text."""
        last = self.size - n + 1
        return np.flatnonzero(self.doc[: max(0, last)] == self.doc[n - 1 :])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and hashes."""
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = self.whole(ANCHOR_WORDS)
        at = at[cuts(self.words.data, self.words.start)[at]]
        return at, self.hashes(at, ANCHOR_WORDS)

    def candidates(self, known: list[list[int] | None]) -> np.ndarray:
        """Words that begin a run of PASSAGE with anchors of ``known`` (by text) near both ends."""
        at, h = self.anchors()
        bounds = np.searchsorted(at, self.words.bounds)
        hit = np.zeros(self.size + 1, dtype=np.int64)
        for a, b, some in zip(bounds[:-1].tolist(), bounds[1:].tolist(), known, strict=True):
            if some:
                hit[at[a:b][np.isin(h[a:b], np.array(some))] + 1] = 1
        before = np.cumsum(hit)
        run, span = self.whole(PASSAGE), REACH - ANCHOR_WORDS + 1  # anchors that end in REACH words
        tail = run + PASSAGE - REACH
        return run[(before[run + span] > before[run]) & (before[tail + span] > before[tail])]

    def by_doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(at, self.words.bounds)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches):
        runs = Runs(part.column("text"))
        at, h = runs.anchors()
        long = np.diff(runs.words.bounds) >= PASSAGE
        bounds = runs.by_doc(at).tolist()
        found = [
            distinct(h[a:b]) if some else h[:0] for a, b, some in zip(bounds[:-1], bounds[1:], long.tolist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("h"), lists(found, pa.int64())], names=["id", "h", "anchors"]
        )


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the runs worth a look; ``place`` is the run's first word in its text."""
    for part in parts(batches):
        runs = Runs(part.column("text"))
        at = runs.candidates(part.column("known").to_pylist())
        doc = runs.doc[at]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id").take(pa.array(doc)),
                part.column("h").take(pa.array(doc)),
                pa.array((at - runs.words.bounds[doc]).astype(np.int32)),
                pa.array(runs.hashes(at, PASSAGE)),
            ],
            names=["id", "h", "place", "run"],
        )


def spans(start: np.ndarray, size: int, marked: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges to remove from a text of ``size`` bytes whose words begin at ``start``: the words of the
    marked runs and the white space behind them."""
    first = marked[np.diff(marked, prepend=-PASSAGE - 1) > PASSAGE]
    last = marked[np.diff(marked, append=marked[-1] + PASSAGE + 1) > PASSAGE] + PASSAGE
    edge = np.append(start, size)
    return list(zip(edge[first].tolist(), edge[last].tolist(), strict=True))


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches):
        texts, removed, counts = [], [], []
        marks = part.column("marks").to_pylist()
        whole, offs = flat(part.column("text"))
        words = Words(part.column("text"), hashes=False)
        for k, (text, marked) in enumerate(zip(part.column("text").to_pylist(), marks, strict=True)):
            data = whole[offs[k] : offs[k + 1]]
            start = words.start[words.bounds[k] : words.bounds[k + 1]] - offs[k]
            gone = spans(start, len(data), np.array(sorted(marked))) if marked else []
            if gone:
                kept, at = [], 0
                for a, b in gone:
                    kept.append(data[at:a].tobytes())
                    at = b
                text = b"".join([*kept, data[at:].tobytes()]).decode("utf-8")
            texts.append(text)
            counts.append(len(gone))
            removed.append(sum(b - a for a, b in gone))
        names = [n for n in part.schema.names if n not in ("marks", "text")]
        yield pa.RecordBatch.from_arrays(
            [
                *[part.column(n) for n in names],
                pa.array(texts, pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
            ],
            names=[*names, "text", "n_spans", "removed_bytes"],
        )


def remove_repeats(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True
) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, plus n_spans and removed_bytes.

    These two take the place of columns of the same names; without ``counts``
    they are left out, and ``docs`` keeps all of its columns.
    """
    keyed = docs.select(
        F.struct(*[c for c in docs.columns if c != text_col]).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("h"),
        F.col(text_col).alias("text"),
    )
    texts = keyed.where("id IS NOT NULL AND text <> ''").select("id", "h", "text")
    anchors = written(spark, texts.mapInArrow(_anchor_rows, "id long, h long, anchors array<long>"), "anchors")
    placed = anchors.select("id", "h", F.explode("anchors").alias("anchor"))
    shared = placed.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    known = written(
        spark,
        placed.join(shared.select("anchor"), "anchor")
        .groupBy("id", "h").agg(F.collect_set("anchor").alias("known")),
        "known",
    )
    dropped(spark, anchors)
    # A place is below 2^31, as a text is below 2 GB.
    runs = written(
        spark,
        texts.join(known, ["id", "h"]).mapInArrow(_run_rows, "id long, h long, place int, run long"),
        "runs",
    )
    dropped(spark, known)
    # One shuffle: rows of a run lie together, and the window spills if they are many.
    holder = F.min("id").over(Window.partitionBy("run"))
    marks = written(
        spark,
        runs.withColumn("holder", holder)
        .where("holder < id")
        .groupBy("id", "h")
        .agg(F.collect_set("place").alias("marks")),
        "marks",
    )
    dropped(spark, runs)
    rows = keyed.join(marks, ["id", "h"], "left").select("row", "text", "marks")
    kind = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    kind = kind.add("n_spans", T.LongType()).add("removed_bytes", T.LongType())
    out = rows.mapInArrow(_cut_rows, kind)
    added = ["n_spans", "removed_bytes"] if counts else []
    fields = [
        F.col("text").alias(text_col) if c == text_col else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
        if c not in added
    ]
    return out.select(*fields, *added)
