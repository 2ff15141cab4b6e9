"""Quality classifier: a generalised additive model with pairwise interactions.

Features are shares and ratios of the whole text. Each feature is cut into
bins at quantiles of the sample; cyclic boosting visits one feature after the
other and adds a shallow tree (few leaves over neighbouring bins) to its lookup
table, then the same for the strongest pairs of features over coarser bins. A
score is the sigmoid of summed table entries.

Learning takes at most ``SAMPLE`` labelled rows, those of the smallest hash;
that bound is a parameter. Scoring covers every text. Null and empty texts get
a score from their (zero) features. With no labels at all or one class only,
the smoothed share of label 1 is the score. Conflicting labels of one id are
averaged; null labels and null ids teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logtally.llm.words import Words, distinct, flat, parts

SAMPLE = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, LEAVES, MIN_ROWS = 0.15, 4, 8

FEATURES = [
    "log_words", "word_length", "long_words", "distinct_words", "upper", "digits",
    "stops", "bangs", "bars", "symbols", "marked_words", "wide", "spaces",
    "line_words", "repeated_lines", "short_words", "sentence_words", "doubled_words",
]


def _share(flags: np.ndarray, offs: np.ndarray, of: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[offs[1:]] - sums[offs[:-1]]) / np.maximum(of, 1)


def _class(*ranges) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for r in ranges:
        out[list(r)] = True
    return out


_UPPER = _class(range(65, 91))
_DIGIT = _class(range(48, 58))
_STOP = _class(b".,;:?")
_BANG = _class(b"!")
_BAR = _class(b"|")
_SYMBOL = _class(range(35, 39), b"*+<=>@[]^_{}~\\/`")
_WIDE = _class(range(128, 256))
_BLANK = _class(b" ")


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    data, offs = flat(texts)
    w = Words(texts)
    size, at = np.diff(offs), w.bounds
    n = np.diff(at)
    length = w.end - w.start
    last = w.data[w.end - 1] if len(length) else np.zeros(0, np.uint8)
    same = np.zeros(len(length), dtype=bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    varied = np.array(
        [len(distinct(w.hash[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)], dtype=float
    )
    lines, fresh = np.ones(len(n)), np.ones(len(n))
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        found = [x for x in data[a:b].tobytes().split(b"\n") if x]
        lines[i], fresh[i] = max(1, len(found)), max(1, len(set(found)))
    full_stops = _share(last == 46, at, 1)
    columns = [
        np.log1p(n), _share(length, at, n), _share(length > 15, at, n), varied / np.maximum(n, 1),
        _share(_UPPER[data], offs, size), _share(_DIGIT[data], offs, size),
        _share(_STOP[data], offs, size), _share(_BANG[data], offs, size), _share(_BAR[data], offs, size),
        _share(_SYMBOL[data], offs, size), _share(_SYMBOL[last], at, n), _share(_WIDE[data], offs, size),
        _share(_BLANK[data], offs, size), n / lines, 1 - fresh / lines, _share(length <= 2, at, n),
        n / (1 + full_stops), _share(same, at, n),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


# --- the model --------------------------------------------------------------


@dataclass
class Gam:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j])]
        coarse = [np.searchsorted(e, x[:, j]) for j, e in enumerate(self.pair_edges)]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int) -> tuple[np.ndarray, float]:
    """Leaf values over neighbouring bins, best split first; and the gain."""
    step, gained, parts_ = np.zeros(len(g)), 0.0, [(0, len(g))]

    def best(a: int, b: int) -> tuple[float, int]:
        gs, hs, ns = np.cumsum(g[a:b]), np.cumsum(h[a:b]), np.cumsum(n[a:b])
        gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1)
        gain = gain - gs[-1] ** 2 / (hs[-1] + 1)
        gain[(ns[:-1] < MIN_ROWS) | (ns[-1] - ns[:-1] < MIN_ROWS)] = 0
        k = int(np.argmax(gain)) if len(gain) else 0
        return (float(gain[k]), a + k + 1) if len(gain) else (0.0, a)

    while len(parts_) < leaves:
        gain, at, (a, b) = max((*best(a, b), (a, b)) for a, b in parts_)
        if gain <= 1e-9:
            break
        parts_.remove((a, b))
        parts_ += [(a, at), (at, b)]
        gained += gain
    for a, b in parts_:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return step, gained


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if len(y) < 2 * MIN_ROWS or y.min() == y.max():
        return model
    quantiles = lambda b: [np.unique(np.quantile(c, np.arange(1, b) / b)) for c in x.T]
    model.edges, model.pair_edges = quantiles(BINS), quantiles(PAIR_BINS)
    bins = [np.searchsorted(e, x[:, j]) for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, j]) for j, e in enumerate(model.pair_edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    def sums(where: np.ndarray, size: int, g: np.ndarray, h: np.ndarray):
        return [np.bincount(where, v, size) for v in (g, h)] + [np.bincount(where, minlength=size)]

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            step, _ = _tree(*sums(bins[j], len(table), *slopes()), LEAVES)
            table += RATE * step
            total += RATE * step[bins[j]]

    def cross(i: int, j: int) -> tuple[np.ndarray, float]:
        """A tree over two features: a split of one, then one of the other on each side."""
        shape = (len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1)
        grid = [s.reshape(shape) for s in sums(coarse[i] * shape[1] + coarse[j], shape[0] * shape[1], *slopes())]
        top = (np.zeros(shape), 0.0)
        for k in range(1, shape[0]):
            low, gain_low = _tree(*[s[:k].sum(axis=0) for s in grid], 2)
            high, gain_high = _tree(*[s[k:].sum(axis=0) for s in grid], 2)
            if gain_low + gain_high > top[1]:
                top = (np.concatenate([np.tile(low, (k, 1)), np.tile(high, (shape[0] - k, 1))]), gain_low + gain_high)
        return top

    d = x.shape[1]
    ranked = sorted(((cross(i, j)[1], i, j) for i in range(d) for j in range(d) if i != j), reverse=True)
    model.pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [
        np.zeros((len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1)) for i, j in model.pairs
    ]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            step, _ = cross(i, j)
            table += RATE * step
            total += RATE * step[coarse[i], coarse[j]]
    return model


# --- on tables --------------------------------------------------------------


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 over 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts(batches):
        x = features(part.column("text"))
        flat_x = pa.array(x.reshape(-1))
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
        yield pa.RecordBatch.from_arrays(
            [part.column("y"), pa.ListArray.from_arrays(offsets, flat_x)], names=["y", "x"]
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Gam:
    """Fit on ``sample`` labelled rows at most, held-out ids left aside."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)  # bounded, so it can be broadcast
    )
    rows = (
        docs.join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
        .select("y", "text")
        .mapInArrow(_feature_rows, "y double, x array<double>")
        .toArrow()
    )
    if rows.num_rows == 0:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    y = rows.column("y").to_numpy()
    order = np.lexsort((*x.T, y))  # the same model whatever order rows come in
    return fit(x[order], y[order])


def _judged(docs: DataFrame, model: Gam) -> DataFrame:
    """(row, score): the columns of ``docs`` in a struct, whatever their names."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            s = model.score(features(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(s)], names=["row", "score"])

    return rows.mapInArrow(score, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def scored(docs: DataFrame, model: Gam) -> DataFrame:
    """``docs`` with a column ``score``, in place of one of this name."""
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "score"]
    return _judged(docs, model).select(*kept, "score")


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(docs.select("doc_id", "text"), labels, sample)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` scored 0.5 or more, columns unchanged."""
    model = train(docs.select("doc_id", "text"), labels, sample)
    return _judged(docs, model).where("score >= 0.5").select("row.*")
