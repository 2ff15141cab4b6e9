"""Best-fit packing of token sequences: configuration linear program, then rounding.

Only the histogram of piece lengths decides the packing, and it has at most
``capacity`` rows however large the corpus is. On it, the configuration program
(cover every piece of every length with as few sequences as possible) is solved
by multiplicative weights: passes price all lengths by their weights, find the
best configurations by knapsack dynamic programming over the capacity, and raise
the weights of the lengths they leave uncovered. The mean of the passes is
rounded down, the program packs the remainder once more, and best-fit, longest
first, places only what no configuration of full worth holds. The prices bound
from below what any packing needs; passes end when the bound is met.

The plan says, for each length, which ranks of its pieces go to which
sequences; ranks are given in Spark, salted, so that a length which holds many
pieces is spread over tasks.

A null text is an empty one and has the end id alone. Rows with equal ids are
packed each on its own; a null id is packed like any other.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from logtally.llm.shared import written
from logtally.llm.tokens import crc32, encoder
from logtally.llm.words import parts

CAPACITY = 4096
SALTS = 256
PASSES = 4  # of multiplicative weights
RATE = 0.002
NEAR = 0.0005  # share of the best worth
WORTH = 0.999  # of the best configuration, below which best-fit goes on
TIE = 1e-12


# --- the plan, on the histogram --------------------------------------------


class Knapsack:
    """The best multisets of lengths for every room at once; ``most`` of each length.

    Of equally good ones it takes that with lengths that come first, so with
    lengths in falling order the short ones are kept for rooms that need them.
    """

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int) -> None:
        self.items: list[tuple[int, int, int]] = []  # index of the length, copies, width
        for i, (length, limit) in enumerate(zip(lengths.tolist(), most.tolist(), strict=True)):
            limit, copies = min(limit, capacity // length), 1
            while limit > 0:
                copies = min(copies, limit)
                limit -= copies
                self.items.append((i, copies, length * copies))
                copies *= 2
        better = np.zeros((len(self.items), capacity + 1), dtype=bool)
        self.best = np.zeros(capacity + 1)
        for k, (i, copies, width) in enumerate(self.items):
            other = self.best[: capacity + 1 - width] + prices[i] * copies
            np.greater(other, self.best[width:] + TIE, out=better[k, width:])
            np.copyto(self.best[width:], other, where=better[k, width:])
        self._by_room = np.ascontiguousarray(better.T)

    def fill(self, room: int) -> dict[int, int]:
        """Copies by index of the best multiset in ``room``."""
        found: dict[int, int] = {}
        end = len(self.items)
        while room > 0 and end:
            taken = np.flatnonzero(self._by_room[room, :end])
            if not len(taken):
                break
            end = int(taken[-1])
            i, copies, width = self.items[end]
            found[i] = found.get(i, 0) + copies
            room -= width
        return found


def covering(count: np.ndarray, weight: np.ndarray, capacity: int) -> tuple[dict[tuple, int], np.ndarray, float]:
    """One pass of the program under ``weight``: configurations, what they leave, a lower bound.

    Every length in ``count`` is priced, by its share of the capacity times its
    weight. Each length in turn, longest first, asks for the best configuration
    that holds it; it is taken as often as the rest allows if none is worth
    more than ``NEAR`` above it, those of most worth first. The pass ends when the best one left is worth less than
    ``WORTH`` of the best at first. Prices over the best worth are a solution of
    the dual program, which gives the bound.
    """
    left, out, first, bound = count.copy(), {}, 0.0, 0.0
    while left.any():
        lengths = np.flatnonzero(left)[::-1]
        prices = weight[lengths] * lengths / capacity
        sack = Knapsack(lengths, prices, np.minimum(left[lengths], capacity), capacity)
        top = float(sack.best[capacity])
        if not first:
            first, bound = top, float(count[lengths] @ prices) / top
        if top < WORTH * first:
            break
        worth = prices + sack.best[capacity - lengths]
        near = np.flatnonzero(worth >= top * (1 - NEAR))
        asked = near[np.argsort(-worth[near].round(9), kind="stable")].tolist()
        found = ({**(f := sack.fill(capacity - int(lengths[i]))), i: f.get(i, 0) + 1} for i in asked)
        some = False
        for config in itertools.chain(found, [None]):
            if config is None:  # none of them could be taken whole: the best of all can
                if some:
                    break
                config = sack.fill(capacity)
            times = min(int(left[lengths[i]]) // c for i, c in config.items())
            if times:
                some = True
                key = tuple(sorted(((int(lengths[i]), c) for i, c in config.items()), reverse=True))
                out[key] = out.get(key, 0) + times
                for i, c in config.items():
                    left[lengths[i]] -= c * times
    return out, left, bound


def plan(count: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """(configuration, how many sequences) that hold exactly ``count``."""
    return solve(count, capacity)[0]


def solve(count: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[tuple, int]], int, int]:
    """The plan, how many of its sequences come from the program, and the program's lower bound.

    The fractional solution is the mean of the passes so far. After each its
    numbers are rounded down, the program packs what is left once more, and
    what no configuration of full worth holds is placed best-fit. Lengths that
    a pass leaves uncovered gain weight for the next. The fewest sequences win;
    the passes end when the bound is met.
    """
    whole = [(((capacity, 1),), int(count[capacity]))] if count[capacity] else []
    count = count.astype(np.int64).copy()
    count[[0, capacity]] = 0
    if not count.any():
        return whole, 0, len(whole) and whole[0][1]
    weight, total, least = np.ones(capacity + 1), Counter(), 0.0
    best: tuple[list, int] | None = None
    for n in range(1, PASSES + 1):
        configs, uncovered, bound = covering(count, weight, capacity)
        total.update(configs)
        least = max(least, bound)
        rounded, left = Counter(), count.copy()
        for config, x in total.items():
            if times := x // n:
                rounded[config] = times
                for length, c in config:
                    left[length] -= c * times
        again, rest, _ = covering(left, weight, capacity)
        rounded.update(again)
        packed = [*rounded.items(), *best_fit(rest, capacity)]
        if best is None or _sequences(packed) < _sequences(best[0]):
            best = packed, sum(rounded.values())
        if _sequences(best[0]) <= math.ceil(least - 1e-6):
            break
        weight *= np.exp(RATE * uncovered / np.maximum(count, 1))
    full = _sequences(whole)
    return whole + best[0], best[1], full + math.ceil(least - 1e-6)


def _sequences(configs: list[tuple[tuple, int]]) -> int:
    return sum(times for _, times in configs)


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best-fit decreasing on counts: equal sequences are moved together."""
    rooms: dict[int, list[tuple[dict, int]]] = {}
    for length in np.flatnonzero(count)[::-1].tolist():
        n = int(count[length])
        for room in sorted(r for r in rooms if r >= length):
            groups = rooms.pop(room)
            while n and groups:
                config, times = groups.pop()
                copies = min(room // length, n)
                used = min(times, n // copies)
                n -= used * copies
                grown = config | {length: config.get(length, 0) + copies}
                rooms.setdefault(room - copies * length, []).append((grown, used))
                if used < times:
                    groups.append((config, times - used))
            if groups:
                rooms.setdefault(room, []).extend(groups)
            if not n:
                break
        copies = capacity // length
        for c, times in ((copies, n // copies), (n % copies, 1)):
            if c and times:
                rooms.setdefault(capacity - c * length, []).append(({length: c}, times))
    return [
        (tuple(sorted(config.items(), reverse=True)), times)
        for groups in rooms.values()
        for config, times in groups
    ]


def slots(configs: list[tuple[tuple, int]], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, end rank, first sequence, copies, offset), sorted.

    Rank r of a length has its row by first <= r < end; with q = r - first it
    goes to sequence first + q // copies at offset + (q % copies) * length.
    """
    given = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    for config, times in configs:
        offset = 0
        for length, copies in config:
            first = int(given[length])
            given[length] += copies * times
            rows.append((length, first, first + copies * times, sequence, copies, offset))
            offset += copies * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


# --- on tables --------------------------------------------------------------


def token_pieces(
    docs: DataFrame, path: str, end_id: int, keep_space: bool, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, keep_space).encode
        for part in parts(batches):
            ids, offs = encode(part.column("text"), end_id)
            found = []
            for doc, a, b in zip(part.column("doc_id").to_pylist(), offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                for piece, start in enumerate(range(a, b, capacity)):
                    some = ids[start : min(start + capacity, b)]
                    row = (doc, piece, start - a, len(some), crc32(some))
                    found.append((*row, some.tolist()) if with_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = zip(*found, strict=True) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names
            )

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, kind + (", ids array<int>" if with_ids else "")
    )


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset. Columns doc_id, piece, length are read."""
    # One row per length and salt: capacity * SALTS at most.
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS))
    salted = pieces.withColumn("_salt", salt)
    cells = written(spark, salted.groupBy("length", "_salt").agg(F.count("length").alias("_n")), "lengths")
    count = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in cells.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        count[length] = n  # at most ``capacity`` rows
    table = slots(plan(count, capacity), capacity)
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", *[c for c in ("ids_crc32",) if c in pieces.columns])
    ranked = (
        salted.withColumn("_row", F.row_number().over(inside))
        .join(offsets, ["length", "_salt"])
        .select(*pieces.columns, (F.col("_before") + F.col("_row") - 1).alias("_rank"))
    )
    keys = (table[:, 0] << 48) | table[:, 1]
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            row = table[np.searchsorted(keys, (length << 48) | rank, side="right") - 1]
            q = rank - row[:, 1]
            copies = np.maximum(row[:, 4], 1)
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(row[:, 3] + q // copies), pa.array(row[:, 5] + (q % copies) * length)],
                names=[*names, "sequence_id", "offset"],
            )

    kind = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, kind)


def pack_documents(
    spark: SparkSession, docs: DataFrame, path: str, end_id: int = 1, keep_space: bool = False, capacity: int = CAPACITY
) -> DataFrame:
    """Tokenise whole documents, cut the long ones, pack the pieces."""
    pieces = written(spark, token_pieces(docs, path, end_id, keep_space, capacity), "pieces")
    return pack(spark, pieces, capacity)
