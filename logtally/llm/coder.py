"""Token ids in compressed files: an adaptive context-mixing range coder over blocks.

Ids are coded in blocks of ``BLOCK``, each with the CRC-32 of its ids. Up to
``LANES`` blocks are coded in step in numpy, under statistics that they share
and that start afresh with each such group: what one block shows at a step,
all know at the next. So a group is read as a whole, and a wrong byte in one
block shows in the checksums.

An id's probability is one distribution, blended from three: adaptive
frequencies of all ids (order 0), the id that last followed the last one (order
1) and the last two (order 2). The blend's weights are adaptive counts, gated by
how often both guesses have held and whether they agree; equal guesses add up.
Weights and frequencies are whole numbers, so that reading repeats writing
exactly. Frequencies are brought up to date after ``EARLY`` steps, then after
every ``FRESH``.

The file format is Parquet with one row per run of documents: document ids
and lengths, block checksums, sizes and the coded bytes. Rows are in ascending
document order, within a file and from file to file; ``part`` numbers the file
and ``first`` the ids before the row in it.

A null text is empty: the end id alone. A null id comes first. Rows with equal
ids follow each other. A document is never split over rows, a long one makes a
long row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from logtally.llm.tokens import crc32, encoder
from logtally.llm.words import parts
from logtally.sources import files

BLOCK, LANES = 1024, 4096  # ids of a block; blocks that share each numpy call
ROW = 3 << 20  # ids after which a row ends, with their document
SLOT_BITS = 17  # of the guesses after two ids
SURE = 7  # most a guess is trusted
FRESH, WEIGH, LEARN = 256, 16, 4  # steps between new frequencies, between new weights, and that weights learn from
EARLY = 1, 4, 16, 64  # steps with new frequencies besides
SYMBOLS, SHARE = 1 << 16, 20  # ids; log2 of what their frequencies add up to
BLEND, LEAST = 12, 16  # log2 of the sum of a blend's weights; least weight of order 0
_BOTTOM, _WORD, _TOP, _TOTAL = np.uint64(1 << 40), np.uint64(16), np.uint64(48), np.uint64(SHARE + BLEND)
_GATES = 2 * (SURE + 1) ** 2
# The trust in a guess after it failed, and after it held.
_NOW = np.concatenate([np.arange(SURE + 1) >> 1, np.minimum(np.arange(SURE + 1) + 1, SURE)]).astype(np.uint32)


class _Range:
    """Range coders of many lanes, without carry, by words of 16 bits.

    ``data`` [lane, word] is given for reading.
    """

    def __init__(self, n: int, data: np.ndarray | None = None) -> None:
        self.lanes, self.used = n, 0
        self.low = np.zeros(n, np.uint64)
        self.range = np.full(n, ~np.uint64(0))
        self.code = None
        if data is None:
            self.data, self.moved = np.zeros((BLOCK, n), np.uint16), np.zeros((BLOCK, n), bool)
        else:
            self.data, self.code = data, np.zeros(n, np.uint64)
            for i in range(4):
                self.code = self.code << _WORD | data[:, i]
            self.at = np.arange(n) * data.shape[1] + 4  # where each lane's next word lies

    def value(self, n: int) -> np.ndarray:
        """Where the first n lanes stand in the blend's total."""
        found = (self.code[:n] - self.low[:n]) // (self.range[:n] >> _TOTAL)
        return np.minimum(found, (np.uint64(1) << _TOTAL) - np.uint64(1)).astype(np.uint32)

    def narrow(self, n: int, low: np.ndarray, size: np.ndarray) -> None:
        """Go to the part of the first n lanes' ranges that their ids have of the total."""
        width, at = self.range[:n], self.low[:n]
        width >>= _TOTAL
        at += low * width
        width *= size
        move = width < _BOTTOM
        # A range on both sides of a word's border ends at the next one.
        end = at + width
        end ^= at
        end >>= _TOP
        apart = np.flatnonzero((end != 0) & move)
        width[apart] = (~at[apart] + np.uint64(1)) & (_BOTTOM - np.uint64(1))
        shift = move * _WORD
        if self.code is None:
            self._put(slice(n), at, move)
        else:
            code, place = self.code[:n], self.at[:n]
            code <<= shift
            code |= self.data.take(place, mode="clip") * move
            place += move
        at <<= shift
        width <<= shift
        lane = np.flatnonzero(width < _BOTTOM)  # seldom more than a few
        while len(lane):
            low, size = at[lane], width[lane]
            apart = (low ^ (low + size)) >> _TOP != 0
            size = np.where(apart, (~low + np.uint64(1)) & (_BOTTOM - np.uint64(1)), size) << _WORD
            if self.code is None:
                self._put(lane, low, True)
            else:
                self.code[lane] = self.code[lane] << _WORD | self.data.take(self.at[lane], mode="clip")
                self.at[lane] += 1
            at[lane], width[lane] = low << _WORD, size
            lane = lane[size < _BOTTOM]

    def _put(self, lane: np.ndarray | slice, at: np.ndarray, move: np.ndarray | bool) -> None:
        """A row of words, of which those of the lanes that move count."""
        if self.used == len(self.data):
            self.data, self.moved = (np.concatenate([m, np.zeros_like(m)]) for m in (self.data, self.moved))
        self.data[self.used, lane] = at >> _TOP
        self.moved[self.used, lane] = move
        self.used += 1

    def finish(self) -> list[bytes]:
        """The lanes' bytes; two words more say where in its range a lane ended, zeros follow in reading."""
        end = self.low + np.uint64((1 << 32) - 1)
        for k in range(2):
            self._put(slice(None), end << np.uint64(16 * k), True)
        at = np.flatnonzero(self.moved[: self.used])
        lane = (at % self.lanes).astype(np.uint16)
        words = self.data.reshape(-1)[at[np.argsort(lane, kind="stable")]].astype("<u2")
        ends = np.append(0, np.cumsum(np.bincount(lane, minlength=self.lanes))).tolist()
        return [words[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


class _Mixer:
    """Statistics that lanes share; codes one id per lane and step."""

    def __init__(self, n: int, coder: _Range) -> None:
        self.coder = coder
        # After one id and after two: the guess, and the trust in it in the lowest bits.
        self.guess = [np.zeros(SYMBOLS, np.uint32), np.zeros(1 << SLOT_BITS, np.uint32)]
        self.last = np.zeros((2, n), np.uint32)
        self.held = np.zeros(4 * _GATES, np.int64)  # by gate: no guess held, order 1's, order 2's, both
        self.counts = np.zeros(SYMBOLS, np.int64)
        self.seen: list[np.ndarray] = []
        self.steps = 0
        self._frequencies()
        self._weights()

    def _frequencies(self) -> None:
        """Each id keeps a share of its own, the rest goes by what was seen."""
        if self.seen:
            self.counts += np.bincount(np.concatenate(self.seen), minlength=SYMBOLS)
            self.seen.clear()
        total = max(int(self.counts.sum()), 1)
        size = 1 + self.counts * ((1 << SHARE) - SYMBOLS) // total
        size[np.argmax(size)] += (1 << SHARE) - int(size.sum())
        self.start, self.size = (np.cumsum(size) - size).astype(np.uint32), size.astype(np.uint32)
        if self.coder.code is not None:
            self.owner = np.repeat(np.arange(SYMBOLS, dtype=np.uint16), size)

    def _weights(self) -> None:
        none, one, two, both = self.held.reshape(_GATES, 4).T
        half = both >> 1
        total, room = none + one + two + both + 4, (1 << BLEND) - LEAST
        w1, w2 = (one + half + 1) * room // total, (two + both - half + 1) * room // total
        self.weight = [w.astype(np.uint32) for w in ((1 << BLEND) - w1 - w2, w1 << SHARE, w2 << SHARE)]

    def step(self, n: int, ids: np.ndarray | None) -> np.ndarray:
        """Code ``ids`` (uint32) of the first n lanes, or read them."""
        one, two = self.last[0, :n], self.last[1, :n]
        slots = one.astype(np.int64), (one * np.uint32(0x9E3779B1) + two * np.uint32(0x85EBCA77)) >> np.uint32(32 - SLOT_BITS)
        kept = [table.take(slot) for table, slot in zip(self.guess, slots, strict=True)]
        (g1, t1), (g2, t2) = [(k >> np.uint32(3), k & np.uint32(SURE)) for k in kept]
        gate = ((t2 << np.uint32(4)) + (t1 << np.uint32(1)) + (g1 == g2)).astype(np.int64)
        w0, w1, w2 = (w.take(gate) for w in self.weight)
        if ids is None:
            ids = self._find(n, g1, g2, w0, w1, w2)
        at = ids.astype(np.int64)
        held1, held2 = g1 == ids, g2 == ids
        low = self.start.take(at) * w0 + w1 * (g1 < ids) + w2 * (g2 < ids)
        size = self.size.take(at) * w0 + w1 * held1 + w2 * held2
        self.coder.narrow(n, low, size)
        for table, slot, guess, trust, held in zip(self.guess, slots, (g1, g2), (t1, t2), (held1, held2), strict=True):
            now = _NOW.take(trust + held * np.uint32(SURE + 1))
            np.copyto(guess, ids, where=now == 0)
            guess <<= np.uint32(3)
            guess |= now
            table[slot] = guess  # of lanes at one slot the last one counts
        if self.steps % LEARN == 0:
            self.held += np.bincount(gate * 4 + held2 * 2 + held1, minlength=len(self.held))
        self.last[1, :n], self.last[0, :n] = one, ids
        self.seen.append(at)
        self.steps += 1
        if self.steps % FRESH == 0 or self.steps in EARLY:
            self._frequencies()
        if self.steps % WEIGH == 0 or self.steps < WEIGH:
            self._weights()
        return ids

    def _find(
        self, n: int, g1: np.ndarray, g2: np.ndarray, w0: np.ndarray, w1: np.ndarray, w2: np.ndarray
    ) -> np.ndarray:
        """The ids in whose parts of the total the lanes stand."""
        value = self.coder.value(n)
        first, second = np.minimum(g1, g2), np.maximum(g1, g2)
        w_first = np.where(g1 <= g2, w1, w2)
        rest, before, inside = value, np.uint32(0), []
        for guess, own in ((first, w_first), (second, w1 + w2 - w_first)):
            slot = guess.astype(np.int64)
            start = self.start.take(slot) * w0 + before
            end = start + (self.size.take(slot) * w0 + own - np.uint32(1))  # the last one
            after = value > end
            inside.append((value >= start) & ~after)
            rest = rest - own * after
            before = own
        ids = self.owner.take(rest // w0, mode="clip")
        return np.where(inside[1], second, np.where(inside[0], first, ids))


def write_blocks(ids: np.ndarray) -> tuple[list[int], list[int], list[bytes]]:
    """Lengths, checksums and coded bytes of the blocks of ``ids`` (below 2 ** 16)."""
    cut = [ids[a : a + BLOCK] for a in range(0, len(ids), BLOCK)]
    coded: list[bytes] = []
    for a in range(0, len(cut), LANES):
        some = cut[a : a + LANES]
        coder = _Range(len(some))
        mixer = _Mixer(len(some), coder)
        grid = np.zeros((len(some), BLOCK + 16), np.uint32)  # a step's ids don't all compete for one place in the cache
        for i, block in enumerate(some):
            grid[i, : len(block)] = block
        for t in range(len(some[0])):  # only the last block is shorter
            n = len(some) - (t >= len(some[-1]))
            mixer.step(n, grid[:n, t].copy())
        coded += coder.finish()
    return [len(b) for b in cut], [crc32(b) for b in cut], coded


def read_blocks(lengths: list[int], checks: list[int], coded: list[bytes]) -> np.ndarray:
    """The ids again; a block whose checksum differs is an error."""
    out: list[np.ndarray] = []
    for a in range(0, len(lengths), LANES):
        some, data = lengths[a : a + LANES], coded[a : a + LANES]
        grid = np.zeros((len(some), max(map(len, data)) // 2 + 8 | 1), np.uint16)
        for i, block in enumerate(data):
            grid[i, : len(block) // 2] = np.frombuffer(block, "<u2")
        mixer = _Mixer(len(some), _Range(len(some), grid))
        ids = np.zeros((len(some), BLOCK + 16), np.uint32)
        for t in range(some[0]):
            n = len(some) - (t >= some[-1])
            ids[:n, t] = mixer.step(n, None)
        for row, length, check in zip(ids, some, checks[a : a + LANES], strict=True):
            block = row[:length]
            if crc32(block) != check:
                raise ValueError("a block of ids does not match its checksum")
            out.append(block)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


_SCHEMA = (
    "part int, seq long, first long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
    "block_lengths array<long>, checks array<long>, block_bytes array<long>, payload binary"
)


def write_tokens(
    spark: SparkSession, docs: DataFrame, path: str, end_id: int, target: str, keep_space: bool = True
) -> None:
    """Encode ``docs`` (doc_id, text) with the vocabulary at ``path`` and write the files."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, seq = TaskContext.get().partitionId(), 0, 0
        encode = encoder(path, keep_space).encode
        doc_ids, lengths, held = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal first, seq
            ids = np.concatenate(held)
            blocks, checks, coded = write_blocks(ids)
            row = [part, seq, first, len(ids), list(doc_ids), list(lengths), blocks, checks, list(map(len, coded)), b"".join(coded)]
            kinds = [pa.int32(), *[pa.int64()] * 3, *[pa.list_(pa.int64())] * 5, pa.binary()]
            first, seq = first + len(ids), seq + 1
            for kept in (doc_ids, lengths, held):
                kept.clear()
            names = [c.split(" ")[0] for c in _SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in parts(batches):
            ids, offs = encode(batch.column("text").to_pylist(), end_id)
            doc_ids += batch.column("doc_id").to_pylist()
            lengths += np.diff(offs).tolist()
            held.append(ids)
            if sum(map(len, held)) >= ROW:
                yield flush()
        if held:
            yield flush()

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(F.col("doc_id"))
    dealt.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(rows, _SCHEMA).write.parquet(target)


_DOCS = "doc_id long, part int, start long, n_tokens long, ids_crc32 long"


def _read_rows(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum([0, *row["block_bytes"]]).tolist()
            coded = [row["payload"][a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            ids = read_blocks(row["block_lengths"], row["checks"], coded)
            offs = np.cumsum([0, *row["doc_lengths"]])
            sums = [crc32(ids[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            columns = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array([row["part"]] * len(sums), pa.int32()),
                pa.array(offs[:-1] + row["first"]),
                pa.array(np.diff(offs)),
                pa.array(sums, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids.view(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])


def read_tokens(spark: SparkSession, source: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (over all files), n_tokens, ids_crc32 and, if wanted, ids, from the files."""
    rows = spark.read.parquet(source)
    # One row per file: what all files before hold.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    ids = ["ids"] if with_ids else []
    docs = rows.mapInArrow(
        lambda batches: _read_rows(batches, with_ids), _DOCS + (", ids array<int>" if with_ids else "")
    )
    return docs.join(offsets, "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *ids
    )


def round_trip(spark: SparkSession, docs: DataFrame, path: str, end_id: int, with_ids: bool = True) -> DataFrame:
    """Write to the shared folder, read back."""
    target = f"{files.shared_dir(spark)}/llm/tokens-{uuid.uuid4().hex}"
    write_tokens(spark, docs, path, end_id, target)
    return read_tokens(spark, target, with_ids)
