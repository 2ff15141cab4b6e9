"""Words of whole texts as 64-bit hashes, in numpy over Arrow batches.

Words are runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, A-Z
lower-cased. A null text counts as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others have none
PART_BYTES = 2 << 20  # texts worked on at once; a longer single text is one part

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * step)


_BYTE = seeds(256, 1)


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, 0xD6E8FEB86659FD93, dtype=np.uint64))


_POWERS = _powers(64)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts after each other, and n + 1 offsets."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or len(texts) == 0 or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def parts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that no part holds much more than PART_BYTES."""
    for batch in batches:
        _, offs = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offs, offs[start] + PART_BYTES, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    give_back()


def give_back() -> None:
    """Freed memory to the system: Spark keeps its workers, and all of an executor's count together."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


class Words:
    """start and end byte, document number and hash of each word of a part."""

    def __init__(self, texts: pa.Array, hashes: bool = True) -> None:
        data, offs = flat(texts)
        self.data, self.offs = _LOWER[data], offs
        n = len(data)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~_SPACE[data]
        first = np.zeros(n + 1, dtype=bool)  # a text begins here
        first[offs] = True
        now = inside[1:-1]
        self.start = np.flatnonzero(now & (~inside[:-2] | first[:-1]))
        self.end = np.flatnonzero(now & (~inside[2:] | first[1:])) + 1
        self.bounds = np.searchsorted(self.start, offs)  # word numbers of each text
        if hashes:
            self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lengths = self.end - self.start
        word = np.repeat(np.arange(len(lengths)), lengths)
        before = np.cumsum(lengths) - lengths
        place = np.arange(len(word)) - before[word]
        powers = _POWERS if lengths.max() <= len(_POWERS) else _powers(int(lengths.max()))
        values = _BYTE[self.data[place + self.start[word]]] * powers[place]
        return mix(np.add.reduceat(values, before) + lengths.astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once; by sorting, which beats hashing on short arrays."""
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


_PLACES = seeds(8, 2) | np.uint64(1)


def shingles(words: Words, k: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text.

    A text of fewer words has its whole sequence as one; one without words none.
    """
    h, n = words.hash, len(words.hash)
    if n >= k:
        runs = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            runs += h[i : n - k + 1 + i] * _PLACES[i]
        runs = mix(runs)
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield distinct(runs[a : b - k + 1])
        elif b > a:
            whole = (h[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mix(np.array([whole], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrays of numbers as one Arrow list column."""
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    if kind == pa.int64() and values.dtype != np.int64:
        values = values.astype(np.uint64).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
