"""Fill-in-middle transformation over a wavelet matrix of character classes.

A text is cut at two unit ends into prefix, middle and suffix and written
with markers, suffix or prefix first. The bytes of many texts, put together,
become classes (inside of a character, other, white space, line end); a wavelet
matrix over them answers how often a class stands before any place. Ranks of
the classes that end a unit add up to the number of units before a place, and
bisection on these sums finds the cuts of all texts at once; the rank of the
class inside a character turns bytes into code points.

Null texts count as empty. A text that is empty or contains a marker stays
plain, so every output reads back exactly. Null ids draw like an empty id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logtally.llm.words import flat, parts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"
SEED = "7"

INSIDE, OTHER, SPACE, LINE_END = range(4)
LINES = (LINE_END,)  # classes whose characters end a unit
PIECES = (SPACE, LINE_END)
_BITS = 2

_CLASS = np.full(256, OTHER, dtype=np.uint8)
_CLASS[0x80:0xC0] = INSIDE
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = SPACE
_CLASS[0x0A] = LINE_END


class Wavelet:
    """Ranks of small codes: per bit a bit vector with counts per 64 bits."""

    def __init__(self, codes: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.levels = []
        for b in reversed(range(bits)):
            one = (codes >> b & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(len(one) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.zeros(len(words), dtype=np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:])
            self.levels.append((words, counts, len(one) - int(one.sum())))
            codes = np.concatenate([codes[~one], codes[one]])

    @staticmethod
    def _ones(level, i: np.ndarray) -> np.ndarray:
        words, counts, _ = level
        at = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return counts[at] + np.bitwise_count(words[at] & below)

    def rank(self, code: int, i: np.ndarray) -> np.ndarray:
        """How many ``code`` stand before each place of ``i``."""
        low, high = np.zeros(1, dtype=np.int64), np.asarray(i, dtype=np.int64)
        for b, level in zip(reversed(range(self.bits)), self.levels):
            a, z = self._ones(level, low), self._ones(level, high)
            if code >> b & 1:
                low, high = level[2] + a, level[2] + z
            else:
                low, high = low - a, high - z
        return high - low


class Units:
    """Unit ends of texts put together; a text is the bytes between two offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, ends: tuple[int, ...]) -> None:
        codes = _CLASS[data]
        self.matrix = Wavelet(codes, _BITS)
        self.ends = ends
        self.start, self.stop = offsets[:-1], offsets[1:]
        self.before = self._count(self.start)
        filled = self.stop > self.start
        last = np.full(len(filled), ends[0], dtype=np.uint8)
        last[filled] = codes[self.stop[filled] - 1]
        self.n = self._count(self.stop) - self.before + ~np.isin(last, ends)

    def _count(self, i: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(c, i) for c in self.ends)

    def cut(self, units: np.ndarray) -> np.ndarray:
        """The place behind the first ``units`` units of each text."""
        low, high = self.start.copy(), self.stop.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self._count(middle) - self.before >= units
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low

    def chars(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        rank = self.matrix.rank
        return stop - start - (rank(INSIDE, stop) - rank(INSIDE, start))


def _draws(id_col: str) -> list[Column]:
    """Four numbers below 2^32 for each id."""
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    hashed = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transformed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ends: tuple[int, ...] = LINES,
    fim_percent: int = 100,
    spm_percent: int = 50,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per row of ``docs``.

    ``n`` counts the text's units. ``form`` is plain, psm (prefix, suffix,
    middle) or spm (suffix, prefix, middle). The cuts, whether a text is cut
    and its form are drawn from a hash of the id. Other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(batch["text"])
        h = [batch[f"h{i}"].to_numpy() for i in range(1, 5)]
        units = Units(data, offsets, ends)
        one, two = h[0] % (units.n + 1), h[1] % (units.n + 1)
        a, b = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
        prefix, middle = units.chars(units.start, a), units.chars(a, b)
        whole = data.tobytes()
        forms, outputs = [], []
        rows = zip(offsets.tolist(), a.tolist(), b.tolist(), offsets[1:].tolist(), h[2].tolist(), h[3].tolist())
        for start, left, right, stop, h3, h4 in rows:
            text = whole[start:stop]
            if not text or h3 % 100 >= fim_percent or any(m in text for m in _MARKERS):
                forms.append("plain")
                outputs.append(text)
                continue
            p, m, s = whole[start:left], whole[left:right], whole[right:stop]
            spm = h4 % 100 < spm_percent
            forms.append("spm" if spm else "psm")
            order = (_MARKERS[1], s, _MARKERS[0], p) if spm else (_MARKERS[0], p, _MARKERS[1], s)
            outputs.append(b"".join((*order, _MARKERS[2], m)))
        plain = np.array([f == "plain" for f in forms], dtype=bool)
        return pa.RecordBatch.from_arrays(
            [
                batch["id"],
                pa.array(units.n.astype(np.int64)),
                pa.array(forms, pa.string()),
                pa.array(prefix, pa.int64(), mask=plain),
                pa.array(middle, pa.int64(), mask=plain),
                pa.array(outputs, pa.binary()).cast(pa.string()),
            ],
            names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            yield cut(part)

    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    chosen = docs.select(F.col(id_col).alias("id"), text, *_draws(id_col))
    return chosen.mapInArrow(rows, schema).withColumnRenamed("id", id_col)


_MARKERS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


def restored(form: Column, output: Column) -> Column:
    """The text, rebuilt from an output and its form."""
    part = F.split(output, MARKER, -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
