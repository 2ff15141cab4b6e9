"""Language-model scores by online logistic context mixing, next to a word-count base.

A text's class, one of ``CLASSES``, is its most frequent accented letter, which
tells languages apart; it is sent first, at log2(CLASSES) bits. The text is its
lower-cased words and one end. A word is sent bit by bit along its path in a
Huffman code of the training words; words the code lacks (seen once, or beyond
the ``HEAD`` most frequent) take the path of "spelled" and follow as bytes with
a space behind, high bit first.

Four predictors look at a bit of a path: one at the path alone, the others at a
hashed context with it: the text's class, the word before, the two words before
(a text's first word and its end included). ``ORDERS`` predictors look at a bit
of a spelled byte: at the last bytes of the word so far (the last one at all of
them) and the class. A hashed slot of context and bits already known holds how
often a 0 and a 1 followed in the training texts. Their log-odds are combined by
weights that are gated by how much the slot has seen, and whether always the
same, learned over all training texts, each bit left out of its own counts once (of those exact);
a text's own weights go on top and are refined online inside the text, after
every ``STEP`` words. The bits' costs add up to the score.

All training texts are counted. Word contexts are cut into blocks by their hash
and counted block by block; the gates' weights move by ``TURNS`` Newton steps, each
from sums over the training texts of its turn, which the id decides. So neither
depends on how the table is split into files. Slots
have no check values and their number is fixed, so contexts come to share them as
the corpus grows; the gates learn how far to trust them. Counts in slots are kept as one of ``LEVELS`` steps.
Base scores of words outside the head come from a join.

Null texts are empty ones: one end token. A null id is never held out. Repeated
rows are scored each on its own. Without training texts every count is zero.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logtally.llm.shared import dropped, written
from logtally.llm.words import Words, _BYTE, _powers, give_back, lists, mix, parts, seeds

ORDERS = (1, 2, 3, 5, 0)  # bytes of a spelled word looked at; 0: all of it
SLOT_BITS = 20
CLASSES = 16
ALL_CLASSES = (5,)  # orders that classes share
CONTEXTS = ("class", "word", "two words")  # looked at beside the path
CONTEXT_BITS = 23  # slots of each of these
BLOCK_BITS, SYMBOL_BITS = 4, 18
GATES = np.array([1, 2, 4, 8, 32, 128, 1024, 16384])  # counts of a slot
HEAD = 1 << 17
ITEMS, ROW_ITEMS = 1 << 20, 1 << 14  # contexts counted at once, and sent in a row
STEP, BLOCK, LANES = 32, 2048, 96  # words between refinements; words, and texts, worked on at once
RATE, FIRST = 0.006, 0.4
TURNS, CALM, LARGEST = 3, 100, 0.5  # steps of the gates' weights
SPELLED, ENDED = 0, 1  # symbols that are no word
SPACE, END = 0x20, 0x0A

# Counts that a slot's state tells apart: exact ones, then steps of an eighth or more.
LEVELS = np.unique(np.concatenate([np.arange(9), np.round(9 * 1.3 ** np.arange(39))])).astype(np.int64)
_N = len(LEVELS)
_ZEROS, _ONES = np.repeat(LEVELS, _N), np.tile(LEVELS, _N)  # of each state
_N_GATES = 2 * (len(GATES) + 1)

_END_HASH = int(mix(seeds(1, 6)).view(np.int64)[0])
_ORDER_SEED = seeds(len(ORDERS), 7)
_CLASS_SEED = seeds(CLASSES, 9)
_CONTEXT_SEED = seeds(len(CONTEXTS), 10)
_BEFORE_TEXT = seeds(2, 11)
_BACK = seeds(1, 12)[0] | np.uint64(1)
# Slots of a spelled byte lie in lines of 16, one for each four bits.
_LINE = np.uint32(0xFFFFFFF0)
_LOW = np.array([max(n.bit_length() - 5, 0) for n in range(256)])  # bits known of the byte's second half
_NODE = (seeds(256, 8) >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)[np.arange(256) >> _LOW] & _LINE
_NODE |= (np.arange(256) & ((1 << _LOW) - 1) | (1 << _LOW)).astype(np.uint32)
_NODE[:16] = np.arange(16)
_PATH = (seeds(HEAD + 2, 13) & np.uint64(0xFFFFFFFC)).astype(np.uint32)  # of a place in the code
_SLOTS = 1 << SLOT_BITS
_SHIFT = np.uint64(64 - SLOT_BITS)
_HIGH_FIRST = np.arange(7, -1, -1, dtype=np.uint8)
_BYTES = np.arange(256, dtype=np.uint32)
_BITS = ((_BYTES[:, None] >> _HIGH_FIRST) & 1).astype(np.uint8)  # of each byte
_NODES = (256 | _BYTES[:, None]) >> (np.uint32(8) - np.arange(8, dtype=np.uint32))  # bits known before each
_NODE_OF = _NODE[_NODES]


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def classes(words: Words) -> np.ndarray:
    """The class of each text of a part; 0 without any letter of two bytes."""
    lead = np.flatnonzero(words.data >= 0xC0)
    kind = (words.data[lead].astype(np.int64) * 31 + words.data[np.minimum(lead + 1, len(words.data) - 1)]) % CLASSES
    n_docs = len(words.offs) - 1
    doc = np.searchsorted(words.offs, lead, side="right") - 1
    seen = np.bincount(doc * CLASSES + kind, minlength=n_docs * CLASSES).reshape(n_docs, CLASSES)
    return np.where(seen.any(axis=1), seen.argmax(axis=1), 0)


def contexts(data: np.ndarray, place: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Slot bases [order, byte] (uint32): what a spelled word shows before each byte."""

    def slot(k: int, code: np.ndarray) -> np.ndarray:
        salt = _ORDER_SEED[k] if ORDERS[k] in ALL_CLASSES else _ORDER_SEED[k] ^ _CLASS_SEED[kind]
        return (mix(code ^ salt) >> _SHIFT).astype(np.uint32) & _LINE

    n = len(data)
    code = _BYTE[data]
    out = np.empty((len(ORDERS), n), dtype=np.uint32)
    seen = np.zeros(n, dtype=np.uint64)
    for back in range(1, max(ORDERS) + 1):
        before = np.zeros(n, dtype=np.uint64)
        before[back:] = code[:-back] if back < n + 1 else 0
        before[place < back] = 0
        seen += before * (_BYTE[back] | np.uint64(1))
        if back in ORDERS:
            k = ORDERS.index(back)
            out[k] = slot(k, seen)
    powers = _powers(int(place.max(initial=0)) + 2)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * powers[place])])
    whole = sums[:-1] - sums[np.arange(n) - place]
    k = ORDERS.index(0)
    out[k] = slot(k, whole)
    return out


def word_contexts(words: np.ndarray, first: np.ndarray, kind: np.ndarray, bits: int) -> np.ndarray:
    """Slot bases [context, word] (uint32, ``bits`` bits) of words by their hashes.

    ``first`` marks a text's first word, ``kind`` is the text's class.
    """
    one, two = np.empty_like(words), np.empty_like(words)
    one[1:], two[2:] = words[:-1], words[:-2]
    starts = np.flatnonzero(first)
    one[starts] = _BEFORE_TEXT[0]
    two[starts] = _BEFORE_TEXT[1]
    second = starts[starts + 1 < len(words)] + 1
    second = second[~first[second]]
    two[second] = _BEFORE_TEXT[0]
    shown = (_CLASS_SEED[kind], one, one * _BACK + two)
    return np.stack([mix(x ^ s) >> np.uint64(64 - bits) for x, s in zip(shown, _CONTEXT_SEED, strict=True)]).astype(np.uint32) & np.uint32(0xFFFFFFFC)


def word_bytes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (a space behind each word; an empty word is the end), word number and place of each byte."""
    length = np.array([len(w) + 1 for w in words], dtype=np.int64)
    data = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)[: length.sum()].copy()
    data[(np.cumsum(length) - 1)[length == 1]] = END
    which = np.repeat(np.arange(len(words)), length)
    return data, which, np.arange(len(data)) - (np.cumsum(length) - length)[which]


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges after each other, and the range of each."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size), np.repeat(np.arange(len(size)), size)


def _states(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    zeros, ones = (np.searchsorted(LEVELS, n, side="right") - 1 for n in (zeros, ones))
    return (zeros * _N + ones).astype(np.uint16)


def _odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)


def _gates(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    mixed = (np.minimum(zeros, ones) > 0).astype(np.uint8)
    return (2 * np.searchsorted(GATES, zeros + ones, side="right") + mixed).astype(np.uint8)


_STATE_ODDS, _STATE_GATE = _odds(_ZEROS, _ONES), _gates(_ZEROS, _ONES)
# A state without one bit of its own, 0 or 1; a step of several counts stays as it is.
_LESS = LEVELS - ((LEVELS > 0) & (LEVELS < 9))
_WITHOUT = np.concatenate([_states(np.repeat(_LESS, _N), _ONES), _states(_ZEROS, np.tile(_LESS, _N))])
_WITHOUT_ODDS, _WITHOUT_GATE = _STATE_ODDS[_WITHOUT], _STATE_GATE[_WITHOUT]  # at bit * _N ** 2 + state


class Code:
    """The Huffman code: for each symbol its path from the root, places and bits after each other."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, ends: int, total: int) -> None:
        self.given = head, counts, ends, total
        self.head = head  # hashes, ascending
        own = (counts > 1) & (head != _END_HASH)
        self.symbol = np.where(own, np.cumsum(own) + ENDED, SPELLED)
        weight = np.concatenate([[max(total - ends - int(counts[own].sum()), 1), max(ends, 1)], counts[own]])
        n = len(weight)
        heap = [(w, i) for i, w in enumerate(weight.tolist())]
        heapq.heapify(heap)
        above, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.uint8)
        zeros, ones = np.zeros(n - 1, np.int64), np.zeros(n - 1, np.int64)
        for k in range(n - 1):
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            above[i] = above[j] = n + k
            side[j] = 1
            zeros[k], ones[k] = a, b
            heapq.heappush(heap, (a + b, n + k))
        self.length = np.zeros(n, np.int64)
        now, left, steps = np.arange(n), np.arange(n), []
        while len(left):
            up = above[now]
            steps.append((left, up - n, side[now]))
            self.length[left] += 1
            more = up < 2 * n - 2  # not yet the root
            now, left = up[more], left[more]
        self.start = np.cumsum(self.length) - self.length
        size = int(self.length.sum())
        self.node, self.bit = np.zeros(size, np.int64), np.zeros(size, np.uint8)
        for k, (which, node, bit) in enumerate(steps):
            at = self.start[which] + self.length[which] - 1 - k
            self.node[at], self.bit[at] = node, bit
        z, o = zeros[self.node], ones[self.node]
        self.odds, self.gate = _odds(z, o), _gates(z, o)
        # Two bits in turn share four slots: the first one's place tells where, the first bit which.
        depth = np.arange(size) - np.repeat(self.start, self.length)
        later = np.flatnonzero(depth % 2)
        since = np.ones(size, np.uint32)
        since[later] = 2 + self.bit[later - 1]
        self.slot = _PATH[self.node[np.arange(size) - depth % 2]] | since
        del self.node, heap, above, side, z, o, depth, later, since
        give_back()

    def __reduce__(self) -> tuple:
        return Code, self.given  # workers build it again, from a twentieth of its size

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the head, and whether there."""
        key = hashes.view(np.int64)
        at = np.minimum(np.searchsorted(self.head, key), max(0, len(self.head) - 1))
        return at, self.head[at] == key if len(self.head) else np.zeros(len(key), bool)


class Tokens:
    """Words and ends of a part's texts, in order."""

    def __init__(self, words: Words, code: Code, bits: int) -> None:
        self.words = words
        n_docs = len(words.bounds) - 1
        self.size = np.diff(words.bounds) + 1
        self.offs = np.concatenate([[0], np.cumsum(self.size)])
        self.doc = np.repeat(np.arange(n_docs), self.size)
        last = self.offs[1:] - 1
        is_word = np.ones(len(self.doc), bool)
        is_word[last] = False
        hashes = np.full(len(self.doc), _END_HASH, np.int64).view(np.uint64)
        hashes[is_word] = words.hash
        self.word = np.cumsum(is_word) - 1  # number among the words
        self.at, self.known = code.find(words.hash)
        self.symbol = np.full(len(self.doc), ENDED)
        self.symbol[is_word] = np.where(self.known, code.symbol[self.at], SPELLED) if len(code.head) else SPELLED
        first = np.zeros(len(self.doc), bool)
        first[self.offs[:-1]] = True
        self.kind = classes(words)[self.doc]
        self.base = word_contexts(hashes, first, self.kind, bits)

    def spell(self) -> "Tokens":
        """Add the bytes of the spelled words: ``data``, their slot bases, and where each token's lie."""
        which = np.flatnonzero(self.symbol == SPELLED)
        word = self.word[which]
        start, size = self.words.start[word], self.words.end[word] - self.words.start[word] + 1
        at, of = _ranges(start, size)
        place = at - start[of]
        last = place == size[of] - 1
        data = self.words.data[np.where(last, 0, at)] if len(at) else np.zeros(0, np.uint8)
        self.data = np.where(last, SPACE, data).astype(np.uint8)
        self.byte_base = contexts(self.data, place, self.kind[which][of])
        self.n_bytes = np.zeros(len(self.symbol), np.int64)
        self.n_bytes[which] = size
        self.first_byte = np.cumsum(self.n_bytes) - self.n_bytes
        return self


def _packed(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(held), return_counts=True)


_COUNT_ROWS = "order int, block int, high binary, low binary, times binary"


def _count_rows(code: Broadcast, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted contexts of the partition's words by block, then counts of all spelled slots."""
    names = [c.split(" ")[0] for c in _COUNT_ROWS.split(", ")]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]

    def by_block(k: int, items: np.ndarray, times: np.ndarray, inside: int, low: int) -> Iterator[pa.RecordBatch]:
        """Sorted items, of ``low`` bits beside four bytes, and how often each came: rows of a block, none large."""
        cut = np.searchsorted(items, np.arange((1 << BLOCK_BITS) + 1, dtype=np.uint64) << np.uint64(inside))
        for b, (x, y) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
            for a in range(x, y, ROW_ITEMS):
                some = slice(a, min(a + ROW_ITEMS, y))
                own = items[some] & np.uint64((1 << inside) - 1)
                high, rest = (own >> np.uint64(low)).astype("<u4"), own.astype(np.uint8) if low else b""
                row = (k, b, high.tobytes(), bytes(rest), times[some].astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], names=names)

    def flush(k: int) -> Iterator[pa.RecordBatch]:
        """Context and symbol of one predictor, five bytes each."""
        items, times = _packed(held[k])
        held[k].clear()
        yield from by_block(k, items, times, bits - BLOCK_BITS + SYMBOL_BITS, 8)

    held: list[list[np.ndarray]] = [[] for _ in CONTEXTS]
    spelled = np.zeros((len(ORDERS), 2 * _SLOTS), np.uint32)
    for part in parts(batches):
        tokens = Tokens(Words(part.column("text")), code.value, bits)
        for k in range(len(CONTEXTS)):
            held[k].append(tokens.base[k].astype(np.uint64) << np.uint64(SYMBOL_BITS) | tokens.symbol.astype(np.uint64))
            if sum(map(len, held[k])) >= ITEMS:
                yield from flush(k)
        data, base = tokens.spell().data, tokens.byte_base
        for a in range(0, len(data), 128 * BLOCK):
            node, bit = _NODE_OF[data[a : a + 128 * BLOCK]], _BITS[data[a : a + 128 * BLOCK]]
            for k in range(len(ORDERS)):
                slot = (base[k, a : a + 128 * BLOCK, None] ^ node) * np.uint32(2) + bit
                np.add.at(spelled[k], slot.reshape(-1).astype(np.int64), np.uint32(1))
    for k in range(len(CONTEXTS)):
        if held[k]:
            yield from flush(k)
    for k in range(len(ORDERS)):
        items = np.flatnonzero(spelled[k]).astype(np.uint64)
        yield from by_block(len(CONTEXTS) + k, items, spelled[k][items], SLOT_BITS + 1 - BLOCK_BITS, 0)


def _table_rows(code: Broadcast, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States of all slots of a block."""
    code, slots, tables = code.value, 1 << (bits - BLOCK_BITS), {}
    for batch in batches:
        for order, block, high, low, times in zip(*batch.columns, strict=True):
            key = order.as_py(), block.as_py()
            high, low, times = (np.frombuffer(v.as_buffer(), k) for v, k in ((high, "<u4"), (low, "u1"), (times, "<u4")))
            if key[0] >= len(CONTEXTS):
                counts = tables.setdefault(key, np.zeros(2 * _SLOTS >> BLOCK_BITS, np.int64))
                counts[high] += times  # each once
                continue
            counts = tables.setdefault(key, np.zeros(2 * slots, np.int64))
            for a in range(0, len(high), 4 * BLOCK):
                some = high[a : a + 4 * BLOCK].astype(np.int64) << 8 | low[a : a + 4 * BLOCK]
                symbol, base = some & ((1 << SYMBOL_BITS) - 1), (some >> SYMBOL_BITS).astype(np.uint32)
                at, which = _ranges(code.start[symbol], code.length[symbol])
                slot = (base[which] ^ code.slot[at]) & np.uint32(slots - 1)
                np.add.at(counts, slot * np.uint32(2) + code.bit[at], times[a : a + 4 * BLOCK][which].astype(np.int64))
    for (order, block), counts in tables.items():
        states = _states(counts[0::2], counts[1::2])
        yield pa.RecordBatch.from_arrays(
            [pa.array([order], pa.int32()), pa.array([block], pa.int32()), pa.array([states.tobytes()])],
            names=["order", "block", "states"],
        )


class Model:
    """Tables of states and the gates' weights: of paths, and of spelled bytes."""

    def __init__(
        self, code: Code, paths: np.ndarray, spelled: np.ndarray, bits: int, gates: list[np.ndarray] | None = None
    ) -> None:
        self.code, self.bits, self.paths, self.spelled = code, bits, paths, spelled
        self.gates = gates or [np.full((k, _N_GATES), FIRST) for k in (len(CONTEXTS) + 1, len(ORDERS))]
        self.mask = np.uint32((1 << (bits - BLOCK_BITS)) - 1)

    def path_states(self, tokens: Tokens, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Place in the code's paths of each bit, number of bits of each token, states of each bit's slots."""
        symbol = tokens.symbol[token]
        length = self.code.length[symbol]
        at, _ = _ranges(self.code.start[symbol], length)
        slot = self.code.slot[at] & self.mask
        base = tokens.base[:, token]
        return at, length, [self.paths[k].take(np.repeat(base[k], length) ^ slot) for k in range(len(CONTEXTS))]

    def spelled_states(self, tokens: Tokens, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Bits of the spelled words, number of bits of each token, states of each bit's slots."""
        size = tokens.n_bytes[token]
        at, _ = _ranges(tokens.first_byte[token], size)
        data = tokens.data[at]
        base, node = tokens.byte_base[:, at], _NODE_OF[data]
        states = [self.spelled[k].take((base[k][:, None] ^ node).reshape(-1)) for k in range(len(ORDERS))]
        return _BITS[data].reshape(-1), 8 * size, states

    def slopes(self, tokens: Tokens, curved: bool) -> list[np.ndarray]:
        """Derivatives of the cost by the gates' weights, second ones if ``curved``; each bit without its own count."""

        sums = [np.zeros(g.size * (g.size + 1 if curved else 1)) for g in self.gates]
        own = [[(_WITHOUT_ODDS * w[_WITHOUT_GATE]).astype(np.float32) for w in g] for g in self.gates]
        for a in range(0, len(tokens.doc), BLOCK):
            token = np.arange(a, min(a + BLOCK, len(tokens.doc)))
            at, _, states = self.path_states(tokens, token)
            self._add_slopes(sums[0], self.gates[0], own[0], self.code.bit.take(at), states, at, curved)
            bit, _, states = self.spelled_states(tokens, token)
            self._add_slopes(sums[1], self.gates[1], own[1], bit, states, None, curved)
        return sums

    def _add_slopes(
        self,
        sums: np.ndarray,
        weights: np.ndarray,
        own: list[np.ndarray],
        bit: np.ndarray,
        states: list[np.ndarray],
        at: np.ndarray | None,
        curved: bool,
    ) -> None:
        n, g = weights.shape
        more = n - len(states)  # the path alone has no states
        without = bit * np.int64(_N * _N)
        states = [without + s for s in states]
        x = np.zeros(len(bit), np.float32)
        odds, gate = [], []
        if at is not None:
            odds, gate = [self.code.odds.take(at)], [self.code.gate.take(at)]
            x += odds[0] * weights[0].astype(np.float32).take(gate[0])
        for o, s in zip(own[more:], states, strict=True):
            x += o.take(s)
        p = 1 / (1 + np.exp(-np.clip(x, -12, 12)))
        slope = p - bit
        if at is not None:
            sums[:g] += np.bincount(gate[0], slope * odds[0], g)
        for k, s in enumerate(states, more):
            of_state = np.bincount(s, slope, 2 * _N * _N) * _WITHOUT_ODDS
            sums[k * g : (k + 1) * g] += np.bincount(_WITHOUT_GATE, of_state, g)
        if not curved:
            return
        odds, gate = odds + [_WITHOUT_ODDS.take(s) for s in states], gate + [_WITHOUT_GATE.take(s) for s in states]
        second = sums[n * g :].reshape(n, g, n, g)
        for k in range(n):
            of_order = p * (1 - p) * odds[k]
            for m in range(k, n):
                both = np.bincount(gate[k] * np.int16(g) + gate[m], of_order * odds[m], g * g).reshape(g, g)
                second[k, :, m] += both
                if m > k:
                    second[m, :, k] += both.T

    def learn(self, first: list[np.ndarray], second: list[np.ndarray]) -> None:
        """A Newton step, kept small where little was seen, and never above ``LARGEST``."""
        for gates, slope, curve in zip(self.gates, first, second, strict=True):
            step = np.linalg.solve(curve + CALM * np.eye(gates.size), slope)
            gates -= np.clip(step, -LARGEST, LARGEST).reshape(gates.shape)

    def costs(self, tokens: Tokens) -> np.ndarray:
        """Bits of each text. ``LANES`` texts go on side by side, each with weights of its own."""
        order = np.argsort(-tokens.size, kind="stable")
        odds_of = [[(_STATE_ODDS * w[_STATE_GATE]).astype(np.float32) for w in g] for g in self.gates]
        of_path = (self.code.odds * self.gates[0][0][self.code.gate]).astype(np.float32)
        out = np.full(len(order), math.log2(CLASSES))
        for some in np.split(order, range(LANES, len(order), LANES)):
            out[some] += self._costs(tokens, tokens.offs[:-1][some], tokens.size[some], odds_of, of_path)
        return out

    def _costs(
        self, tokens: Tokens, start: np.ndarray, size: np.ndarray, odds_of: list[list[np.ndarray]], of_path: np.ndarray
    ) -> np.ndarray:
        own = [np.ones((len(g), len(size)), np.float32) for g in self.gates]
        bits = np.zeros(len(size))
        for t in range(0, int(size.max(initial=0)), STEP):
            n = int(np.searchsorted(-size, -t, side="left"))  # texts longer than t
            token, lane = _ranges(start[:n] + t, np.minimum(STEP, size[:n] - t))
            at, length, states = self.path_states(tokens, token)
            odds = [of_path.take(at), *[o.take(s) for o, s in zip(odds_of[0][1:], states, strict=True)]]
            self._refine(own[0], bits, self.code.bit.take(at), np.bincount(lane, length, n).astype(np.int64), odds)
            bit, length, states = self.spelled_states(tokens, token)
            if len(bit):
                odds = [o.take(s) for o, s in zip(odds_of[1], states, strict=True)]
                self._refine(own[1], bits, bit, np.bincount(lane, length, n).astype(np.int64), odds)
        return bits

    @staticmethod
    def _refine(own: np.ndarray, bits: np.ndarray, bit: np.ndarray, size: np.ndarray, odds: list[np.ndarray]) -> None:
        """Add the costs of these bits, ``size`` of them in each lane, then move the lanes' weights."""
        lane = np.flatnonzero(size)
        size = size[lane]
        first = np.cumsum(size) - size
        x = odds[0] * np.repeat(own[0][lane], size)
        for k in range(1, len(odds)):
            x += odds[k] * np.repeat(own[k][lane], size)
        np.clip(x, -12, 12, out=x)
        sign = bit * np.float32(2) - np.float32(1)
        p = 1 / (1 + np.exp(-sign * x))  # of the bit that came
        bits[lane] -= np.add.reduceat(np.log2(p), first, dtype=np.float64)
        p = (p - np.float32(1)) * sign
        for k in range(len(odds)):
            own[k][lane] -= RATE * np.add.reduceat(p * odds[k], first)


def word_counts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(hash, c) of all tokens of the training texts, the end among them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            words = Words(part.column("text"))
            found, n = np.unique(words.hash, return_counts=True)
            hashes = np.append(found.view(np.int64), _END_HASH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), pa.array(np.append(n, part.num_rows))], names=["hash", "c"]
            )

    found = docs.where(~held_out("id")).select("text").mapInArrow(rows, "hash long, c long")
    return written(spark, found.groupBy("hash").agg(F.sum("c").alias("c")), "counts")


def _slopes(
    texts: DataFrame, code: Broadcast, tables: Broadcast, bits: int, gates: list[np.ndarray], curved: bool
) -> list[np.ndarray]:
    """Sums over ``texts``: slopes of both sets of weights, then their curves."""
    sizes = [g.size for g in gates] + [g.size**2 if curved else 0 for g in gates]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = Model(code.value, *tables.value, bits, gates), np.zeros(sum(sizes))
        for part in parts(batches):
            paths, spelled = model.slopes(Tokens(Words(part.column("text")), model.code, bits).spell(), curved)
            n, m = sizes[:2]
            total += np.concatenate([paths[:n], spelled[:m], paths[n : n + sizes[2]], spelled[m : m + sizes[3]]])
        yield pa.RecordBatch.from_arrays([lists([total], pa.float64())], names=["s"])

    found = texts.select("text").mapInArrow(rows, "s array<double>")
    sums = np.zeros(sum(sizes))
    for place, value in found.select(F.posexplode("s")).groupBy("pos").agg(F.sum("col")).collect():  # a row per pair of gates
        sums[place] = value
    one, two, *curves = np.split(sums, np.cumsum(sizes)[:-1])
    return [one, two, *[c.reshape(len(v), -1) for c, v in zip(curves, (one, two), strict=True)]]


def _turn(id_col: str) -> Column:
    """The turn in which a training text moves the weights; a third each."""
    return F.coalesce(F.floor((F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 + 1) * TURNS / 8), F.lit(0))


def fit(spark: SparkSession, docs: DataFrame, code: Code) -> tuple[Broadcast, Broadcast, int, list[np.ndarray]]:
    """The code, tables and gates from all training texts, of fixed size."""
    rows = docs.where(~held_out("id"))
    texts = rows.select("text")
    bits = CONTEXT_BITS
    blocks = (len(CONTEXTS) + len(ORDERS)) * (1 << BLOCK_BITS)
    shared = spark.sparkContext.broadcast(code)
    states = written(
        spark,
        texts.mapInArrow(lambda batches: _count_rows(shared, bits, batches), _COUNT_ROWS)
        .repartition(blocks, "order", "block")
        .mapInArrow(lambda batches: _table_rows(shared, bits, batches), "order int, block int, states binary"),
        "states",
    )
    found = states.toArrow()
    dropped(spark, states)  # and the counts' shuffle with it
    paths = np.zeros((len(CONTEXTS), 1 << BLOCK_BITS, 1 << (bits - BLOCK_BITS)), np.uint16)
    spelled = np.zeros((len(ORDERS), 1 << BLOCK_BITS, _SLOTS >> BLOCK_BITS), np.uint16)
    for batch in found.to_batches():
        for order, block, states in zip(*batch.columns, strict=True):
            k, states = order.as_py(), np.frombuffer(states.as_buffer(), np.uint16)
            if k < len(CONTEXTS):
                paths[k, block.as_py()] = states
            else:
                spelled[k - len(CONTEXTS), block.as_py()] = states
    paths, spelled = paths.reshape(len(CONTEXTS), -1), spelled.reshape(len(ORDERS), -1)
    tables = spark.sparkContext.broadcast((paths, spelled))
    model, curves = Model(code, paths, spelled, bits), []
    for turn in range(TURNS):
        one, two, *found = _slopes(rows.where(_turn("id") == turn), shared, tables, bits, model.gates, not turn)
        curves = curves or found
        # Turns have about as many texts each: the first one's curves stand for those so far.
        model.learn([one, two], [c * (turn + 1) for c in curves])
    return shared, tables, bits, model.gates


def score(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counts = word_counts(spark, rows)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    ends = counts.where(F.col("hash") == _END_HASH).agg(F.coalesce(F.max("c"), F.lit(0))).first()[0]
    top = counts.orderBy(F.desc("c"), "hash").limit(HEAD).toArrow()
    order = np.argsort(top.column("hash").to_numpy())
    head, head_c = top.column("hash").to_numpy()[order], top.column("c").to_numpy()[order]
    code, tables, bits, gates = fit(spark, rows, Code(head, head_c, ends, n))

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(code.value, *tables.value, bits, gates)
        logs = np.log10(model.code.given[1] + 1.0)
        for part in parts(batches):
            words = Words(part.column("text"))
            tokens = Tokens(words, model.code, bits).spell()
            costs = model.costs(tokens)
            n_words = np.diff(words.bounds)
            doc = np.repeat(np.arange(len(n_words)), n_words)
            key, known = words.hash.view(np.int64), tokens.known
            rest = [key[a:b][~known[a:b]] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
            logs_sum = np.zeros(len(n_words))  # bincount of nothing would be whole numbers
            if known.any():
                logs_sum = np.bincount(doc[known], logs[tokens.at[known]], minlength=len(n_words))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(n_words + 1),
                    pa.array(np.bincount(doc[known], minlength=len(n_words))),
                    pa.array(logs_sum),
                    pa.array(-costs * math.log10(2)),
                    lists(rest, pa.int64()),
                ],
                names=["id", "n_tokens", "n_head", "head_sum", "score", "rest"],
            )

    kind = "id long, n_tokens long, n_head long, head_sum double, score double, rest array<long>"
    scored = written(
        spark, rows.mapInArrow(score_rows, kind).withColumn("row", F.monotonically_increasing_id()), "scores"
    )
    for used in (code, tables):
        used.destroy()
    # Words outside the head, by a join; the end token is one number for all.
    rest = (
        scored.select("row", F.explode("rest").alias("hash"))
        .join(counts, "hash")
        .groupBy("row")
        .agg(F.count("c").alias("n_rest"), F.sum(F.log10(F.col("c") + 1.0)).alias("rest_sum"))
    )
    logs = F.col("head_sum") + F.coalesce("rest_sum", F.lit(0.0)) + F.lit(math.log10(ends + 1))
    return scored.join(rest, "row", "left").select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rest", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        "score",
    )
