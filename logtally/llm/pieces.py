"""SentencePiece (BPE model) encoding and decoding by suffix-array matching.

Spaces become the mark U+2581 with one put in front, and no piece crosses from
another character into a mark, so texts are worked on in distinct chunks, each
starting with its marks. New chunks of a batch are laid after each other with
separators and their suffixes sorted (by doubling ranks up to the longest
piece). Binary search gives every piece's range of suffixes, which are its
occurrences: the edges of a graph over positions. Edges are sorted by end
position and relaxed from left to right: of the edges that end at a position,
the one is kept that merging would have made. That is the edge whose piece
stays whole next to the last piece of the encoding before it; merging by score
treats a sequence as final exactly if it does so for all its neighbours, and
exactly one edge per position passes. Characters without a piece become byte
pieces. The model file is only read.

Null and empty texts have no ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtally.llm.tokens import Encoder, crc32, flat_ids, listed
from logtally.llm.words import distinct, parts

MARK = "▁"
MEMO = 400_000  # chunks kept per worker process
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_WALL = 0x110000  # above every character: between chunks


class Model:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes = [p.encode("utf-8") for p in self.pieces]
        self.score: dict[str, float] = {}
        usable = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes[i] = i, bytes([value])
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes[i] = b""
            else:
                self.score[piece] = model.get_score(i)
                usable.append(i)
        # pieces as rows of characters, longest last: what the binary search looks for
        self.ids = np.array(usable)
        self.length = np.array([len(self.pieces[i]) for i in usable])
        self.codes = np.full((len(usable), int(self.length.max())), -1, np.int64)
        for row, i in enumerate(usable):
            self.codes[row, : self.length[row]] = [ord(c) for c in self.pieces[i]]
        self.length_of = np.ones(size + 1, np.int64)
        self.length_of[self.ids] = self.length
        self.unknown = size  # stands for a character without a piece
        self.asked = np.zeros(0, np.int64)  # pairs known, sorted, and their answers
        self.answer = np.zeros(0, bool)

    def _merged(self, text: str) -> list[str]:
        """Plain merging, for two pieces next to each other."""
        found = list(text)
        while len(found) > 1:
            scores = [self.score.get(a + b, -np.inf) for a, b in zip(found, found[1:])]
            best = max(scores)
            if best == -np.inf:
                break
            k = scores.index(best)
            found[k : k + 2] = [found[k] + found[k + 1]]
        return found

    def neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece ``left`` and piece ``right`` as they are."""
        keys = left * (self.unknown + 1) + right
        place = np.searchsorted(self.asked, keys)
        known = np.zeros(len(keys), bool)
        if len(self.asked):
            known = self.asked[np.minimum(place, len(self.asked) - 1)] == keys
        new = distinct(keys[~known])
        if len(new):
            said = np.zeros(len(new), bool)
            for i, key in enumerate(new.tolist()):
                a, b = divmod(key, self.unknown + 1)
                if a == self.unknown or b == self.unknown:
                    said[i] = True
                else:
                    pair = [self.pieces[a], self.pieces[b]]
                    said[i] = self._merged("".join(pair)) == pair
            both = np.concatenate([self.asked, new])
            order = np.argsort(both, kind="stable")
            self.asked, self.answer = both[order], np.concatenate([self.answer, said])[order]
        return self.answer[np.searchsorted(self.asked, keys)]


@cache
def model(path: str) -> Model:
    return Model(path)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the next ``depth`` codes or more."""
    _, rank = np.unique(codes, return_inverse=True)
    done = 1
    while done < depth:
        behind = np.zeros(len(rank), np.int64)
        behind[:-done] = rank[done:] + 1
        _, rank = np.unique(rank.astype(np.int64) * (len(rank) + 2) + behind, return_inverse=True)
        done *= 2
    return np.argsort(rank, kind="stable")


def occurrences(codes: np.ndarray, order: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Start and piece id of every place where a piece stands."""
    padded = np.concatenate([codes, np.full(m.codes.shape[1] + 1, _WALL, np.int64)])
    low = np.zeros(len(m.ids), np.int64)
    high = np.full(len(m.ids), len(order), np.int64)

    def bound(a: np.ndarray, b: np.ndarray, at: int, want: np.ndarray, after: bool) -> np.ndarray:
        a, b = a.copy(), b.copy()
        while (open_ := a < b).any():
            mid = (a + b) // 2
            here = padded[order[np.minimum(mid, len(order) - 1)] + at]
            right = open_ & ((here <= want) if after else (here < want))
            a = np.where(right, mid + 1, a)
            b = np.where(open_ & ~right, mid, b)
        return a

    for at in range(m.codes.shape[1]):
        row = np.flatnonzero((m.length > at) & (low < high))
        want = m.codes[row, at]
        first = bound(low[row], high[row], at, want, False)
        low[row], high[row] = first, bound(first, high[row], at, want, True)
    count = np.maximum(high - low, 0)
    before = np.cumsum(count) - count
    place = np.repeat(low - before, count) + np.arange(count.sum())
    return order[place], np.repeat(m.ids, count)


def encode_chunks(chunks: list[str], m: Model) -> list[list[int]]:
    lengths = np.array([len(c) for c in chunks], dtype=np.int64)
    text = "".join(chunks)
    chars = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1  # the wall behind each chunk
    codes = np.full(len(chars) + len(chunks), _WALL, np.int64)
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = chars
    starts = ends - lengths
    offset = np.arange(len(codes)) - np.repeat(starts, lengths + 1)

    at, piece = occurrences(codes, suffix_array(codes, m.codes.shape[1]), m)
    single = np.zeros(len(codes), bool)
    single[at[m.length_of[piece] == 1]] = True
    lone = np.flatnonzero(inside & ~single)  # no piece of one character: bytes
    at, piece = np.concatenate([at, lone]), np.concatenate([piece, np.full(len(lone), m.unknown)])
    until = at + m.length_of[piece]

    # Edges by end position inside their chunk, then relaxed column by column.
    reach = offset[at] + m.length_of[piece]
    order = np.argsort(reach, kind="stable")
    at, piece, until, reach = at[order], piece[order], until[order], reach[order]
    columns = np.searchsorted(reach, np.arange(1, int(lengths.max()) + 2))
    last = np.full(len(codes) + 1, -1, np.int64)  # piece that ends at a position
    for a, b in zip(columns[:-1].tolist(), columns[1:].tolist(), strict=True):
        if a == b:
            continue
        some = slice(a, b)
        fits = offset[at[some]] == 0
        rest = np.flatnonzero(~fits & (last[at[some]] >= 0))
        fits[rest] = m.neighbours(last[at[some][rest]], piece[some][rest])
        last[until[some][fits]] = piece[some][fits]

    # Back from the end of every chunk.
    here, which = ends.copy(), np.arange(len(chunks))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(which):
        token = last[here]
        here = here - m.length_of[token]
        found.append((which, here, token))
        more = here > starts[which]
        here, which = here[more], which[more]
    which, here, token = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(here, kind="stable")
    which, here, token = which[order], here[order], token[order]
    out: list[list[int]] = []
    bounds = np.searchsorted(which, np.arange(len(chunks) + 1))
    ids, places = token.tolist(), here.tolist()
    bare = bool((token == m.unknown).any())
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        some = ids[a:b]
        if bare and m.unknown in some:
            wide: list[int] = []
            for i, place in zip(some, places[a:b], strict=True):
                if i == m.unknown:
                    wide += m.byte_ids[list(chr(codes[place]).encode("utf-8", "surrogatepass"))].tolist()
                else:
                    wide.append(i)
            some = wide
        out.append(some)
    return out


class PieceEncoder(Encoder):
    """The memo of ``Encoder`` over chunks, new ones by suffix array."""

    def __init__(self, path: str, keep_space: bool) -> None:
        super().__init__(path, keep_space)
        self.memo = MEMO

    def _split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        return listed([_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts.to_pylist()])

    def _fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.arange(len(pieces)), *flat_ids(encode_chunks(pieces, model(self.path)) if pieces else [])


@cache
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path, True)


def decode(ids: np.ndarray, m: Model) -> str:
    text = b"".join(map(m.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text.replace(MARK, " ")[1:]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids) of every text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            ids, offs = encoder(path).encode(part.column("text").to_pylist(), None)
            found = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("id"), found], names=["id", "ids"])

    return docs.select(F.col(id_col).alias("id"), "text").mapInArrow(rows, "id long, ids array<int>")


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """(id, n_ids, ids_crc32, text) from (id, ids): the ids, read back as text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            ids = [np.asarray(i.values.to_numpy()) for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([crc32(i) for i in ids], pa.int64()),
                    pa.array([decode(i, m) for i in ids], pa.string()),
                ],
                names=["id", "n_ids", "ids_crc32", "text"],
            )

    return coded.mapInArrow(rows, "id long, n_ids long, ids_crc32 long, text string")
