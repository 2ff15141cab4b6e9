"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

Both vocabularies split a text before they merge, so what stands between two
such splits can be encoded on its own. For the word vocabulary texts are cut at
white space; for the byte vocabulary at the splits of its regular expression
that the classes of neighbouring bytes decide. Where they don't (an apostrophe
before a letter, letters beyond Latin), there is no cut. Strings of special
tokens become these tokens, as the library does by default. A memo of bounded
size keeps the ids of pieces seen. Texts for which the classes may mislead
(special tokens, white space beyond ASCII) are encoded whole.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from logtally.llm.words import flat, mix, seeds

MEMO = 800_000  # pieces kept per worker process
LONGEST = 256  # bytes of a piece that is kept

# Classes of bytes to the byte vocabulary: any other, space, other white space, letter, digit, mark.
_OTHER, _SPACE, _BREAK, _LETTER, _DIGIT, _MARK = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[0x20], _KIND[0x09:0x0E], _KIND[0x30:0x3A] = _SPACE, _BREAK, _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0xC3:0xC6] = _LETTER  # U+00C0 to U+017F by their first byte
_KIND_OF = _KIND.tobytes()
_NO_LETTERS = 0x97, 0xB7  # behind 0xC3
# White space beyond ASCII, or taken for it by some, as UTF-8.
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WIDE_FIRST = np.zeros(256, bool)
_WIDE_FIRST[[*range(0x1C, 0x20), *{w[0] for w in _WIDE}]] = True


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _break(path: str) -> list[int]:
    return _tokenizer(path).encode("\n", add_special_tokens=False).ids


_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")
JOINED = 512  # words encoded at once

# A Latin word, with a space before it or not, and marks behind it: both
# vocabularies split between the two, so their ids follow each other.
_MARKED_WORD = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!%*#$&|?;]+)")


class Encoder:
    """``keep_space``: a space belongs to the word behind it (byte vocabulary)."""

    def __init__(self, path: str, keep_space: bool) -> None:
        self.path, self.keep_space = path, keep_space
        self.memo = MEMO
        # Pieces by their hash, sorted, and their numbers; all else by number, first seen first.
        self.keys, self.number = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.name, self.name_end = np.zeros(0, np.uint8), np.zeros(0, np.int64)  # as UTF-8
        self.ids, self.end = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _find(self, hashes: np.ndarray, pieces: pa.Array) -> np.ndarray:
        """Numbers of the pieces that the memo has, else -1; equal hashes are confirmed on the bytes."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        order, at = np.argsort(hashes), np.empty(len(hashes), np.int64)
        at[order] = np.searchsorted(self.keys, hashes[order])  # neighbours in turn, for the cache
        at = np.minimum(at, len(self.keys) - 1)
        data, offs = flat(pieces)
        length, number = np.diff(offs), self.number[at].astype(np.int64)
        start = np.where(number > 0, self.name_end[number - 1], 0)
        alike = np.flatnonzero((self.keys[at] == hashes) & (self.name_end[number] - start == length))
        here, size = offs[:-1][alike], length[alike]
        before = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(before, size)
        odd = data[np.repeat(here, size) + within] != self.name[np.repeat(start[alike], size) + within]
        wrong = np.unique(np.searchsorted(before, np.flatnonzero(odd), side="right") - 1) if odd.any() else []
        found = np.full(len(hashes), -1, np.int64)
        found[alike] = number[alike]
        found[alike[wrong]] = -1
        return found

    def _split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct pieces, the number of each piece in them, and n + 1 piece offsets."""
        if self.keep_space:
            return _split_classes(texts, _specials(self.path))
        return _split_spaces(texts) if _has_separators(texts) else _split_words(texts)

    def _fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces the memo lacks: an order of theirs, their ids in it, and the end of each one's."""
        return self._joined(pieces) if self.keep_space else (np.arange(len(pieces)), *flat_ids(self._encoded(pieces)))

    def _encoded(self, pieces: list[str]) -> list[list[int]]:
        """Ids of the pieces; a word and the marks behind it are encoded, and kept, on their own."""
        split = {p: m.groups() for p in pieces if (m := _MARKED_WORD.fullmatch(p))}
        roots = list(dict.fromkeys(r for p in pieces for r in split.get(p, (p,))))
        names = pa.array(roots, pa.string())
        hashes = _hashes(_Each(names))
        known = self._find(hashes, names)
        bounds = np.append(0, self.end)
        ids = {roots[i]: self.ids[bounds[k] : bounds[k + 1]].tolist() for i, k in enumerate(known.tolist()) if k >= 0}
        new = np.flatnonzero(known < 0)
        found = self._whole([roots[i] for i in new.tolist()])
        ids |= {roots[i]: f for i, f in zip(new.tolist(), found, strict=True)}
        self._keep(hashes[new], names.take(pa.array(new)), *flat_ids(found))
        return [ids[p] if p in ids else [*ids[split[p][0]], *ids[split[p][1]]] for p in pieces]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_whole``, flat and in the order given with it.

        Words are encoded many at a time, a line each: the end of a line is a
        token of its own before and after them.
        """
        plain = [i for i, p in enumerate(pieces) if _WORD.fullmatch(p)]
        lines = ["\n".join([pieces[i] for i in plain[a : a + JOINED]]) for a in range(0, len(plain), JOINED)]
        ids = np.fromiter(itertools.chain.from_iterable(i + _break(self.path) for i in self._whole(lines)), np.uint32)
        ends = np.flatnonzero(ids == _break(self.path)[0])
        if len(ends) != len(plain):
            raise ValueError("words and lines differ in number")
        chosen = np.zeros(len(pieces), bool)
        chosen[plain] = True
        rest = np.flatnonzero(~chosen)
        rest_ids, rest_ends = flat_ids(self._whole([pieces[i] for i in rest.tolist()]))
        ids, ends = np.delete(ids, ends), ends - np.arange(len(ends))
        return np.append(np.flatnonzero(chosen), rest), np.append(ids, rest_ids), np.append(ends, len(ids) + rest_ends)

    def _whole(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in _tokenizer(self.path).encode_batch_fast(pieces, add_special_tokens=False)]

    def _keep(self, hashes: np.ndarray, pieces: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """Add pieces until the memo is full: those seen first, so the frequent ones, stay."""
        room = self.memo - len(self.end)
        if not room or not len(hashes):
            return
        values, first = np.unique(hashes, return_index=True)
        at = np.searchsorted(self.keys, values)
        fresh = np.append(self.keys, 0)[at] != values
        fresh |= at == len(self.keys)
        data, offs = flat(pieces)
        fresh &= np.diff(offs)[first] <= LONGEST
        first = np.sort(first[fresh])[:room]
        if not len(first):
            return
        for own, own_end, more, bounds in (("name", "name_end", data, offs), ("ids", "end", ids, np.append(0, ends))):
            size = np.diff(bounds)[first]
            at = np.repeat(bounds[first], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            setattr(self, own_end, np.append(getattr(self, own_end), len(getattr(self, own)) + np.cumsum(size)))
            setattr(self, own, np.append(getattr(self, own), more[at]))
        order = np.argsort(hashes[first], kind="stable")
        place = np.searchsorted(self.keys, hashes[first][order])
        numbers = len(self.end) - len(first) + order
        self.keys = np.insert(self.keys, place, hashes[first][order])
        self.number = np.insert(self.number, place, numbers.astype(np.int32))

    def encode(self, texts: list[str | None] | pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids after each other, each text's followed by ``end_id`` if given; n + 1 offsets."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        texts = pc.fill_null(texts, "")
        pieces, which, ends = self._split(texts)
        hashes = _hashes(_Each(pieces))
        known = self._find(hashes, pieces)
        unknown = np.flatnonzero(known < 0)
        new = pieces.take(pa.array(unknown)).to_pylist()
        order, new_ids, new_end = self._fresh(new)
        unknown = unknown[order]
        # The memo's ids and, behind them, those of the pieces it lacks.
        table = np.concatenate([self.ids, new_ids])
        bounds = np.concatenate([[0], self.end, len(self.ids) + new_end])
        known[unknown] = len(self.end) + np.arange(len(unknown))
        if end_id is not None:  # one more piece, behind each text
            table, bounds = np.append(table, np.uint32(end_id)), np.append(bounds, bounds[-1] + 1)
            which = np.insert(which, ends[1:], len(known))
            known, ends = np.append(known, len(bounds) - 2), ends + np.arange(len(ends))
        length = np.diff(bounds)[known][which]
        before = np.concatenate([[0], np.cumsum(length)])
        at = np.repeat(bounds[known][which] - before[:-1], length)
        at += np.arange(len(at))
        if len(unknown):
            self._keep(hashes[unknown], pieces.take(pa.array(unknown)), new_ids, new_end)
        return table[at], before[ends]


class _Each:
    """A column of pieces, which also gives them one by one."""

    def __init__(self, column: pa.Array) -> None:
        self.column = column

    def __iter__(self) -> Iterator[str]:
        return iter(self.column.to_pylist())


def _hashes(pieces: _Each) -> np.ndarray:
    """Of length, first, middle and last eight bytes; equal ones are told apart on the bytes."""
    data, offs = flat(pieces.column)
    start, size = offs[:-1], np.diff(offs)
    padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 9, "<u8", padded, 0, (1,))  # from each byte on
    short = np.uint64(8) * (np.uint64(8) - np.minimum(size, 8).astype(np.uint64)) & np.uint64(63)
    low = np.where(size > 0, eight[start + 8] << short, 0)
    high = np.where(size > 0, eight[start + size] >> short, 0)
    middle = np.where(size > 16, eight[start + 8 + size // 2 - 4], 0)
    code = seeds(4, 14)
    return mix(mix(low * code[0] + size.astype(np.uint64)) + high * code[1] + middle * code[2]).view(np.int64)


def flat_ids(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids after each other, and the end of each list."""
    ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
    return np.fromiter(itertools.chain.from_iterable(ids), np.uint32), ends


def _has_separators(texts: pa.Array) -> bool:
    """Any of U+001C to U+001F: white space to Arrow, text to the vocabulary."""
    return bool(pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py())


@cache
def _specials(path: str) -> list[str]:
    return [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]


def _coded(pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct pieces, and the number of each piece in them."""
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def listed(split: list[list[str]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As ``_split_words``, of texts that are split already."""
    ends = np.cumsum([0, *map(len, split)])
    return *_coded(pa.array(itertools.chain.from_iterable(split), pa.string(), size=int(ends[-1]))), ends


def _split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces between white space, the number of each piece in them, and n + 1 piece offsets."""
    lists = pc.utf8_split_whitespace(texts)
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(filled)])
    return *_coded(words.filter(pa.array(filled))), before[ends]


def _split_spaces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As ``_split_words``, between spaces and line ends alone."""
    return listed([[p for p in text.replace("\n", " ").split(" ") if p] for text in texts.to_pylist()])


def _split_classes(texts: pa.Array, specials: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As ``_split_words``, where the byte vocabulary's expression splits for certain.

    It takes runs of letters, digits or other marks, each with a space before
    it, and leaves the last of several white spaces to what follows.
    """
    data, offs = flat(texts)
    n = len(data)
    kind = np.full(n + 2, _OTHER, np.uint8)
    kind[1:-1] = np.frombuffer(data.tobytes().translate(_KIND_OF), np.uint8)
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    no_letter = (data[lead] == 0xC3) & np.isin(data[lead + 1], _NO_LETTERS)
    kind[lead + 2] = _LETTER
    kind[lead[no_letter] + 1] = kind[lead[no_letter] + 2] = _OTHER
    first = np.zeros(n + 1, bool)  # a text begins, or all end
    first[offs] = True
    before, now, after = kind[:-2], kind[1:-1], kind[2:]
    space, space_before = (now == _SPACE) | (now == _BREAK), (before == _SPACE) | (before == _BREAK)
    space_after = (after == _SPACE) | (after == _BREAK)
    last = ~space_after & ~first[1:]  # something follows
    apart = (now != before) & (before != _SPACE) & (((now != _OTHER) & (before != _OTHER)) | space_before)
    quote = np.flatnonzero(data == 0x27) + 1
    quote = quote[quote < n]
    apart[quote[now[quote] == _LETTER]] = False  # 's, 're and the like
    cut = first[:-1] | np.where(space, ~space_before | last, apart)
    whole = _misleading(texts, data, offs, specials)
    if len(whole):
        inside = np.zeros(len(texts), bool)
        inside[whole] = True
        cut &= first[:-1] | ~np.repeat(inside, np.diff(offs))
    start = np.flatnonzero(cut)
    pieces = pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(np.append(start, n).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )
    return *_coded(pieces), np.searchsorted(start, offs)


def _misleading(texts: pa.Array, data: np.ndarray, offs: np.ndarray, specials: list[str]) -> np.ndarray:
    """Numbers of the texts with special tokens, separators, or white space beyond ASCII."""
    odd = pc.match_substring(texts, specials[0]) if specials else pa.array(np.zeros(len(texts), bool))
    for s in specials[1:]:
        odd = pc.or_(odd, pc.match_substring(texts, s))
    odd = odd.to_numpy(zero_copy_only=False).copy()
    at = np.flatnonzero(_WIDE_FIRST[data])
    if len(at):
        three = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.int64)
        three = three[at] << 16 | three[at + 1] << 8 | three[at + 2]
        wide = data[at] < 0x20
        for w in _WIDE:
            code = int.from_bytes(w.ljust(3, b"\0"), "big")
            wide |= (three & (-1 << 8 * (3 - len(w)))) == code
        odd[np.searchsorted(offs, at[wide], side="right") - 1] = True
    return np.flatnonzero(odd)


@cache
def encoder(path: str, keep_space: bool) -> Encoder:
    """The worker's own: its memo serves all tasks that the worker runs."""
    return Encoder(path, keep_space)


def crc32(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
