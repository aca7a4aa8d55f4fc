"""Splitting text into the pieces that a BPE vocabulary merges within, as array operations on code points.

Every piece that recurs in a batch is resolved once, and a table of hashes keeps pieces between batches.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np

from .vectext import span_hashes

OTHER, LETTER, NUMBER, BLANK, SPACE = range(5)
#: Code points that are worked on together.
CHUNK_CHARS = 1 << 19
#: The Unicode property White_Space, but for U+0020.
_WHITE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, from Unicode's general categories."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LN":
            out[cp] = LETTER if kind == "L" else NUMBER
    out[_WHITE] = SPACE
    out[0x20] = BLANK
    return out


def _edges(c: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class before each place (255 at a text's start), whether the class after is no white space, and text starts."""
    n = len(c)
    before = np.full(n, 255, np.uint8)
    before[1:] = c[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    before[cuts] = 255
    text_after = np.zeros(n, bool)
    text_after[:-1] = c[1:] < BLANK
    ends = offsets[1:]
    text_after[ends[ends > 0] - 1] = False
    return before, text_after, cuts


def _contractions(cp: np.ndarray, c: np.ndarray, start: np.ndarray, offsets: np.ndarray) -> None:
    """Makes 's 't 'm 'd 're 've 'll pieces of their own where a piece begins with the apostrophe."""
    at = np.flatnonzero((cp == 39) & start)
    if not len(at):
        return
    end = offsets[np.searchsorted(offsets, at, "right")]
    a = np.where(at + 1 < end, cp[np.minimum(at + 1, len(cp) - 1)], 0)
    b = np.where(at + 2 < end, cp[np.minimum(at + 2, len(cp) - 1)], 0)
    one = np.isin(a, [ord(x) for x in "stmd"])
    two = ~one & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
    for which, size in ((one, 2), (two, 3)):
        i = at[which]
        start[i + 1] = False
        nxt = i + size
        nxt = nxt[nxt < end[which]]
        start[nxt[c[nxt] == LETTER]] = True


def split_spaced(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ : every character is in one."""
    c = classes()[cp]
    before, text_after, _ = _edges(c, offsets)
    white = c >= BLANK
    start = ~white & (c != before) & (before != BLANK)
    start |= white & ((before < BLANK) | (before == 255) | text_after)
    _contractions(cp, c, start, offsets)
    at = np.flatnonzero(start)
    return at, np.append(at[1:], len(cp)) if len(at) else at


def split_words(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of 's|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+ : white space is in none."""
    c = classes()[cp]
    before, _, _ = _edges(c, offsets)
    white = c >= BLANK
    start = ~white & ((c != before) | (c == NUMBER))
    _contractions(cp, c, start, offsets)
    stop = start | (white & (before < BLANK))
    stop[offsets[:-1][offsets[:-1] < len(cp)]] = True
    at, ends = np.flatnonzero(start), np.append(np.flatnonzero(stop), len(cp))
    return at, ends[np.searchsorted(ends, at, "right")]


Split = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class _Store:
    """Ids of pieces by the pieces' hashes, in sorted arrays: a large one, and a small one that joins it when it has grown."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.levels = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(2)]
        self.ids, self.used = np.zeros(1 << 12, np.int32), 0

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's ids begin in ``ids`` (-1 where it isn't known), and how many they are."""
        at, n = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for known, begin, size in self.levels:
            if len(known):
                i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[i] == hashes
                at[hit], n[hit] = begin[i[hit]], size[i[hit]]
        return at, n

    def add(self, hashes: np.ndarray, found: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, found), np.int64, len(found))
        total = int(size.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * total, np.int32)])
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.int32, total)
        begin = self.used + np.cumsum(size) - size
        self.used += total
        small = [np.concatenate(x) for x in zip(self.levels[1], (hashes, begin, size), strict=True)]
        if len(small[0]) > 1 << 16:
            small = [np.concatenate(x) for x in zip(self.levels[0], small, strict=True)]
            self.levels = [self._sorted(small), tuple(x[:0] for x in small)]
        else:
            self.levels[1] = self._sorted(small)
        return begin, size

    @staticmethod
    def _sorted(level: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        order = np.argsort(level[0])
        return tuple(x[order] for x in level)

    @property
    def full(self) -> bool:
        return len(self.levels[0][0]) + len(self.levels[1][0]) > self.limit


class PieceEncoder:
    """Token ids of whole texts: ``split`` gives pieces, ``resolve`` the ids of pieces that aren't known yet.

    About ``known`` pieces are kept between batches, some 40 bytes each; pieces are told apart by 64-bit hashes.
    """

    def __init__(self, split: Split, resolve: Callable[[list[str]], Sequence[Sequence[int]]], known: int = 600_000) -> None:
        self.split, self.resolve, self.store = split, resolve, _Store(known)

    def batches(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, offsets): the texts in order, about CHUNK_CHARS code points at a time."""
        row = 0
        while row < len(texts):
            to, size = row, 0
            while to < len(texts) and (to == row or size + len(texts[to]) <= CHUNK_CHARS):
                size += len(texts[to])
                to += 1
            yield row, *self._encode(texts[row:to])
            row = to

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = "".join(texts)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=offsets[1:])
        cp = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        start, end = self.split(cp, offsets)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        kinds, first, which = np.unique(span_hashes(cp, start, end), return_index=True, return_inverse=True)
        if self.store.full:
            self.store.clear()
        at, size = self.store.places(kinds)
        new = np.flatnonzero(at < 0)
        if len(new):
            pieces = [whole[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            at[new], size[new] = self.store.add(kinds[new], self.resolve(pieces))
        n = size[which]
        ends = np.cumsum(n)
        ids = self.store.ids[np.repeat(at[which] - (ends - n), n) + np.arange(ends[-1])]
        cut = np.searchsorted(start, offsets)
        return ids, np.concatenate([[0], ends])[cut]
