"""Word spans and hashes of whole Arrow batches of text, as NumPy arrays.

A batch's texts lie back to back in one byte buffer, so that splitting,
hashing and counting are array operations over that buffer: no Python loop
over words. Words never cross texts. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on together: it bounds the arrays' memory.
CHUNK_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = []
        for b in (_BASE, inverse):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


@dataclass
class Texts:
    """Some texts of a batch: the bytes, where each text starts (and the last ends), and the rows they come from."""

    data: np.ndarray
    offsets: np.ndarray
    first_row: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        return Texts(_LOWER[self.data], self.offsets, self.first_row)


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column's texts in order, whole, about ``size`` bytes at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        last = min(max(last, row + 1), len(column))
        yield Texts(data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], row)
        row = last


@dataclass
class Words:
    """Words of some texts: byte spans, and the text that each belongs to."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    counts: np.ndarray  # words of each text
    first: np.ndarray  # index of each text's first word


def words(texts: Texts) -> Words:
    """Maximal runs without the ASCII spaces 0x09-0x0D and 0x20."""
    n, inside = len(texts.data), ~_SPACE[texts.data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = texts.offsets[:-1]
    before[cuts[cuts < n]] = False
    ends = texts.offsets[1:]
    after[ends[ends > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, texts.offsets)
    counts = np.diff(first)
    return Words(start, end, np.repeat(np.arange(len(texts)), counts), counts, first[:-1])


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, wherever the span lies."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start])


def windows(w: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of every run of ``size`` words within one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(w.text[:n] == w.text[size - 1 :])
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = mix(h + hashes[at + k] + np.uint64(0x632BE59BD9B4E019))
    return h, w.text[at], at


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles, sorted by text: (text, hash).

    A text with fewer words than ``size`` has its whole sequence as one; a text without words has none.
    """
    w = words(texts)
    hashes = span_hashes(texts.data, w.start, w.end)
    h, text, _ = windows(w, hashes, size)
    for n in range(1, size):
        short = np.flatnonzero(w.counts == n)
        if len(short):
            one = np.zeros(len(short), np.uint64)
            for k in range(n):
                one = mix(one + hashes[w.first[short] + k] + np.uint64(0x632BE59BD9B4E019))
            h, text = np.concatenate([h, mix(one + np.uint64(n))]), np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]
