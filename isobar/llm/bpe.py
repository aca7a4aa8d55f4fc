"""Byte-level BPE over a rank file: whole pieces by a minimal perfect hash, other pieces by a heap over linked bytes.

The hash has one slot per vocabulary entry and no empty ones: entries fall into buckets, and each bucket stores the seed
that sends its entries to free slots (a bucket of one stores its slot). A lookup hashes a piece, reads its bucket's seed
and compares the bytes in the one slot it can be in.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pretoken import PieceEncoder, split_spaced
from .shared import small_batches
from .vectext import mix


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens by rank, from a file of base64 tokens and ranks; ranks are 0 to n-1. A plain path is the driver's own file."""
    if "://" in path:
        lines = spark.sparkContext.binaryFiles(path).first()[1].splitlines()
    else:
        with open(path, "rb") as f:
            lines = f.read().splitlines()
    pairs = [x.split() for x in lines if x.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Slot of every key, minimal: n keys, n slots. ``find`` gives the index of keys that are in it, -1 for others."""

    def __init__(self, keys: list[bytes], per_bucket: int = 3) -> None:
        n = len(keys)
        self.n, self.buckets = n, max(1, n // per_bucket)
        self.seeds = np.zeros(self.buckets, np.int64)
        self.index = np.full(n, -1, np.int64)
        self.keys = keys
        h = self._hash(keys)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(cuts)
        free = np.ones(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            members = order[cuts[b] : cuts[b + 1]]
            if len(members) < 2:
                break
            tried, width = 0, 16
            while True:
                slots = np.sort(self._slots(h[members], np.arange(tried, tried + width)), 1)
                fit = free[slots].all(1) & (slots[:, 1:] != slots[:, :-1]).all(1)
                if fit.any():
                    break
                tried, width = tried + width, 1024
            seed = tried + int(fit.argmax())
            slots = self._slots(h[members], np.array([seed]))[0]
            self.seeds[b] = seed
            self.index[slots] = members
            free[slots] = False
        rest = iter(np.flatnonzero(free).tolist())
        for b in np.flatnonzero(sizes == 1):
            slot = next(rest)
            self.seeds[b] = -slot - 1
            self.index[slot] = order[cuts[b]]

    @staticmethod
    def _hash(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slots(self, h: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        return (mix(h + seeds.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def find(self, pieces: list[bytes]) -> list[int]:
        if not pieces or not self.n:
            return [-1] * len(pieces)
        h = self._hash(pieces)
        seed = self.seeds[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = (mix(h + seed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)
        at = self.index[np.where(seed < 0, -seed - 1, slot)].tolist()
        return [i if self.keys[i] == p else -1 for i, p in zip(at, pieces, strict=True)]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the adjacent pair of least rank merges first, the leftmost among equals.

    Tokens are a linked list; the heap holds (rank, place, end of pair). An entry whose pair has changed since is
    skipped, so each merge costs a logarithm of the length.
    """
    n = len(piece)
    end = list(range(1, n + 1))  # of the token that starts here
    before = list(range(-1, n - 1))  # start of the token before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if middle < 0 or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, -1
        if stop < n:
            before[stop] = i
            r = ranks.get(piece[i : end[stop]])
            if r is not None:
                heappush(heap, (r, i, end[stop]))
        p = before[i]
        if p >= 0:
            r = ranks.get(piece[p:stop])
            if r is not None:
                heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def _encoder(keys: list[bytes], perfect: PerfectHash) -> PieceEncoder:
    ranks = {t: i for i, t in enumerate(keys)}

    def resolve(pieces: list[str]) -> list[tuple[int, ...]]:
        raw = [p.encode() for p in pieces]
        return [(i,) if i >= 0 else tuple(merged(p, ranks)) for i, p in zip(perfect.find(raw), raw, strict=True)]

    return PieceEncoder(split_spaced, resolve)


def _decoded(tokens: list[bytes], sizes: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The bytes of each run of ``flat`` between two offsets."""
    if len(flat) and (flat.min() < 0 or flat.max() >= len(tokens)):
        raise ValueError("an id that the vocabulary doesn't have")
    whole = b"".join(map(tokens.__getitem__, flat.tolist()))
    ends = np.concatenate([[0], np.cumsum(sizes[flat])])[offsets]
    return [whole[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def encode(docs: DataFrame, ranks_path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: A002
    """(id, ids array<int>) per row: the whole text's tokens, without special ones.

    Texts split into contractions, runs of letters, of numbers and of other marks, each with one blank before, and white
    space. Null texts count as empty and have no ids. Repeated rows stay repeated; other columns aren't read. The rank
    file must hold all 256 single bytes; it goes to the workers once, as a broadcast of the file's fixed size.
    """
    small_batches(docs.sparkSession)
    tokens = read_ranks(docs.sparkSession, ranks_path)
    table = docs.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*table.value)
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            for row, ids, offsets in encoder.batches(texts):
                made = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(made)), made], names=[id, "ids"])

    source = docs.select(F.col(id), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"`{id}` {source.schema[id].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, ranks_path: str, *, id: str = "doc_id", ids: str = "ids") -> DataFrame:  # noqa: A002
    """(id, ids, decoded binary) per row: the tokens' bytes joined. Null or empty ids give no bytes; an id without a token fails."""
    table = coded.sparkSession.sparkContext.broadcast(read_ranks(coded.sparkSession, ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = table.value
        sizes = np.array([len(t) for t in tokens], np.int64)
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            lengths = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
            parts = _decoded(tokens, sizes, flat, np.concatenate([[0], np.cumsum(lengths)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(parts, pa.binary())], names=[id, "ids", "decoded"])

    source = coded.select(F.col(id), F.col(ids).cast("array<int>").alias("ids"))
    return source.mapInArrow(run, f"`{id}` {source.schema[id].dataType.simpleString()}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: A002
    """(id, n_tokens, ids_sha256, decoded_sha256) per row: the text encoded as by :func:`encode`, and its ids decoded again.

    Both digests are lowercase hex: of the decimal ids joined by commas, and of the decoded bytes. They are made where the text
    is read, so that neither ids nor bytes leave their task. Rows as in ``encode``.
    """
    small_batches(docs.sparkSession)
    tokens = read_ranks(docs.sparkSession, ranks_path)
    table = docs.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, perfect = table.value
        encoder, sizes, names = _encoder(keys, perfect), np.array([len(t) for t in keys], np.int64), [str(i) for i in range(len(keys))]
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in batches:
            for row, ids, offsets in encoder.batches(batch.column(1).fill_null("").to_pylist()):
                cuts = offsets.tolist()
                said = [names[i] for i in ids.tolist()]
                written = [sha(",".join(said[a:b]).encode()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                back = [sha(raw) for raw in _decoded(keys, sizes, ids, offsets)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(back)), pa.array(np.diff(offsets).astype(np.int64)), pa.array(written), pa.array(back)], names=[id, "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"`{id}` {source.schema[id].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
