"""A file of token ids: blocks of whole documents, each coded by interleaved range asymmetric numeral systems.

Format. A table of blocks in Parquet (``part``, a range of ids; ``start`` of the block among its part's tokens; ``doc_ids``;
``lengths`` as packed int64, ``n_tokens``, ``states``, ``words``, ``checkpoints``, ``crc32`` of the latter three) and one
table of token frequencies that all blocks share. The tokens of a block are dealt to LANES coders in turn;
all of them write 32-bit words into one stream. Every CHECKPOINT steps the place in the stream and all states are kept, so
that a reader can start there. Blocks don't depend on one another: any task decodes any block.

States are 53 bits: 2**21 <= x < 2**53, so that a division of doubles is exact for them. A symbol of frequency f (of
2**bits) first sheds 32 bits if x >= f << (53 - bits). Frequency 2**bits leaves a state as it is, which pads blocks of
different length to one shape.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .hf import prepared, read_tokenizer, text_encoder
from .shared import shared_dir, small_batches, written

LANES = 128
CHECKPOINT = 128
#: Tokens of a block at least, unless it is a part's last; a longer document is a block of its own or ends one.
BLOCK_TOKENS = 1 << 16
#: Blocks that are coded side by side, if none is much longer than BLOCK_TOKENS (such a one is coded by itself).
TOGETHER = 32
#: Stretches between checkpoints that are decoded side by side.
STRETCHES = 256
#: Written parts up to which their starts are broadcast (12 bytes each); beyond, a shuffled join adds them.
BROADCAST_PARTS = 200_000
_LOW, _HIGH = 1 << 21, 53


class Frequencies:
    """Counts scaled to a power of two in which every counted token has one part at least (2**20 at most are told apart)."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        bits = max(18, int(len(tokens)).bit_length() + 1)
        whole, total = 1 << bits, max(int(counts.sum()), 1)
        f = np.maximum(1, (counts.astype(np.float64) * whole / total).astype(np.int64))
        order = np.argsort(-f, kind="stable")
        extra = int(f.sum()) - whole
        if len(f) and extra < 0:
            f[order[0]] -= extra
        k = 0
        while extra > 0:
            give = min(extra, int(f[order[k % len(f)]]) // 2)
            f[order[k % len(f)]] -= give
            extra, k = extra - give, k + 1
        self._set(tokens, f, bits)

    def _set(self, tokens: np.ndarray, f: np.ndarray, bits: int) -> None:
        if bits > 21:
            raise ValueError("too many different tokens for these states")
        self.tokens, self.bits = tokens.astype(np.int64), bits
        # One entry more pads: it covers all parts and changes nothing.
        self.f = np.append(f, 1 << bits).astype(np.int64)
        self.cum = np.append(np.cumsum(f) - f, 0).astype(np.int64)
        #: From this state on a symbol sheds a word; the padding never does.
        self.top = self.f << (_HIGH - bits)
        self.top[-1] = 1 << 62
        self.index = np.full(int(self.tokens.max()) + 1 if len(tokens) else 0, -1, np.int32)
        self.index[self.tokens] = np.arange(len(tokens))
        self.slots = np.repeat(np.arange(len(f), dtype=np.int32), f)
        self.slot_f = np.repeat(f, f)
        self.slot_rest = np.arange(len(self.slots)) - np.repeat(self.cum[:-1], f)

    @classmethod
    def stored(cls, tokens: np.ndarray, f: np.ndarray, bits: int) -> Frequencies:
        out = cls.__new__(cls)
        out._set(tokens, f, bits)
        return out


def encode_blocks(blocks: list[np.ndarray], table: Frequencies) -> list[tuple[bytes, bytes, bytes]]:
    """(states, words, checkpoints) of each block of token ids; none may be empty."""
    steps = max(-(-len(b) // LANES) for b in blocks)
    symbol = np.full((len(blocks), steps * LANES), len(table.tokens), np.int32)
    for k, b in enumerate(blocks):
        symbol[k, : len(b)] = table.index[b]
    symbol = np.ascontiguousarray(symbol.reshape(len(blocks), steps, LANES).transpose(1, 0, 2))
    whole = 1 << table.bits
    x = np.full(symbol.shape[1:], _LOW, np.int64)
    words = np.zeros(symbol.shape, np.uint32)
    sheds = np.zeros(symbol.shape, bool)
    kept: dict[int, np.ndarray] = {}
    f, top = np.empty_like(x), np.empty_like(x)
    for s in range(steps - 1, -1, -1):
        np.take(table.f, symbol[s], out=f, mode="clip")
        np.take(table.top, symbol[s], out=top, mode="clip")
        np.greater_equal(x, top, out=sheds[s])
        words[s] = x
        x = np.where(sheds[s], x >> 32, x)
        q = np.divide(x, f).astype(np.int64)
        np.subtract(whole, f, out=f)
        q *= f
        x += q
        np.take(table.cum, symbol[s], out=f, mode="clip")
        x += f
        if s % CHECKPOINT == 0:
            kept[s] = x.copy()
    out = []
    for k, b in enumerate(blocks):
        mine = -(-len(b) // LANES)
        mask = sheds[:mine, k]
        at = np.concatenate([[0], np.cumsum(mask.sum(1))])
        points = b"".join(np.uint64(at[s]).tobytes() + kept[s][k].astype("<u8").tobytes() for s in range(CHECKPOINT, mine, CHECKPOINT))
        out.append((x[k].astype("<u8").tobytes(), words[:mine, k][mask].astype("<u4").tobytes(), points))
    return out


def decode_blocks(blocks: list[tuple[int, bytes, bytes]], table: Frequencies) -> list[np.ndarray]:
    """Token ids of each block, given as (tokens, states, words)."""
    sizes = np.array([b[0] for b in blocks])
    steps = int(-(-sizes.max() // LANES))
    streams = [np.frombuffer(b[2], "<u4") for b in blocks]
    flat = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.int64)
    at = np.cumsum([0, *(len(s) for s in streams[:-1])]).reshape(-1, 1)
    x = np.stack([np.frombuffer(b[1], "<u8") for b in blocks]).astype(np.int64)
    mask, bits = (1 << table.bits) - 1, table.bits
    symbol = np.zeros((steps, len(blocks), LANES), np.int32)
    full = int(sizes.min()) // LANES
    lane = np.arange(LANES)
    f = np.empty_like(x)
    for s in range(steps):
        slot = x & mask
        np.take(table.slots, slot, out=symbol[s], mode="clip")
        y = x >> bits
        np.take(table.slot_f, slot, out=f, mode="clip")
        y *= f
        np.take(table.slot_rest, slot, out=f, mode="clip")
        y += f
        if s >= full:
            y = np.where(s * LANES + lane < sizes[:, None], y, x)
        # Words are read in order of lanes within each block's own stream.
        need = y < _LOW
        rank = np.cumsum(need, 1, dtype=np.int64)
        rank += at
        np.take(flat, rank - 1, out=f, mode="clip")
        f |= y << 32
        x = np.where(need, f, y)
        at = rank[:, -1:]
    return [table.tokens[symbol[:, k].reshape(-1)[:n]] for k, n in enumerate(sizes)]


def decode_from(states_at: bytes, words: bytes, n_left: int, table: Frequencies) -> np.ndarray:
    """The tokens from a checkpoint (place in the stream and states) to the block's end."""
    at = int(np.frombuffer(states_at[:8], np.uint64)[0])
    return decode_blocks([(n_left, states_at[8:], words[4 * at :])], table)[0]


def stretches(n_tokens: int, states: bytes, words: bytes, points: bytes) -> list[tuple[int, bytes, bytes]]:
    """A block as (tokens, states, words) from its start and each checkpoint to the next one."""
    width, size = 8 + 8 * LANES, CHECKPOINT * LANES
    at = [0, *(int(np.frombuffer(points, np.uint64, 1, k)[0]) for k in range(0, len(points), width)), len(words) // 4]
    begin = [states, *(points[k + 8 : k + width] for k in range(0, len(points), width))]
    return [(min(size, n_tokens - k * size), x, words[4 * at[k] : 4 * at[k + 1]]) for k, x in enumerate(begin)]


def decoded(blocks: list[tuple[int, bytes, bytes, bytes]], table: Frequencies) -> Iterator[np.ndarray]:
    """Token ids of each block (tokens, states, words, checkpoints), from all its checkpoints at once."""
    parts = [stretches(*b) for b in blocks]
    flat = [x for p in parts for x in p]
    made: list[np.ndarray] = []
    done = 0
    for p in parts:
        while len(made) < len(p):
            made += decode_blocks(flat[done : done + STRETCHES], table)
            done += STRETCHES
        yield np.concatenate(made[: len(p)])
        del made[: len(p)]


_BLOCK = "part int, start long, doc_ids array<bigint>, lengths binary, n_tokens long, states binary, words binary, checkpoints binary, crc32 long"


def token_ids(docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: A002
    """(part, start, doc_id, ids binary of unsigned 32-bit numbers) per row.

    Parts are ranges of ids in ascending order; ``start`` counts the part's tokens before the document. Equal ids follow a
    hash of their text, and rows without an id come first.
    """
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(prepared(read_tokenizer(docs.sparkSession, tokenizer_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = text_encoder(spec.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, ids, offsets in encoder.batches(batch.column(1).to_pylist()):
                raw = [np.append(ids[a:b], end_id).astype("<u4").tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                ends = before + np.cumsum(np.diff(offsets) + 1)
                start = np.concatenate([[before], ends])[:-1].astype(np.int64)
                before = int(ends[-1]) if len(ends) else before
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(raw), part, np.int32)), pa.array(start), batch.column(0).slice(row, len(raw)), pa.array(raw, pa.binary())], names=["part", "start", "doc_id", "ids"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text").mapInArrow(run, "part int, start long, doc_id long, ids binary")


def frequencies(coded: DataFrame) -> Frequencies:
    """The shared table, from all tokens; it has a row for each token that occurs, so the vocabulary bounds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                n = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").astype(np.int64), minlength=len(total))
                n[: len(total)] += total
                total = n
        token = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(total[token])], names=["token", "n"])

    found = coded.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    found.sort(key=lambda r: r["token"])
    return Frequencies(np.array([r["token"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64))


def blocks_of(coded: DataFrame, table: Frequencies) -> DataFrame:
    """The file's blocks. Whatever pieces of ``coded`` a task reads, a block holds documents that follow one another in one part."""
    shared = coded.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple[tuple[int, int], list[int | None], list[np.ndarray]]] = []
        head = following = (-1, 0)
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = waiting = 0

        def flush() -> pa.RecordBatch:
            rows = []
            whole = [np.concatenate(ids) for _, _, ids in ready]
            long = [len(b) > 2 * BLOCK_TOKENS for b in whole]
            coded_as: list[tuple[bytes, bytes, bytes] | None] = [encode_blocks([b], shared.value)[0] if far else None for b, far in zip(whole, long, strict=True)]
            short = [k for k, far in enumerate(long) if not far]
            for k, made in zip(short, encode_blocks([whole[k] for k in short], shared.value) if short else [], strict=True):
                coded_as[k] = made
            for ((part, start), names, ids), tokens, (states, words, points) in zip(ready, whole, coded_as, strict=True):
                lengths = np.array([len(i) for i in ids], np.int64)
                rows.append((part, start, names, lengths.tobytes(), len(tokens), states, words, points, zlib.crc32(states + words + points)))
            ready.clear()
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in _BLOCK.split(", ")])

        for batch in batches:
            for part, start, doc, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and (size >= BLOCK_TOKENS or (part, start) != following):
                    ready.append((head, docs, held))
                    waiting += size
                    docs, held, size = [], [], 0
                    if len(ready) == TOGETHER or waiting > 2 * TOGETHER * BLOCK_TOKENS:
                        yield flush()
                        waiting = 0
                if not docs:
                    head = (part, start)
                docs.append(doc), held.append(np.frombuffer(raw, "<u4"))
                size += len(held[-1])
                following = (part, start + len(held[-1]))
        if docs:
            ready.append((head, docs, held))
        if ready:
            yield flush()

    return coded.select("part", "start", "doc_id", "ids").mapInArrow(run, _BLOCK)


def write(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int = 2, id: str = "doc_id", text: str = "text") -> None:  # noqa: A002
    """Writes the file under ``path``: ``blocks`` and ``frequencies``.

    Documents follow in ascending id. A null or empty text is its end token; a row without an id counts as before all.
    """
    coded = written(token_ids(docs, tokenizer_path, end_id=end_id, id=id, text=text), "token-ids")
    table = frequencies(coded)
    blocks_of(coded, table).write.option("compression", "none").parquet(f"{path}/blocks")
    spark = docs.sparkSession
    made = list(zip([table.bits] * len(table.tokens), table.tokens.tolist(), table.f.tolist(), strict=False))
    spark.createDataFrame(made, "bits int, token long, frequency long").coalesce(1).write.parquet(f"{path}/frequencies")


def read(spark: SparkSession, path: str, of: tuple[str, Callable[[bytes], object]] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) per document of the file; ``start`` counts the ids of all documents before it.

    Each block is checked and decoded by itself. A wrong checksum fails the read. ``of``, a column definition and a
    function of a document's packed ids, gives that column in place of ``ids``, so that ids needn't leave their task.
    """
    small_batches(spark, TOGETHER)
    rows = spark.read.parquet(f"{path}/frequencies").orderBy("token").collect()
    table = Frequencies.stored(np.array([r["token"] for r in rows], np.int64), np.array([r["frequency"] for r in rows], np.int64), rows[0]["bits"] if rows else 18)
    shared = spark.sparkContext.broadcast(table)
    column, work = of or ("ids binary", bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(at, TOGETHER).to_pylist()
                for b in some:
                    if zlib.crc32(b["states"] + b["words"] + b["checkpoints"]) != b["crc32"]:
                        raise ValueError(f"the block at {b['start']} of part {b['part']} is damaged")
                for b, ids in zip(some, decoded([(b["n_tokens"], b["states"], b["words"], b["checkpoints"]) for b in some], shared.value), strict=True):
                    lengths = np.frombuffer(b["lengths"], np.int64)
                    ends = np.cumsum(lengths)
                    raw = ids.astype("<u4").tobytes()
                    parts = [work(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ends), b["part"], np.int32)), pa.array(b["doc_ids"], pa.int64()), pa.array(b["start"] + ends - lengths), pa.array(lengths), pa.array(parts)],
                        names=["part", "doc_id", "start", "n_tokens", column.split()[0]],
                    )

    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # One row for each written part: far fewer than blocks, let alone documents.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")).persist()
    few = before.limit(BROADCAST_PARTS + 1).count() <= BROADCAST_PARTS
    docs = blocks.select("part", "start", "doc_ids", "lengths", "n_tokens", "states", "words", "checkpoints", "crc32").mapInArrow(run, f"part int, doc_id long, start long, n_tokens long, {column}")
    placed = docs.join(F.broadcast(before) if few else before, "part")
    return placed.select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", column.split()[0])


def store(docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, id: str = "doc_id", text: str = "text") -> str:  # noqa: A002
    """Writes ``docs`` to a new file in the shared folder and gives its path, for :func:`read`."""
    path = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write(docs, path, tokenizer_path, end_id=end_id, id=id, text=text)
    return path
