"""Packing documents into sequences: length patterns fitted by non-negative least squares, then best fit for the rest.

1. Documents become pieces of at most ``capacity`` tokens; how many there are of each length is all that the plan needs
   (at most ``capacity`` numbers, whatever the corpus).
2. Patterns of few kinds of documents are enumerated on a coarse grid of lengths: up to four documents that fill a sequence,
   or up to two and as many repeats of one short length as the rest holds. Non-negative least squares give each a repeat
   count, which is rounded down.
3. A pattern's repeats take exact lengths from its grid cells so that nothing is left over; for short lengths one of the
   repeats is a longer one that takes up the rest. Where no exact lengths are left, a pattern is laid no more.
4. What is left goes, longest first, to the smallest gap that holds it. Patterns are fitted to several shares of the
   histogram, as short documents that patterns use up are missing from the rest; and, for lengths that leave gaps in any
   case, with the last document the longest that still fits, patterns whose gap is above a limit being taken back. Of all
   these the plan of the fewest sequences is taken, and of equal ones that with the most patterns.
5. The plan says for each length which ranks go where. Pieces get their rank within their length in salted parts, so
   one very common length spreads over tasks, and look their place up.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .hf import prepared, read_tokenizer, text_encoder
from .shared import free_name, small_batches, written

#: Cells of the coarse grid, and the most documents in a pattern.
CELLS = 64
DEPTH = 4
#: Gaps above which a pattern's sequences are taken back, as tried; -1 takes all of them back.
TAKE_BACK = (float("inf"), 64, 16, 4, 1, 0, -1)
#: Shares of the histogram that patterns without gaps are fitted to, and steps of the fit.
SHARES, STEPS = (1.0, 0.95, 0.85, 0.7, 0.55), 600
#: Upper ends of the cells that repeats come from: lengths are finer there than the coarse grid.
SHORT = (2, 4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024)
#: Pieces of one length and salt that are ranked together, about.
RANKED = 20_000


def pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 1, id: str = "doc_id", text: str = "text", of: tuple[str, Callable[[bytes], object]] | None = None) -> DataFrame:  # noqa: A002
    """(id, piece, start, length, ids) per piece: a document's tokens and its end token, cut every ``capacity`` tokens.

    ``ids`` holds little-endian unsigned 32-bit numbers. A null or empty text is the end token alone. ``of``, a column
    definition and a function of a piece's packed ids, gives that column in place of ``ids``: they needn't leave their task.
    """
    column, work = of or ("ids binary", bytes)
    small_batches(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(prepared(read_tokenizer(docs.sparkSession, tokenizer_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(spec.value)
        for batch in batches:
            for row, ids, offsets in encoder.batches(batch.column(1).fill_null("").to_pylist()):
                at, piece, start, length, raw = [], [], [], [], []
                for k in range(len(offsets) - 1):
                    own = np.append(ids[offsets[k] : offsets[k + 1]], end_id).astype("<u4")
                    for p, s in enumerate(range(0, len(own), capacity)):
                        part = own[s : s + capacity]
                        at.append(row + k), piece.append(p), start.append(s), length.append(len(part)), raw.append(work(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(raw)],
                    names=[id, "piece", "start", "length", column.split()[0]],
                )

    source = docs.select(F.col(id), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"`{id}` {source.schema[id].dataType.simpleString()}, piece int, start long, length long, {column}")


def patterns(cells: int, depth: int) -> list[tuple[int, ...]]:
    """Every way to fill ``cells`` with up to ``depth`` parts, largest first."""

    def fill(left: int, most: int, parts: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif parts:
            for x in range(min(left, most), 0, -1):
                if x * parts >= left:
                    for rest in fill(left - x, x, parts - 1):
                        yield (x, *rest)

    return list(fill(cells, cells, depth))


def nonnegative_fit(a: np.ndarray, b: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """x >= 0 of least squared a x - b, by cyclic coordinate descent."""
    gram, x = a.T @ a, np.zeros(a.shape[1])
    g = -(a.T @ b)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(x)):
            step = max(x[j] - g[j] / gram[j, j], 0.0) - x[j]
            if step:
                x[j] += step
                g += gram[:, j] * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def projected_fit(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 of least squared a x - b, by accelerated projected gradients: for many more patterns than cells."""
    x = y = np.zeros(a.shape[1])
    rate, t = 1.0 / max(np.linalg.norm(a, 2) ** 2, 1e-12), 1.0
    for _ in range(steps):
        new = np.maximum(y - rate * (a.T @ (a @ y - b)), 0.0)
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x


class _Open:
    """Sequences with room left: groups of equal ones by their gap."""

    def __init__(self) -> None:
        self.gaps: list[int] = []
        self.groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def add(self, gap: int, count: int, held: list[tuple[int, int]]) -> None:
        if gap not in self.groups:
            insort(self.gaps, gap)
            self.groups[gap] = []
        self.groups[gap].append((count, held))

    def smallest(self, least: int) -> tuple[int, int, list[tuple[int, int]]] | None:
        k = bisect_left(self.gaps, least)
        if k == len(self.gaps):
            return None
        gap = self.gaps[k]
        count, held = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap], self.gaps[k]
        return gap, count, held


def _laid(left: np.ndarray, capacity: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sequences by patterns, as (gap, how many, [(length, pieces of it in each)]); takes their pieces out of ``left``."""
    laid: list[tuple[int, int, list[tuple[int, int]]]] = []
    width = max(1, capacity // CELLS)
    cells = capacity // width
    cell_of = -(-np.arange(capacity + 1) // width)
    counts = np.bincount(np.minimum(cell_of, cells), weights=left, minlength=cells + 1)[1:]
    found = [p for p in patterns(cells, DEPTH) if all(counts[x - 1] for x in p)]
    if not found:
        return laid
    a = np.zeros((cells, len(found)))
    for j, p in enumerate(found):
        for x in p:
            a[x - 1, j] += 1
    weight = np.arange(1, cells + 1)[:, None] / cells
    repeats = np.floor(nonnegative_fit(a * weight, counts * weight[:, 0])).astype(np.int64)
    for j in np.argsort(-repeats, kind="stable"):
        times = int(repeats[j])
        while times > 0:
            took: list[int] = []
            space = capacity
            for k, x in enumerate(found[j]):
                last = k == len(found[j]) - 1
                top = min(space if last else x * width, x * width + (width if last else 0), capacity)
                held = left[: top + 1].copy()
                for t in took:
                    if t <= top:
                        held[t] -= 1
                have = np.flatnonzero(held[(x - 1) * width + 1 :] > 0)
                if not len(have):
                    break
                took.append(int(have[-1]) + (x - 1) * width + 1)
                space -= took[-1]
            if len(took) < len(found[j]):
                break
            need = {t: took.count(t) for t in took}
            run = min(times, *(int(left[t]) // n for t, n in need.items()))
            for t, n in need.items():
                left[t] -= run * n
            laid.append((space, run, sorted(need.items(), reverse=True)))
            times -= run
    return laid


class _Grid:
    """Cells of lengths: the coarse ones, then those that repeats come from, each with its lengths' range and mean."""

    def __init__(self, counts: np.ndarray, capacity: int) -> None:
        self.width = max(1, capacity // CELLS)
        coarse = [(k * self.width + 1, min((k + 1) * self.width, capacity)) for k in range(-(-capacity // self.width))]
        ends = [e for e in SHORT if e < capacity // 2]
        fine = [(a + 1, e) for a, e in zip([0, *ends], ends, strict=False)]
        self.coarse, self.ranges = len(coarse), coarse + fine
        lengths = np.arange(len(counts))
        self.total = np.array([counts[a : e + 1].sum() for a, e in self.ranges], float)
        self.mean = np.array([(counts[a : e + 1] * lengths[a : e + 1]).sum() / max(n, 1) for (a, e), n in zip(self.ranges, self.total, strict=True)])

    def patterns(self, capacity: int) -> list[tuple[tuple[int, ...], int]]:
        """(cells of single documents, cell of repeats or -1) of every pattern whose cells hold documents."""
        held = [k for k in range(len(self.ranges)) if self.total[k]]
        single = {k for k in held if k < self.coarse}
        # A length lies half a cell under its cell's end on average, so that n documents that fill a sequence end n / 2 cells higher.
        out = [(tuple(x - 1 for x in p), -1) for up in range(3) for p in patterns(self.coarse + up, DEPTH) if len(p) // 2 <= up <= (len(p) + 1) // 2 and all(x - 1 in single for x in p)]
        some = [()] + [(k,) for k in sorted(single)] + [(j, k) for j in sorted(single) for k in sorted(single) if k <= j and not (j % 4 or k % 4)]
        for r in held:
            if r >= self.coarse:
                out += [(s, r) for s in some if self.repeats(s, r, capacity) >= 2]
        return out

    def repeats(self, singles: tuple[int, ...], cell: int, capacity: int) -> int:
        return int((capacity - sum(self.mean[k] for k in singles)) // self.mean[cell])

    def matrix(self, found: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each cell in each pattern, and in all; repeats count in the coarse cell of their mean."""
        a = np.zeros((self.coarse, len(found)))
        for j, (singles, cell) in enumerate(found):
            for k in singles:
                a[k, j] += max(self.mean[k], 1.0)
            if cell >= 0:
                lo, hi = self.ranges[cell]
                inside = range((lo - 1) // self.width, (hi - 1) // self.width + 1)
                weight = np.array([self.total[k] * self.mean[k] for k in inside])
                a[list(inside), j] += self.repeats(singles, cell, capacity) * self.mean[cell] * weight / max(weight.sum(), 1e-9)
        return a, self.total[: self.coarse] * self.mean[: self.coarse]


def _most(left: np.ndarray, lo: int, hi: int, took: list[int]) -> int:
    """The commonest length of a range, less what is taken already; 0 if none is left."""
    held = left[lo : hi + 1].copy()
    for t in took:
        if lo <= t <= hi:
            held[t - lo] -= 1
    k = int(np.argmax(held)) if len(held) else 0
    return lo + k if len(held) and held[k] > 0 else 0


def _last_two(left: np.ndarray, lo: int, hi: int, space: int, took: list[int], slack: int) -> tuple[int, int] | None:
    """A length of a range and the one that fills ``space`` with it, the pair of which the most are left."""
    hi = min(hi, space - 1)
    if lo > hi:
        return None
    held = left
    if took:
        held = left.copy()
        for t in took:
            held[t] -= 1
    u = np.arange(lo, hi + 1)
    v = space - u
    fits = np.minimum(held[u], held[v])
    fits = np.where(u == v, held[u] // 2, fits)
    fits = np.where((v <= u) | (v <= lo + slack), fits, 0)
    k = int(np.argmax(fits))
    return (int(u[k]), int(v[k])) if fits[k] > 0 else None


def _repeated(left: np.ndarray, lo: int, hi: int, space: int, took: list[int]) -> dict[int, int] | None:
    """Repeats of one length of a range that fill ``space``, one of them longer by what would be left over."""
    best, chosen = 0, None
    lengths = np.flatnonzero(left[lo : hi + 1]) + lo
    for x in lengths[np.argsort(-left[lengths], kind="stable")][:12].tolist():
        n, over = divmod(space, x)
        need = {x: n} if not over else {x: n - 1, x + over: 1}
        need = {t: k for t, k in need.items() if k}
        if not n or x + over >= len(left):
            continue
        run = min((int(left[t]) - took.count(t)) // k for t, k in need.items())
        if run > best:
            best, chosen = run, need
    return chosen


def _exact(left: np.ndarray, capacity: int, share: float) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sequences by patterns that leave no gap, as :func:`_laid` gives them; takes their pieces out of ``left``."""
    laid: list[tuple[int, int, list[tuple[int, int]]]] = []
    grid = _Grid(left, capacity)
    found = grid.patterns(capacity)
    if not found:
        return laid
    a, b = grid.matrix(found, capacity)
    repeats = np.floor(projected_fit(a / capacity, share * b / capacity)).astype(np.int64)
    for j in np.argsort(-repeats, kind="stable"):
        times = int(repeats[j])
        singles, cell = found[j]
        while times > 0:
            took: list[int] = []
            first = singles if cell >= 0 else singles[:-2]
            for k in first:
                t = _most(left, *grid.ranges[k], took)
                if not t or sum(took) + t > capacity:
                    break
                took.append(t)
            space = capacity - sum(took)
            if len(took) < len(first) or space <= 0:
                break
            if cell >= 0:
                need = _repeated(left, *grid.ranges[cell], space, took)
            elif len(singles) == 1:
                need = None
            else:
                pair = _last_two(left, *grid.ranges[singles[-2]], space, took, 2 * grid.width)
                need = None if pair is None else {t: pair.count(t) for t in pair}
            if need is None:
                break
            need = dict(need)
            for t in took:
                need[t] = need.get(t, 0) + 1
            run = min(times, *(int(left[t]) // n for t, n in need.items()))
            if run <= 0:
                break
            for t, n in need.items():
                left[t] -= run * n
            laid.append((0, run, sorted(need.items(), reverse=True)))
            times -= run
    return laid


def _filled(left: np.ndarray, capacity: int, room: _Open) -> int:
    """Puts every piece of ``left``, longest first, into the smallest gap that holds it; says how many sequences it opened."""
    opened = 0
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            spot = room.smallest(length)
            if spot is None:
                each = min(capacity // length, n)
                new = n // each
                room.add(capacity - each * length, new, [(length, each)])
                n -= new * each
                opened += new
                continue
            gap, count, held = spot
            each = min(gap // length, n)
            used = min(count, n // each)
            if used < count:
                room.add(gap, count - used, held)
            room.add(gap - each * length, used, [*held, (length, each)])
            n -= used * each
    return opened


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal sequences for pieces of the given lengths: (how many sequences, [(length, pieces of it in each)]).

    Never more sequences than best fit over all pieces would need: that is the plan in which every pattern is taken back.
    Of plans with equally many sequences the one with the most by patterns is taken.
    """
    return _planned(histogram, capacity)[0]


def _planned(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, list[tuple[int, int]]]], int]:
    """The plan and how many of its sequences were begun by patterns."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    done: list[tuple[int, list[tuple[int, int]]]] = []
    if left[capacity]:
        done.append((int(left[capacity]), [(capacity, 1)]))
        left[capacity] = 0
    tried = []
    for share in SHARES:
        rest = left.copy()
        tried.append((_exact(rest, capacity, share), rest, (float("inf"),)))
    rest = left.copy()
    tried.append((_laid(rest, capacity), rest, TAKE_BACK))
    best, chosen = None, _Open()
    for laid, after, limits in tried:
        for limit in limits:
            room, rest, kept = _Open(), after.copy(), 0
            for gap, count, held in laid:
                if gap <= limit:
                    room.add(gap, count, held)
                    kept += count
                else:
                    for length, n in held:
                        rest[length] += count * n
            needed = (kept + _filled(rest, capacity, room), -kept)
            if best is None or needed < best:
                best, chosen = needed, room
    # Equal sequences come from several steps; they are one group of the plan.
    alike: dict[tuple[tuple[int, int], ...], int] = {}
    for gap in chosen.gaps:
        for count, held in chosen.groups[gap]:
            alike[tuple(held)] = alike.get(tuple(held), 0) + count
    return [*done, *((count, list(held)) for held, count in alike.items())], -best[1]


def pack(table: DataFrame, *, capacity: int = 4096, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``table`` with sequence_id and offset; rows of ``length`` 1 to ``capacity`` share sequences of ``capacity``.

    Offsets in a sequence run gapless from 0. Rows with equal ``order`` columns may swap places if a task is repeated, nothing else: give columns that tell rows apart. An empty
    table stays empty; a length outside 1 to ``capacity`` fails. Give a table that reads the same each time (a written
    one): it is read for the counts and again for the places.
    """
    counts = table.groupBy(length).agg(F.count("*").alias("n")).collect()
    if any(not 1 <= (r[length] or 0) <= capacity for r in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    total = sum(r["n"] for r in counts)
    keys, first_rank, base, each, offset = [], {}, [], [], []
    sequences = 0
    for many, held in plan({r[length]: r["n"] for r in counts}, capacity):
        at = 0
        for size, per in held:
            rank = first_rank.get(size, 0)
            keys.append((size << 44) + rank)
            base.append(sequences), each.append(per), offset.append(at)
            first_rank[size] = rank + many * per
            at += size * per
        sequences += many
    by_key = np.argsort(np.array(keys, np.int64), kind="stable")
    slots = tuple(np.array(x, np.int64)[by_key] for x in (keys, base, each, offset))
    shared = table.sparkSession.sparkContext.broadcast(slots)
    salts = max(16, total // RANKED)
    salt, size_of, before_it, rank_of = (free_name(table, n) for n in ("salt", "n_of_salt", "before_salt", "rank"))
    salted = table.withColumn(salt, F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    groups = salted.groupBy(length, salt).agg(F.count("*").alias(size_of))
    before = groups.withColumn(before_it, F.sum(size_of).over(Window.partitionBy(length).orderBy(salt)) - F.col(size_of)).drop(size_of)
    ranked = salted.withColumn(rank_of, F.row_number().over(Window.partitionBy(length, salt).orderBy(*order)) - 1).join(before, [length, salt])
    ranked = ranked.select(*table.columns, (F.col(before_it) + F.col(rank_of)).alias(rank_of))
    names = table.columns
    at_length = names.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, per, inside = shared.value
        for batch in batches:
            size, rank = batch.column(at_length).to_numpy().astype(np.int64), batch.column(len(names)).to_numpy()
            k = np.searchsorted(key, (size << 44) + rank, "right") - 1
            j = (size << 44) + rank - key[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(first[k] + j // per[k]), pa.array(inside[k] + j % per[k] * size)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id long, offset long")


def sequences(placed: DataFrame, ids: DataFrame, keys: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """(sequence_id, pieces array<struct<offset, doc_id, piece, ids>>), in the order of offsets: the packed sequences themselves.

    ``keys`` must name a piece uniquely. A sequence's size is bounded by its capacity.
    """
    rows = placed.select(*keys, "sequence_id", "offset").join(ids.select(*keys, "ids"), list(keys))
    return rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", *keys, "ids"))).alias("pieces"))


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: A002
    """Per piece of every document: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are their end token. Rows with one id twice are two documents. Extra columns aren't read.
    """
    cut = pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id, id=id, text=text, of=("ids_crc32 long", zlib.crc32))
    return pack(written(cut, "pieces"), capacity=capacity, order=(id, "piece", "ids_crc32"))
