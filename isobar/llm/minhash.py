"""Near-duplicate groups by HyperMinHash, confirmed on full shingle sets.

1. Each text becomes a set of hashed word shingles. The set's hashes fall in K registers; a register keeps the least
   hash in floating form (leading-zero count and mantissa bits, 16 bits in all). Empty registers borrow from a filled
   one that a fixed random table picks, so that short texts have K usable registers too.
2. Texts with equal sets are one class: a third of all rows may be one class, and it counts once from here on.
3. Bands of registers put classes in buckets. In a bucket each class is paired with two hubs, never with all others.
   Pairs pass the collision-corrected Jaccard estimate (with a margin of several standard errors), then an exact
   comparison of the full sets. Links form components.
4. Buckets in which several components are left are compared within; pairs of different components whose estimate allows a
   link leave the bucket, and each is confirmed on full sets. So links that both hubs miss are found as well. A bucket of
   more than BLOCK classes is compared in blocks, its largest component against the rest only. Where that rest is large
   too, as in a family of texts just below the threshold, its classes meet by their rarest shingles instead: two sets with the
   overlap that a link needs share one of the few that come first in the order of frequency (a prefix filter, which misses
   nothing), and a family's texts have nothing but its common part in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import components
from .shared import by_group, written
from .vectext import chunks, mix, shingle_sets

MANTISSA_BITS = 10
#: Standard errors below the threshold at which an estimate still leads to an exact comparison.
MARGIN = 6.0
#: Stands for the component of those whom a shingle comes later for.
_LATER = -1
#: Classes of one bucket that are compared together in step 4.
BLOCK = 512
#: Classes outside a bucket's largest component up to which it is compared as it is.
REST = 4 * BLOCK


def _picks(k: int) -> np.ndarray:
    """For each register a fixed random preference among all registers."""
    return np.random.default_rng(20240229).random((k, k), np.float32)


def registers(text: np.ndarray, h: np.ndarray, n: int, k: int, picks: np.ndarray) -> np.ndarray:
    """n x k HyperMinHash registers (uint16) of n sets given as (text, hash); 0 only where a set is empty."""
    least = np.full(n * k, np.iinfo(np.uint64).max, np.uint64)
    place = text * k + (mix(h) % np.uint64(k)).astype(np.int64)
    np.minimum.at(least, place, mix(h ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(1))
    filled = (least != np.iinfo(np.uint64).max).reshape(n, k)
    share, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    mantissa = ((share * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    zeros = np.clip(52 - exponent, 0, 62)
    out = np.where(filled.reshape(-1), (zeros << MANTISSA_BITS) + np.maximum(mantissa, 0) + 1, 0).astype(np.uint16).reshape(n, k)
    for row in np.flatnonzero(~filled.all(1) & filled.any(1)):
        have, lack = np.flatnonzero(filled[row]), np.flatnonzero(~filled[row])
        out[row, lack] = out[row, have[picks[np.ix_(lack, have)].argmin(1)]]
    return out


def _set_keys(of: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and both halves of the 128-bit keys of n sets given as (text, hash)."""
    counts = np.bincount(of, minlength=n)
    hi, lo = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        first = (np.cumsum(counts) - counts)[some]
        hi[some] = np.add.reduceat(mix(h ^ np.uint64(0xA0761D6478BD642F)), first)
        lo[some] = np.add.reduceat(mix(h + np.uint64(0xE7037ED1A0B428DB)), first)
    return counts.astype(np.int64), hi.view(np.int64), lo.view(np.int64)


def signatures(docs: DataFrame, *, text: str = "text", size: int = 3, bands: int = 40, rows: int = 7) -> DataFrame:
    """doc_id, n_shingles, set_hi, set_lo (128-bit key of the whole set), registers (binary) per row of ``docs``."""
    k = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picks = _picks(k)
        for batch in batches:
            for part in chunks(batch.column(1)):
                of, h = shingle_sets(part.lowered(), size)
                n = len(part)
                counts, hi, lo = _set_keys(of, h, n)
                regs = registers(of, h, n, k, picks)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first_row, n), pa.array(counts), pa.array(hi), pa.array(lo), pa.array([r.tobytes() for r in regs], pa.binary())],
                    names=["doc_id", "n_shingles", "set_hi", "set_lo", "registers"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_shingles long, set_hi long, set_lo long, registers binary")


def band_keys(regs: np.ndarray, bands: int) -> np.ndarray:
    """n x bands keys; equal keys mean equal registers in that band (but for 64-bit chance)."""
    parts = regs.reshape(len(regs), bands, -1).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array([np.frombuffer(b, np.uint16) for b in column.to_pylist()])


def _bands(classes: DataFrame, bands: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_matrix(batch.column(1)), bands)
                ids = np.repeat(batch.column(0).to_numpy(), bands)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.tile(np.arange(bands, dtype=np.int32), batch.num_rows))], names=["rep", "key", "band"])

    return classes.select("rep", "registers").mapInArrow(run, "rep long, key long, band int")


def estimate(equal: np.ndarray, k: int, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard from equal registers, less the equal registers that chance gives.

    Two independent minima share exponent and mantissa with probability ab / (a + b)^2 / (2 ln 2) / 2^bits for sets of
    a and b members: a cell's mean width is 1 / (2 ln 2) of its place times 2^-bits.
    """
    a, b = n_a.astype(np.float64), n_b.astype(np.float64)
    chance = a * b / np.maximum(a + b, 1) ** 2 / (2 * np.log(2)) / (1 << MANTISSA_BITS)
    return (equal / k - chance) / (1 - chance)


def _may_link(equal: np.ndarray, k: int, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    t = percent / 100
    error = np.sqrt(t * (1 - t) / np.maximum(np.minimum(np.minimum(n_a, n_b), k), 1))
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (100 * low >= percent * high) & (estimate(equal, k, n_a, n_b) >= t - MARGIN * error)


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch.column(4)), _matrix(batch.column(5))
                keep = _may_link((x == y).sum(1), x.shape[1], batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "r_a", "r_b")
    return both.mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, text: str, size: int) -> DataFrame:
    """(rep, shingles): the full sorted set of each wanted class (rep, first_id, key of its set), as packed 64-bit hashes.

    One doc_id can stand for several texts: a class takes the set that has its key.
    """
    key = ["set_hi", "set_lo", "n_shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.column(1)):
                of, h = shingle_sets(part.lowered(), size)
                counts, hi, lo = _set_keys(of, h, len(part))
                cuts = np.searchsorted(of, np.arange(len(part) + 1))
                packed = [h[cuts[i] : cuts[i + 1]].tobytes() for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(counts), pa.array(packed, pa.binary())], names=[*key, "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), F.col(text).cast("string").alias("text"))
    found = texts.join(wanted.select("first_id").distinct(), "first_id", "left_semi").mapInArrow(run, "set_hi long, set_lo long, n_shingles long, shingles binary")
    return found.dropDuplicates(key).join(wanted.select("rep", *key), key).select("rep", "shingles")


def _shortened(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [np.sort((np.frombuffer(b, np.uint64) >> np.uint64(32)).astype(np.uint32)).tobytes() for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary())], names=["rep", "short"])

    return sets.mapInArrow(run, "rep long, short binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    side = lambda x: sets.select(F.col("rep").alias(x), F.col("shingles").alias(f"s_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "s_a", "s_b")
    return both.mapInArrow(run, "a long, b long")


def _overlaps(short: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members of each of ``others`` are in ``short``; all are sorted and not empty."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(short, flat), len(short) - 1)
    sizes = np.array([len(o) for o in others])
    return np.add.reduceat((short[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)


def _mixed(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, rest, largest): groups with several components, their rows, and those outside their largest component."""
    counts = rows.groupBy(*by, "component").agg(F.count("*").alias("m"))
    sizes = counts.groupBy(*by).agg(F.max(F.struct("m", "component")).alias("main"), F.sum("m").alias("n"))
    return sizes.select(*by, "n", (F.col("n") - F.col("main.m")).alias("rest"), F.col("main.component").alias("largest")).where("rest > 0")


def _by_rare_shingles(rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, sizes) as :func:`_in_blocks` takes them: the classes of ``rows`` (rep, component) by their rare shingles.

    Shingles are ordered by the number of classes that have them, then by their hash. Of two sets of a <= b members whose overlap
    is enough for a link, the first a - ceil(2 p a / (100 + p)) + 1 of the smaller and the first b - ceil(p b / 100) + 1 of the
    larger have one in common. A shingle that is among the former for no class brings nobody together; else those of which it
    is one meet all others, and classes of one component never meet. Rows grow with the sets and with pairs that share a shingle
    that is rare for one of them, not with the pairs of a family.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            again = np.array([len(b) // 8 for b in raw], np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(batch.column(c).to_numpy(), again)) for c in (0, 1)), pa.array(np.frombuffer(b"".join(raw), np.int64))], names=["rep", "component", "sub"])

    several = rows.select("rep", "component").distinct().join(sets, "rep").select("rep", "component", "shingles")
    held = written(several.mapInArrow(run, "rep long, component long, sub long"), "rare-shingles", 8192)
    often = held.groupBy("sub").agg(F.count("*").alias("df"))
    placed = held.join(often, "sub").join(classes.select("rep", "n_shingles"), "rep")
    place = F.row_number().over(Window.partitionBy("rep").orderBy("df", "sub"))
    n = F.col("n_shingles")
    up = lambda x, y: F.call_function("div", x + (y - 1), F.lit(y).cast("long"))
    shorter, longer = n - up(2 * percent * n, 100 + percent) + 1, n - up(percent * n, 100) + 1
    first = placed.withColumn("place", place).where((F.col("place") <= longer) & (F.col("df") > 1))
    first = written(first.select(F.lit(0).cast("long").alias("key"), "sub", F.lit(-1).alias("band"), "rep", "component", (F.col("place") <= shorter).alias("near")), "prefixes", 8192)
    counts = first.groupBy("sub", "component").agg(F.count("*").alias("m"), F.count_if("near").alias("k"))
    sizes = counts.groupBy("sub").agg(F.max(F.struct("m", "component")).alias("main"), F.sum("m").alias("n"), F.sum("k").alias("k")).where("k > 0 and n > main.m")
    # Those whom a shingle comes later for needn't meet each other: where they are more than the largest component, they take its place.
    later = (F.col("n") - F.col("k")) > F.col("main.m")
    sizes = sizes.select(F.lit(0).cast("long").alias("key"), "sub", "n", F.when(later, F.col("k")).otherwise(F.col("n") - F.col("main.m")).alias("rest"), F.when(later, F.lit(_LATER)).otherwise(F.col("main.component")).alias("largest"), later.alias("later"))
    sizes = written(sizes, "rare-sizes", 8192)
    split = first.join(sizes.select("sub", "later"), "sub").withColumn("group", F.when(F.col("later") & ~F.col("near"), F.lit(_LATER)).otherwise(F.col("component")))
    return split.select("key", "sub", "band", "rep", "component", "group"), sizes.drop("later")


def _in_blocks(rows: DataFrame, sizes: DataFrame, part: str = "component") -> DataFrame:
    """``rows`` (key, sub, ..., rep, component) of the groups in ``sizes``, with mine, i, j; ``part`` has their largest part.

    Every pair of different components meets in a pair of blocks i <= j. A group's largest component is set against the
    others only, so that the rows made grow with the others' number.
    """
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    by = [c for c in sizes.columns if c in ("key", "sub")]
    sizes = sizes.select(*by, "largest", blocks(F.col("rest")).alias("rest"), blocks(F.col("n") - F.col("rest")).alias("most"))
    r = rows.join(sizes, by).withColumn("largest", F.col(part) == F.col("largest"))
    place = lambda n: F.pmod(F.xxhash64("rep"), n.cast("long")).cast("int")
    r = r.withColumn("mine", F.when(F.col("largest"), F.col("rest") + place(F.col("most"))).otherwise(place(F.col("rest"))))
    others = F.when(F.col("largest"), F.sequence(F.lit(0), F.col("rest") - 1)).otherwise(F.sequence(F.lit(0), F.col("rest") + F.col("most") - 1))
    r = r.withColumn("other", F.explode(others))
    return r.select(*rows.columns, "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


def _left_over(members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, bands: int, percent: int) -> DataFrame:
    """Pairs of different components in one bucket, or with one rare shingle, that seem linked.

    Registers first, then 32 bits of each shingle's hash decide within the block: few pairs leave it that aren't links,
    and no link stays (shorter hashes can only raise an intersection).
    """
    labelled = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = written(_mixed(labelled, ["key"]), "mixed", 8192)
    whole = [F.lit(0).alias(c) for c in ("mine", "i", "j")]
    uncut = ["key", F.lit(0).cast("long").alias("sub"), "band", "rep", "component"]
    rows = labelled.join(mixed.where(F.col("n") <= BLOCK).select("key"), "key").select(*uncut, *whole)
    large = mixed.where(F.col("n") > BLOCK)
    rows = rows.unionByName(_in_blocks(labelled.select(*uncut), large.where(F.col("rest") <= REST)))
    many = large.where(F.col("rest") > REST).select("key")
    if many.limit(1).count():
        rare, parts = _by_rare_shingles(labelled.join(many, "key"), classes, sets, percent)
        rows = rows.unionByName(_in_blocks(rare, parts, "group").drop("group"))
    short = _shortened(sets)
    rows = rows.join(classes.select("rep", "n_shingles", "registers"), "rep").join(short, "rep")

    def work(t: pa.Table) -> pa.Table | None:
        component = t["component"].to_numpy()
        if (component == component[0]).all():
            return None
        rep, n, mine, band = (t[c].to_numpy() for c in ("rep", "n_shingles", "mine", "band"))
        across = t["i"][0].as_py() != t["j"][0].as_py()
        regs = _matrix(t["registers"])
        keys = band_keys(regs, bands)
        shingles = [np.frombuffer(b, np.uint32) for b in t["short"].to_pylist()]
        found_a, found_b = [], []
        for x in range(len(rep) - 1):
            y = np.arange(x + 1, len(rep))
            y = y[component[y] != component[x]]
            if across:
                y = y[mine[y] != mine[x]]
            if not len(y):
                continue
            y = y[_may_link((regs[y] == regs[x]).sum(1), regs.shape[1], np.broadcast_to(n[x], len(y)), n[y], percent)]
            y = y[(keys[y] == keys[x]).argmax(1) == band[0]] if len(y) and band[0] >= 0 else y
            if len(y):
                common = _overlaps(shingles[x], [shingles[i] for i in y])
                y = y[100 * common >= percent * (n[x] + n[y] - common)]
            if len(y):
                found_a.append(np.minimum(rep[x], rep[y]))
                found_b.append(np.maximum(rep[x], rep[y]))
        if not found_a:
            return None
        return pa.table({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    return by_group(rows, ["key", "sub", "i", "j"], work, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, text: str = "text", size: int = 3, percent: int = 85, bands: int = 40, rows: int = 7) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, with A-Z lower-cased; a set holds the distinct runs of ``size`` words, or
    the whole sequence where a text is shorter. Two rows are linked where 100 * intersection >= percent * union.
    ``component_id`` is the smallest doc_id reachable over links, the row's own included; ``kept`` says it is the own.
    Rows without words (null and empty texts too) have no set and are linked with nothing; rows without an id neither, and
    their component is null. Rows with one doc_id twice
    are one class if their sets are equal, else their links count together. Extra columns are ignored; an empty table
    gives an empty result. A band is missed by a pair at the threshold with 1 - t^rows, so that all bands are missed
    with (1 - 0.85^7)^40 = 2e-7. The estimate then misses a pair at the threshold with P(Binomial(280, 0.85) <= 202) = 2.5e-8.
    """
    sigs = written(signatures(docs, text=text, size=size, bands=bands, rows=rows), "signatures")
    key = ["set_hi", "set_lo", "n_shingles"]
    full = sigs.where("n_shingles > 0 and doc_id is not null")
    # Numbers of classes hold once they are written; a doc_id may stand for several classes.
    first = full.groupBy(*key).agg(F.min("doc_id").alias("first_id"), F.first("registers").alias("registers"))
    classes = written(first.select(F.monotonically_increasing_id().alias("rep"), "first_id", *key, "registers"), "classes")
    banded = _bands(classes, bands)
    shared = banded.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("hub"), F.min(F.struct(F.xxhash64("rep", "key").alias("h"), "rep"))["rep"].alias("hub2")).where("n > 1")
    members = written(banded.join(shared, "key").select("key", "band", "rep", "hub", "hub2"), "members", 8192)
    to_hub = lambda c: members.where(F.col("rep") != F.col(c)).select(F.least("rep", c).alias("a"), F.greatest("rep", c).alias("b"))
    pairs = to_hub("hub").union(to_hub("hub2")).distinct()
    sets = written(_sets(docs, classes.drop("registers").join(members.select("rep").distinct(), "rep", "left_semi"), text, size), "sets")
    links = written(_confirmed(_estimated(pairs, classes, percent), sets, percent), "links")
    # The classes of one doc_id are linked with each other.
    of_id = full.select("doc_id", *key).distinct().join(classes.select(*key, "rep"), key).select("doc_id", "rep")
    several = of_id.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("doc_id", "a")
    links = links.union(of_id.join(several, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")))
    labels = components(links)
    more = written(_confirmed(_left_over(members, labels, classes, sets, bands, percent), sets, percent), "more")
    if more.limit(1).count():
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    of_class = classes.drop("registers").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    of_class = written(of_class, "of-class")
    # Written, so that Spark can split a large component in the join.
    ids = written(of_class.groupBy("component").agg(F.min("first_id").alias("component_id")), "ids")
    of_class = of_class.join(ids, "component").select(*key, "component_id")
    out = sigs.select("doc_id", *key).join(of_class, key, "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
