"""A family of texts just below the threshold: links inside it are found, and the rows made don't grow with its pairs."""

import numpy as np
from pyspark.sql import functions as F

from isobar.llm import minhash


def family(n, common, own):
    """Texts of one common part and words of their own, which share 3-word runs at common / (common + 2 own) or so; every 50th has a near copy."""
    part = " ".join(f"c{k}" for k in range(common))
    texts = {k: part + " " + " ".join(f"u{k}x{j}" for j in range(own)) for k in range(n)}
    copies = {100_000 + k: texts[k] + f" end{k}" for k in range(0, n, 50)}
    return texts | copies


def test_family_below_the_threshold(spark, monkeypatch):
    texts = family(1_500, 300, 32)
    sets = lambda t: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)}
    a, b, c = sets(texts[0]), sets(texts[1]), sets(texts[100_000])
    assert 0.8 < len(a & b) / len(a | b) < 0.85 < len(a & c) / len(a | c)
    monkeypatch.setattr(minhash, "BLOCK", 64)
    monkeypatch.setattr(minhash, "REST", 128)
    made = []
    real = minhash._by_rare_shingles

    def counted(*args):
        rows, sizes = real(*args)
        made.append((rows.count(), minhash._in_blocks(rows, sizes, "group").count()))
        return rows, sizes

    monkeypatch.setattr(minhash, "_by_rare_shingles", counted)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {k: k - 100_000 if k >= 100_000 else k for k in texts}
    (rows, blocks), *_ = made
    # All pairs of the family would be over a million; only near copies have rare shingles in common.
    assert blocks < 10 * len(texts)


def test_prefixes_miss_no_link(spark):
    """Every pair of random sets that is a link meets, whatever its sizes, and is not lost by the order of shingles."""
    rng = np.random.default_rng(7)
    sets = {}
    for base in range(12):
        whole = rng.choice(2**40, 400, replace=False)
        for k in range(12):
            keep = whole[rng.random(400) < (0.995 if k > 8 else rng.uniform(0.86, 1.0))]
            sets[base * 12 + k] = np.unique(np.r_[keep, rng.choice(2**40, 0 if k > 8 else rng.integers(0, 30)), np.arange(20)])
    df = spark.createDataFrame([(k, bytearray(np.sort(s.astype(np.uint64)).tobytes()), len(s)) for k, s in sets.items()], "rep long, shingles binary, n_shingles long")
    for percent in (80, 85, 95):
        rows, sizes = minhash._by_rare_shingles(df.select("rep", F.col("rep").alias("component")), df.select("rep", "n_shingles"), df.select("rep", "shingles"), percent)
        blocks = minhash._in_blocks(rows, sizes, "group")
        near = blocks.alias("x").join(blocks.alias("y"), ["key", "sub", "i", "j"]).where("x.rep < y.rep").select("x.rep", "y.rep").distinct()
        met = {tuple(r) for r in near.collect()}
        links = {(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= percent * len(np.union1d(sets[a], sets[b]))}
        assert links and links <= met
