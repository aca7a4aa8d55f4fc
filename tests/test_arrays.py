"""Array expressions of large tiles, and exact ranks, against plain versions."""

import time

import numpy as np
from pyspark.sql import functions as F

from isobar.functions import text as X
from isobar.operators import aggregates as A
from isobar.operators import grids as G


def tiles(spark, n, size, seed=0):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(k, rng.integers(0, 9, size * size).astype(float).tolist()) for k in range(n)], "k long, v array<double>")


def test_large_tiles_take_time_in_proportion(spark):
    """200 tiles of 1,024 values: each array is made once, not once for each use of it."""
    df = tiles(spark, 200, 32).withColumn("w", F.transform("v", lambda x: x + 1)).cache()
    df.count()
    computed = F.transform("v", lambda x: F.floor(x * 2).cast("double"))
    for made in (X.run_length(computed.cast("array<int>")), G.window_sums(computed, 32, 32, 2), G.smooth(computed, 32, 32), G.gradient(G.smooth(computed, 32, 32), 32, 32, "x")):
        start = time.time()
        assert df.select(made.alias("m")).where("m is not null").agg(F.count("m")).first()[0] == 200
        assert time.time() - start < 25


def test_tile_operators_equal_plain_ones(spark):
    size = 11
    for r in tiles(spark, 3, size, 1).select("v", G.window_sums(F.col("v"), size, size, 2).alias("s"), G.smooth(F.col("v"), size, size).alias("m"), X.run_length(F.col("v").cast("array<int>")).alias("c")).collect():
        a = np.array(r.v).reshape(size, size)
        for j in range(size):
            for i in range(size):
                near = a[max(j - 2, 0) : j + 3, max(i - 2, 0) : i + 3]
                assert r.s[j * size + i] == near.sum()
                w = {(dj, di): (2 - abs(dj)) * (2 - abs(di)) for dj in (-1, 0, 1) for di in (-1, 0, 1) if 0 <= j + dj < size and 0 <= i + di < size}
                assert abs(r.m[j * size + i] - sum(a[j + dj, i + di] * x for (dj, di), x in w.items()) / sum(w.values())) < 1e-12
        code, k = [], 0
        flat = a.reshape(-1).astype(int).tolist()
        while k < len(flat):
            n = next((m for m in range(k, len(flat)) if flat[m] != flat[k]), len(flat)) - k
            code.append(f"{flat[k]}*{n}" if n > 1 else str(flat[k]))
            k += n
        assert r.c == ",".join(code)


def test_run_length_of_empty_and_null(spark):
    got = spark.createDataFrame([([],), (None,), ([7],), ([7, 7],)], "v array<int>").select(X.run_length(F.col("v")).alias("c")).collect()
    assert [r.c for r in got] == ["", None, "7", "7*2"]


def test_exact_ranks_equal_sorting(spark):
    """One key holds most rows, one value most of another key's rows; nulls have no rank."""
    rng = np.random.default_rng(2)
    rows = [("a", float(x)) for x in rng.normal(size=4000)] + [("b", float(x)) for x in np.where(rng.random(900) < 0.8, 5.0, rng.normal(size=900))] + [("c", 1.0), ("d", 2.0), ("d", 3.0), ("d", None), (None, 4.0)]
    at = {"first": lambda n: F.lit(0), "middle": lambda n: F.floor(n / 2), "last": lambda n: n - 1, "beyond": lambda n: n}
    got = {r.k: r for r in A.at_ranks(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", at).collect()}
    for k in ("a", "b", "c", "d"):
        v = sorted(x for key, x in rows if key == k and x is not None)
        assert (got[k].n, got[k].first, got[k].middle, got[k].last, got[k].beyond) == (len(v), v[0], v[len(v) // 2], v[-1], None)
