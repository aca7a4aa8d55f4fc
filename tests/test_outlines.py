"""Significances against recursion, rings under a shared budget against repeated simplification."""

import math
import random
from collections import defaultdict

import pytest

from isobar.functions.simplification import significance, simplify
from isobar.operators.outlines import within_budget
from isobar.plans import registry
from isobar.plans.shapes import paths

POINTS = "array<struct<x:double,y:double>>"


def distance(p, a, b, metric):
    k = math.cos(math.radians((a[1] + b[1]) / 2)) if metric == "cosine" else 1
    dx, dy, px, py = (b[0] - a[0]) * k, b[1] - a[1], (p[0] - a[0]) * k, p[1] - a[1]
    n, along = math.hypot(dx, dy), px * dx + py * dy
    if metric != "line" and (along <= 0 or along >= n * n):
        return math.hypot(px, py) if along <= 0 else math.hypot(px - dx, py - dy)
    return abs(dx * py - dy * px) / n if n else math.hypot(px, py)


def kept(points, tolerance, metric="line"):
    if len(points) < 3:
        return list(points)
    d = [distance(p, points[0], points[-1], metric) for p in points[1:-1]]
    if max(d) <= tolerance:
        return [points[0], points[-1]]
    m = d.index(max(d)) + 1
    return kept(points[: m + 1], tolerance, metric)[:-1] + kept(points[m:], tolerance, metric)


def ring_at(points, tolerance):
    points = list(points)
    if len(points) > 1 and points[0] == points[-1]:
        points.pop()
    if len(points) > 3:
        away = [math.hypot(p[0] - points[0][0], p[1] - points[0][1]) for p in points]
        far = away[1:].index(max(away[1:])) + 1
        points = kept(points[: far + 1], tolerance) + kept([*points[far:], points[0]], tolerance)[1:-1]
    out = []
    for p in points:
        q = tuple(math.floor(c * 10 + 0.5) / 10 for c in p)
        if not out or out[-1] != q:
            out.append(q)
    while len(out) > 1 and out[0] == out[-1]:
        out.pop()
    return out if len(out) >= 3 else []


def doubled(rings, budget):
    for k in range(8):
        out = {i: ring_at(r, 0.05 * 2**k) for i, r in rings.items()}
        if sum(map(len, out.values())) <= budget:
            return {i: r for i, r in out.items() if r}, 0.05 * 2**k
    return None, None


def some_ring(rng, n, size):
    return [(size * (0.6 + 0.4 * rng.random()) * math.cos(2 * math.pi * k / n) + 3, size * (0.6 + 0.4 * rng.random()) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def frame(spark, rings, columns="g string, i long"):
    return spark.createDataFrame([(g, i, None if r is None else [{"x": x, "y": y} for x, y in r]) for (g, i), r in rings.items()], f"{columns}, p {POINTS}")


@pytest.mark.parametrize("metric", ["segment", "line", "cosine"])
def test_paths_equal_recursion(spark, metric):
    rng = random.Random(1)
    given = {("a", k): [(rng.uniform(-9, 9), rng.uniform(40, 60)) for _ in range(rng.choice([0, 1, 2, 3, 30, 200]))] for k in range(40)} | {("a", 99): None, ("a", 100): [(1.0, 2.0)] * 7, ("a", 101): [(k * 1.0, 5.0) for k in range(3_000)]}
    for tolerance in (0.0, 1.0, 4.0):
        got = {r.i: r.s for r in frame(spark, given).select("i", simplify("p", tolerance, metric).alias("s")).collect()}
        for (_, i), points in given.items():
            assert (None if points is None else [tuple(p) for p in got[i]]) == (None if points is None else kept(points, tolerance, metric) if len(points) < 3_000 else [points[0], points[-1]]) or i == 100
    assert len(got[100]) == 2


def test_significance_never_grows_inwards(spark):
    rng = random.Random(8)
    rings = {("g", k): some_ring(rng, rng.choice([1, 2, 3, 4, 60]), 20) for k in range(20)} | {("g", 50): []}
    worths = {r.i: r.s for r in frame(spark, rings).select("i", significance("p", "line", closed=True).alias("s")).collect()}
    for (_, i), r in rings.items():
        assert len(worths[i]) == len(r)
        assert sum(s == math.inf for s in worths[i]) == (2 if len(r) > 3 else len(r))


def test_budgets_equal_doubling_where_it_ends(spark):
    rng = random.Random(4)
    rings = {(g, 10 * j + k): some_ring(rng, rng.choice([3, 4, 12, 90]), rng.choice([0.04, 0.5, 6, 20])) for j, g in enumerate("abcd") for k in range(9)}
    rings |= {("a", 900): None, ("b", 901): [], ("b", 902): [(0.0, 0.0), (9.0, 0.0)], ("c", 903): [*rings["c", 20], rings["c", 20][0]], ("c", 904): [(math.nan, 1.0), *rings["c", 21]]}
    for budget in (2_000, 150, 60, 20, 7):
        got, tolerances = defaultdict(dict), {}
        for r in within_budget(frame(spark, rings), ["g"], "p", budget).collect():
            got[r.g][r.i], tolerances[r.g] = [tuple(p) for p in r.p], r.tolerance
        for g in "abcd":
            own = {i: [p for p in (r or []) if not math.isnan(p[0])] for (x, i), r in rings.items() if x == g}
            want, tolerance = doubled(own, budget)
            assert sum(map(len, got[g].values())) <= budget
            if want is not None:
                assert got[g] == want and (not want or tolerances[g] == tolerance)
            else:
                assert budget < 60 and all(len(r) >= 3 for r in got[g].values())


def test_many_triangles_stay_in_the_budget(spark):
    rings = {("g", k): [(k * 40.0, 0.0), (k * 40.0 + 99, 0.0), (k * 40.0, 8.0 + k)] for k in range(30)}
    got = within_budget(frame(spark, rings), ["g"], "p", 31).collect()
    assert sorted(r.i for r in got) == list(range(20, 30))


def test_query_equals_doubling(spark, data):
    nation = {r.c_custkey: r.c_nationkey for r in spark.read.parquet(f"{data}/customer.parquet").collect()}
    rings = defaultdict(dict)
    for r in paths(spark, data).collect():
        rings[nation[r.o_custkey]][r.o_custkey] = [tuple(p) for p in r.p]
    got = defaultdict(dict)
    for r in registry.queries()["outlines_within_budget"](spark, data).collect():
        got[r.c_nationkey][r.o_custkey] = [tuple(p) for p in r.p]
    for n, own in rings.items():
        want, _ = doubled(own, 300)
        assert want is None or got[n] == want
        assert sum(map(len, got[n].values())) <= 300
