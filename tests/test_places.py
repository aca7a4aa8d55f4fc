"""Points near polygons and held by them, in blocks, against plain versions."""

import math
import random

import pytest

from isobar.operators import places as N
from isobar.operators import polygons as P
from tests.test_polygons import RINGS, inside, some_rings


def km(x, y, rings):
    """Kilometres to the nearest edge, 0 inside."""
    if inside(x, y, rings):
        return 0.0
    k, best = math.cos(math.radians(y)), math.inf
    for ring in rings:
        for n, (bx, by) in enumerate(ring):
            ax, ay = ring[n - 1]
            px, py, dx, dy = (ax - x) * k, ay - y, (bx - ax) * k, by - ay
            t = min(max(-(px * dx + py * dy) / (dx * dx + dy * dy), 0), 1)
            best = min(best, math.hypot(px + t * dx, py + t * dy) * N.KM_PER_DEGREE)
    return best


@pytest.fixture
def tables(spark, monkeypatch):
    """Many points in one square, equal polygons of different names, points and polygons without a place; blocks of a few rows."""
    monkeypatch.setattr(N, "POINTS", 7)
    monkeypatch.setattr(N, "POLYGONS", 5)
    monkeypatch.setattr(N, "PAIRS", 50)
    rng = random.Random(4)
    shapes = some_rings(rng, 30)
    shapes += [(k + 100, rings) for k, rings in shapes[:12]] + [(200, []), (201, None)]
    polygons = [(k, rings, None if k == 7 else k % 3, k % 4) for k, rings in shapes]
    points = [(k, rng.uniform(-25, 25), rng.uniform(-25, 25)) for k in range(150)] + [(k, 1 + k / 1e4, 2.0) for k in range(200, 260)] + [(900, None, 1.0)]
    return points, polygons, spark.createDataFrame(points, "p long, x double, y double"), spark.createDataFrame(polygons, f"q long, rings {RINGS}, strength int, g int")


def test_strongest_near(tables):
    points, polygons, p, q = tables
    got = {r.p: (r.n, r.q, r.strength, r.distance) for r in N.strongest_near(p, q, 250.0, "p", "q", "strength").collect()}
    want = {}
    for key, x, y in points:
        near = [(-math.inf if s is None else s, round(d, 3), name) for name, rings, s, _ in polygons if x is not None and rings and (d := km(x, y, rings)) <= 250]
        if near:
            s, d, name = min(near, key=lambda r: (-r[0], r[1], r[2]))
            want[key] = (len(near), name, None if s == -math.inf else s, d)
    assert len(want) > 100 and got.keys() == want.keys()
    assert all(got[k][:3] == want[k][:3] and abs(got[k][3] - want[k][3]) < 0.0011 for k in want)


def test_held_by_any(tables):
    points, polygons, p, q = tables
    got = [(r.g, r.p) for r in N.held_by_any(p, q, "p", "g", at_once=2).collect()]
    want = {(g, key) for key, x, y in points if x is not None for _, rings, _, g in polygons if rings and inside(x, y, rings)}
    assert len(got) == len(want) > 30 and set(got) == want


def test_points_in_meets_blocks(tables, monkeypatch):
    """Every pair that holds, whatever the blocks; pairs that are only tested are no rows."""
    monkeypatch.setattr(P, "HELD", 5, raising=False)
    points, polygons, p, q = tables
    found = P.points_in(p, q, cell=5.0)
    got = [tuple(r) for r in found.collect()]
    want = {(key, name, s, g) for key, x, y in points if x is not None for name, rings, s, g in polygons if rings and inside(x, y, rings)}
    assert found.columns == ["p", "q", "strength", "g"] and len(got) == len(want) > 30 and set(got) == want
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    assert P.points_in(p, q.where("q > 1000")).count() == 0 == P.points_in(p.where("p > 1000"), q).count()


def test_nothing_near(tables):
    _, _, p, q = tables
    assert N.strongest_near(p.where("p > 1000"), q, 250.0, "p", "q", "strength").count() == 0
    assert N.held_by_any(p, q.where("q > 1000"), "p", "g").count() == 0
