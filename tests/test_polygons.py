"""Polygon joins, clipping and areas against plain versions."""

import math
import random

from pyspark.sql import functions as F

from isobar.functions import geometry as Geo
from isobar.operators import polygons as P
from isobar.plans import areas, registry

RINGS = "array<array<struct<x:double,y:double>>>"
BOX = (2.0, 1.0, 8.0, 6.0)


def in_ring(x, y, ring):
    c = False
    for k, (bx, by) in enumerate(ring):
        ax, ay = ring[k - 1]
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            c = not c
    return c


def inside(x, y, rings):
    return bool(rings) and in_ring(x, y, rings[0]) and not any(in_ring(x, y, r) for r in rings[1:])


def some_rings(rng, n, spread=20):
    out = []
    for k in range(n):
        cx, cy, r = rng.uniform(-spread, spread), rng.uniform(-spread, spread), rng.uniform(0.5, 6)
        ring = [(cx + r * rng.uniform(0.5, 1) * math.cos(t * math.tau / 7), cy + r * rng.uniform(0.5, 1) * math.sin(t * math.tau / 7)) for t in range(7)]
        out.append((k, [ring] + ([[(cx + (x - cx) * 0.3, cy + (y - cy) * 0.3) for x, y in ring]] if k % 2 else [])))
    return out


def test_points_in_polygons_with_holes(spark):
    rng = random.Random(1)
    polygons = some_rings(rng, 60) + [(100, []), (101, None)]
    points = [(k, rng.uniform(-25, 25), rng.uniform(-25, 25)) for k in range(800)] + [(900, None, 1.0)]
    got = P.points_in(spark.createDataFrame(points, "p long, x double, y double"), spark.createDataFrame(polygons, f"q long, rings {RINGS}"), cell=3.0).select("p", "q").collect()
    want = {(p, q) for p, x, y in points if x is not None for q, r in polygons if r and inside(x, y, r)}
    assert len(got) == len(want) > 100 and {tuple(r) for r in got} == want


def test_cell_percentages(spark):
    rng = random.Random(2)
    polygons = [(k % 2, k % 5, k % 3, [[(x + (175 if k % 4 == 0 else 0), y) for x, y in r] for r in rings]) for k, rings in some_rings(rng, 40)]
    frame = spark.createDataFrame(polygons, f"day int, sample int, kind int, rings {RINGS}")
    samples = spark.createDataFrame([(d, s) for d in (0, 1, 2) for s in range(6)], "day int, sample int")
    grid = {"x0": -190.0, "y0": -25.0, "step": 1.5, "nx": 240, "ny": 34}
    got = {(r.day, r.kind, r.j, r.i): r.percent for r in P.cell_percentages(frame, samples, day="day", sample="sample", kind="kind", **grid).collect()}
    hit = set()
    for d, s, k, rings in polygons:
        for turn in (0, -360) if any(x > 180 for x, _ in rings[0]) else (0,):
            for j in range(grid["ny"]):
                for i in range(grid["nx"]):
                    x, y = grid["x0"] + (i + 0.5) * 1.5 - turn, grid["y0"] + (j + 0.5) * 1.5
                    if abs(x - rings[0][0][0]) < 15 and inside(x, y, rings):
                        hit.add((d, s, k, j, i))
    want = {}
    for d, _, k, j, i in hit:
        want[d, k, j, i] = want.get((d, k, j, i), 0) + 1
    assert got == {key: math.floor(100 * n / 6 + 0.5) for key, n in want.items()} and len(got) > 200


def plain_clip(points, w, s, e, n):
    for axis, limit, keep in ((0, w, 1), (0, e, -1), (1, s, 1), (1, n, -1)):
        out = []
        for k, b in enumerate(points):
            a = points[k - 1]
            ina, inb = (a[axis] - limit) * keep >= 0, (b[axis] - limit) * keep >= 0
            if ina != inb:
                t = (limit - a[axis]) / (b[axis] - a[axis])
                cut = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
                cut[axis] = limit
                out.append(tuple(cut))
            if inb:
                out.append(b)
        points = out
    return points


def test_rings_clipped_by_expressions(spark):
    rng = random.Random(3)
    rows = [(k, [(rng.uniform(-1, 11), rng.uniform(-1, 8)) for _ in range(rng.randrange(3, 9))]) for k in range(80)] + [(90, []), (91, None)]
    got = spark.createDataFrame(rows, "k long, r array<struct<x:double,y:double>>").select("k", Geo.clip_to_box(F.col("r"), *BOX).alias("c")).collect()
    for r in got:
        ring = dict(rows)[r.k]
        assert (r.c is None) == (ring is None)
        if ring is not None:
            want = plain_clip(ring, *BOX)
            assert len(r.c) == len(want) and all(abs(p.x - x) < 1e-9 and abs(p.y - y) < 1e-9 for p, (x, y) in zip(r.c, want, strict=True))


def test_paths_clipped_into_parts(spark):
    """Places along a path that lie inside the box are those that its parts pass through."""
    rng = random.Random(4)
    rows = [(k, [(rng.uniform(-1, 11), rng.uniform(-1, 8)) for _ in range(rng.randrange(1, 9))]) for k in range(60)] + [(90, []), (91, [(0.0, 3.0), (10.0, 3.0), (10.0, 5.0), (0.0, 5.0)])]
    got = {r.k: r.c for r in spark.createDataFrame(rows, "k long, r array<struct<x:double,y:double>>").select("k", Geo.clip_line(F.col("r"), *BOX).alias("c")).collect()}
    assert [[(p.x, p.y) for p in part] for part in got[91]] == [[(2.0, 3.0), (8.0, 3.0)], [(8.0, 5.0), (2.0, 5.0)]]
    w, s, e, n = BOX
    for k, path in rows:
        length = sum(math.dist((a.x, a.y), (b.x, b.y)) for part in got[k] for a, b in zip(part[:-1], part[1:], strict=True))
        want, pieces = 0.0, 4000
        for a, b in zip(path[:-1], path[1:], strict=True):
            inside_share = sum(w <= a[0] + (b[0] - a[0]) * (t + 0.5) / pieces <= e and s <= a[1] + (b[1] - a[1]) * (t + 0.5) / pieces <= n for t in range(pieces)) / pieces
            want += inside_share * math.dist(a, b)
        assert abs(length - want) < 0.02 * (1 + len(path))
        assert all(len(part) > 1 and all(w - 1e-9 <= p.x <= e + 1e-9 and s - 1e-9 <= p.y <= n + 1e-9 for p in part) for part in got[k])


def test_worst_days(spark, data):
    """Against sums of clipped areas in plain Python."""
    rows = areas.shapes(spark, data).select("day", "kind", "rings").collect()
    totals = {}
    for r in rows:
        for name, w, s, e, n in areas.AREAS:
            c = plain_clip([(p.x, p.y) for p in r.rings[0]], w, s, e, n)
            if len(c) >= 3:
                twice = abs(sum(c[k - 1][0] * c[k][1] - c[k][0] * c[k - 1][1] for k in range(len(c))))
                km2 = twice / 2 * 111.32**2 * math.cos(math.radians(sum(y for _, y in c) / len(c)))
                totals.setdefault((name, r.day), [0.0, 0.0])[r.kind] += km2
            totals.setdefault((name, r.day), [0.0, 0.0])
    want = {}
    for (name, day), (moderate, severe) in totals.items():
        key = (-math.floor((moderate + 3 * severe) / 1000 + 0.5), -severe, day)
        want[name] = min(want.get(name, key), key)
    got = {r.area: (-r["index"], r.day) for r in registry.queries()["worst_days"](spark, data).collect()}
    assert got == {name: (k[0], k[2]) for name, k in want.items()}


def _more_suppliers(spark, folder, keys, customers=None):
    """The tables with suppliers of these keys, and customers (key, balance) where given."""
    spark.createDataFrame([(k, f"s{k}", k % 25, 0.0) for k in keys], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    if customers:
        spark.createDataFrame([(k, f"c{k}", k % 25, v, "") for k, v in customers], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{folder}/customer.parquet")


def _sql_rows(folder, name):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"create view {f.split('.')[0]} as select * from '{folder}/{f}/*.parquet'")
    return sorted(con.execute(registry.oracle_sql()[name]).fetchall())


def test_cells_on_an_edge_are_as_in_the_sql(spark, tmp_path):
    """Centres that lie on an edge: differences of rounded doubles put some of them on the other side."""
    _more_suppliers(spark, tmp_path, range(6000))
    for name in ("polygon_cell_percentages", "strongest_layer_cells"):
        assert sorted(tuple(r) for r in registry.queries()[name](spark, str(tmp_path)).collect()) == _sql_rows(tmp_path, name)


def test_points_on_an_edge_are_as_in_the_sql(spark, tmp_path):
    """Each of these customers lies on an edge of one of these suppliers."""
    customers = [(10265, 2627.2), (16986, 6074.0), (25265, 2627.2), (27188, 460.0), (28959, 16.0), (59767, 1842.0), (69998, 183.0)]
    _more_suppliers(spark, tmp_path, [1312, 1484, 1683, 3644, 3898, 4157, 4796], customers)
    got = sorted(tuple(r) for r in registry.queries()["points_in_polygons"](spark, str(tmp_path)).collect())
    assert got == _sql_rows(tmp_path, "points_in_polygons")
