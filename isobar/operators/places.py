"""Points and polygons that meet in squares, in blocks of bounded size: pairs are tested by NumPy inside tasks and never become rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geometry as Geo
from ..sources.steps import step

KM_PER_DEGREE = 111.32
#: Points and polygons of a block; pairs of a point and an edge that are worked on at a time.
POINTS, POLYGONS, PAIRS = 4096, 2048, 400_000
#: Polygons of a block where all pairs that hold are given.
HELD = 512
#: Blocks of a task, as work grows with them and not with bytes, and tasks at most.
BLOCKS, TASKS = 12, 2000


def edge_list(rings: Column) -> Column:
    """Every edge as (ring, ax, ay, by, dx, dy) in doubles; of rings in decimals the differences are exact before they are rounded."""
    d = lambda c: c.cast("double")
    one = lambda e, k: F.struct(k.alias("ring"), d(e["a"]["x"]).alias("ax"), d(e["a"]["y"]).alias("ay"), d(e["b"]["y"]).alias("by"), d(e["b"]["x"] - e["a"]["x"]).alias("dx"), d(e["b"]["y"] - e["a"]["y"]).alias("dy"))
    return F.flatten(F.transform(rings, lambda r, k: F.transform(Geo.edges(r), lambda e: one(e, k))))


def meet(points: DataFrame, polygons: DataFrame, cell: float, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str | StructType, *, polygons_at_once: int | None = None) -> DataFrame:
    """``work`` on each block of points (x, y, others) and block of polygons (edges, _o, others) that meet in a square of ``cell`` degrees.

    A polygon is listed for the squares that its box ``_o`` (w, s, e, n) touches and that hold points. Squares with many rows are dealt in
    blocks: a point is in one block, a polygon in one of its own for each block of points, so that no task's group grows with the tables.
    """
    square = lambda v: F.floor(v / cell).cast("long")
    spans = lambda lo, hi: F.explode(F.sequence(square(F.col(f"_o.{lo}")), square(F.col(f"_o.{hi}"))))
    placed = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("_i", square(F.col("x"))).withColumn("_j", square(F.col("y")))
    listed = polygons.withColumn("_i", spans("w", "e")).withColumn("_j", spans("s", "n")).drop("_o")
    blocks = lambda rows, size, name: rows.groupBy("_i", "_j").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    # One row for each square of a map of degrees, whatever the tables hold.
    sizes = step(blocks(placed, POINTS, "_np").join(blocks(listed.select("_i", "_j"), polygons_at_once or POLYGONS, "_nq"), ["_i", "_j"]).coalesce(1), "squares")
    n = min(max(sizes.agg(F.coalesce(F.sum(F.col("_np") * F.col("_nq")), F.lit(0))).first()[0] // BLOCKS, 1), TASKS)
    sizes = F.broadcast(sizes)
    deal = lambda rows, n: F.pmod(F.xxhash64(*rows.columns), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(sizes, ["_i", "_j"]).withColumn("_p", deal(placed, "_np")).withColumn("_q", every("_nq")).drop("_np", "_nq")
    right = listed.join(sizes, ["_i", "_j"]).withColumn("_q", deal(listed, "_nq")).withColumn("_p", every("_np")).drop("_np", "_nq")
    by = ["_i", "_j", "_p", "_q"]
    return left.repartition(n, *by).groupBy(*by).cogroup(right.repartition(n, *by).groupBy(*by)).applyInArrow(work, schema)


class Edges:
    """The edges of a block's polygons side by side, with where each ring and each polygon begins."""

    def __init__(self, polygons: pa.Table) -> None:
        lists = polygons["edges"].combine_chunks()
        flat = lists.flatten()
        self.ax, self.ay, self.by, self.dx, self.dy = (np.asarray(flat.field(c)) for c in ("ax", "ay", "by", "dx", "dy"))
        size = np.asarray(lists.value_lengths())
        self.first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        ring = np.asarray(flat.field("ring"))
        begins = np.ones(len(ring), bool)
        begins[1:] = ring[1:] != ring[:-1]
        begins[self.first] = True
        self.rings = np.flatnonzero(begins)
        self.hole = ring[self.rings] > 0
        self.first_ring = np.searchsorted(self.rings, self.first)
        self.steep = np.where(self.dy == 0, 1.0, self.dy)

    def inside(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each polygon (columns) holds each point (rows): within its outline, in none of its holes."""
        x, y = x[:, None], y[:, None]
        crosses = ((self.ay > y) != (self.by > y)) & (x < self.dx * (y - self.ay) / self.steep + self.ax)
        held = np.bitwise_xor.reduceat(crosses.view(np.int8), self.rings, axis=1).view(bool)
        return np.logical_and.reduceat(held != self.hole, self.first_ring, axis=1)

    def km(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Kilometres from each point to the nearest edge of each polygon, on a plane with the point's own scale of longitude."""
        x, y = x[:, None], y[:, None]
        k = np.cos(np.radians(y))
        ax, ay, dx = (self.ax - x) * k, self.ay - y, self.dx * k
        square = dx * dx + self.dy * self.dy
        t = np.clip(-(ax * dx + ay * self.dy) / np.where(square == 0, 1.0, square), 0.0, 1.0)
        ax += t * dx
        ay += t * self.dy
        return np.sqrt(np.minimum.reduceat(ax * ax + ay * ay, self.first, axis=1)) * KM_PER_DEGREE


def _some(n: int, edges: int) -> int:
    return max(1, min(n, PAIRS // max(1, edges)))


def held_pairs(points: pa.Table, polygons: pa.Table) -> tuple[pa.Array, pa.Array]:
    """The rows of a block's points (x, y) and polygons (edges) that belong together, side by side."""
    at, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if points.num_rows and polygons.num_rows:
        edges, x, y = Edges(polygons), np.asarray(points["x"]), np.asarray(points["y"])
        some = _some(len(x), len(edges.ax))
        for k in range(0, len(x), some):
            p, q = np.divmod(np.flatnonzero(edges.inside(x[k : k + some], y[k : k + some])), polygons.num_rows)
            at.append(p + k)
            of.append(q)
    return pa.array(np.concatenate(at)), pa.array(np.concatenate(of))


def usable(polygons: DataFrame, rings: str) -> DataFrame:
    return polygons.where((F.size(rings) > 0) & (F.size(F.get(rings, F.lit(0))) > 0))


def strongest_near(points: DataFrame, polygons: DataFrame, km: float, key: str, name: str, strength: str, *, rings: str = "rings", cell: float = 5.0, digits: int = 3) -> DataFrame:
    """For each point (key, x, y) near polygons (name, rings, strength): (key, n, name, strength, distance).

    ``n`` polygons hold the point or pass within ``km``; of the strongest of them the nearest is named, on equal distances (rounded to
    ``digits``) that of the smallest name. Polygons of equal rings and strength are tested once. Null strengths come last.
    """
    up = km / KM_PER_DEGREE
    one = usable(polygons, rings).groupBy(rings, strength).agg(F.count("*").alias("_n"), F.min(name).alias("_name"))
    o = Geo.box(F.get(rings, F.lit(0)))
    out = F.lit(up) / F.cos(F.radians(F.least(F.greatest(F.abs(o["s"]), F.abs(o["n"])) + up, F.lit(89.0))))
    wide = F.struct((o["w"] - out).alias("w"), (o["s"] - up).alias("s"), (o["e"] + out).alias("e"), (o["n"] + up).alias("n"))
    shapes = one.withColumn("_o", wide).withColumn("edges", edge_list(F.col(rings))).select("_n", "_name", F.col(strength).cast("double").alias("_s"), "edges", "_o")
    scale = 10.0**digits

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("key", left.schema.field("key").type), ("n", pa.int64()), ("s", pa.float64()), ("distance", pa.float64()), ("name", right.schema.field("_name").type))})
        right = right.sort_by("_name")
        edges, each = Edges(right), np.asarray(right["_n"])
        s = np.asarray(right["_s"].combine_chunks().fill_null(-np.inf))
        x, y = np.asarray(left["x"]), np.asarray(left["y"])
        at, n, best, near = [], [], [], []
        some = _some(len(x), len(edges.ax))
        for k in range(0, len(x), some):
            px, py = x[k : k + some], y[k : k + some]
            d = edges.km(px, py)
            d[edges.inside(px, py)] = 0.0
            close = d <= km
            hit = np.flatnonzero(close.any(axis=1))
            d, close = d[hit], close[hit]
            worth = np.where(close, s, -np.inf)
            d = np.where(close & (worth == worth.max(axis=1, keepdims=True)), np.floor(d * scale + 0.5) / scale, np.inf)
            q = d.argmin(axis=1)
            at.append(hit + k)
            n.append(close @ each)
            best.append(q)
            near.append(d[np.arange(len(q)), q])
        at, q = np.concatenate(at), np.concatenate(best)
        return pa.table({"key": left["key"].take(pa.array(at)), "n": pa.array(np.concatenate(n), pa.int64()), "s": s[q], "distance": np.concatenate(near), "name": right["_name"].take(pa.array(q))})

    kinds = {f.name: f.dataType.simpleString() for f in [*points.schema, *polygons.schema]}
    found = meet(points.select(F.col(key).alias("key"), "x", "y"), shapes, cell, work, f"key {kinds[key]}, n long, s double, distance double, name {kinds[name]}")
    first = F.min(F.struct((-F.col("s")).alias("s"), "distance", "name"))
    best = found.groupBy("key").agg(F.sum("n").alias("n"), first.alias("f"))
    value = F.when(F.col("f.s") < float("inf"), -F.col("f.s")).cast(kinds[strength])
    return best.select(F.col("key").alias(key), "n", F.col("f.name").alias(name), value.alias(strength), F.col("f.distance").alias("distance"))


def held_by_any(points: DataFrame, polygons: DataFrame, key: str, group: str, *, rings: str = "rings", cell: float = 5.0, at_once: int = 64) -> DataFrame:
    """(group, key) of every point (key, x, y) that some polygon (group, rings) of a group holds, once for each of the two.

    Equal rings of a group are tested once, and a point that is held is tested no further.
    """
    one = usable(polygons, rings).select(F.col(group).alias("group"), F.col(rings).alias("_r")).distinct()
    shapes = one.select("group", edge_list(F.col("_r")).alias("edges"), Geo.box(F.get("_r", F.lit(0))).alias("_o"))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        x, y = np.asarray(left["x"]), np.asarray(left["y"])
        groups, at = [], []
        right = right.sort_by("group")
        g = right["group"].combine_chunks()
        names = g.dictionary_encode()
        code = np.asarray(names.indices.fill_null(-1))
        ends = np.flatnonzero(np.diff(code)) + 1
        for a, b in zip([0, *ends], [*ends, len(code)], strict=True):
            left_over = np.arange(len(x))
            for p in range(a, b, at_once):
                edges = Edges(right.slice(p, min(at_once, b - p)))
                some = _some(len(x), len(edges.ax))
                parts = [edges.inside(x[i], y[i]).any(axis=1) for i in (left_over[k : k + some] for k in range(0, len(left_over), some))]
                held = np.concatenate(parts) if parts else np.zeros(0, bool)
                at.append(left_over[held])
                groups.append(np.full(held.sum(), a))
                left_over = left_over[~held]
        at, of = np.concatenate([[], *at]).astype(np.int64), np.concatenate([[], *groups]).astype(np.int64)
        return pa.table({"group": g.take(pa.array(of)), "key": left["key"].take(pa.array(at))})

    kinds = {f.name: f.dataType.simpleString() for f in [*points.schema, *polygons.schema]}
    found = meet(points.select(F.col(key).alias("key"), "x", "y"), shapes, cell, work, f"group {kinds[group]}, key {kinds[key]}")
    return found.distinct().select(F.col("group").alias(group), F.col("key").alias(key))
