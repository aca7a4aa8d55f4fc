"""Rings and paths as arrays of (x, y), in expressions of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bound

POINTS = "array<struct<x:double,y:double>>"


def edges(ring: Column) -> Column:
    """Consecutive points of a ring, the last with the first."""
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(p.alias("a"), F.get(ring, (i + 1) % n).alias("b")))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test: whether a ray from the point crosses the ring an odd number of times.

    A ring of decimals keeps its differences and their product exact up to the division, as SQL does with decimal places.
    """

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < ((b["x"] - a["x"]) * (y - a["y"])).cast("double") / F.nullif((b["y"] - a["y"]).cast("double"), F.lit(0.0)) + a["x"].cast("double"))

    return F.aggregate(edges(ring), F.lit(False), lambda s, e: s != F.coalesce(crosses(e), F.lit(False)))


def in_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd over several rings, so that inner ones are holes."""
    return F.aggregate(rings, F.lit(False), lambda s, r: s != in_ring(x, y, r))


def box(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("w"), F.array_min(ys).alias("s"), F.array_max(xs).alias("e"), F.array_max(ys).alias("n"))


def boxes_touch(a: Column, b: Column) -> Column:
    return (a["w"] <= b["e"]) & (a["e"] >= b["w"]) & (a["s"] <= b["n"]) & (a["n"] >= b["s"])


def vertex_mean(ring: Column) -> Column:
    total = lambda f: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[f]) / F.size(ring)
    return F.struct(total("x").alias("x"), total("y").alias("y"))


def area_km2(ring: Column, lat: Column) -> Column:
    """Shoelace area on a local plane at latitude ``lat``."""
    twice = F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return F.abs(twice) / 2 * 111.32 * 111.32 * F.cos(F.radians(lat))


def polygon_km2(rings: Column) -> Column:
    """The area of an outline less its holes, each on a plane at the outline's middle latitude; 0 without an outline."""
    outline = F.get(rings, F.lit(0))
    lat = vertex_mean(outline)["y"]
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return F.coalesce(area_km2(outline, lat) - F.aggregate(holes, F.lit(0.0), lambda s, r: s + area_km2(r, lat)), F.lit(0.0))


def _between(a: Column, b: Column, t: Column) -> Column:
    return F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["y"] + t * (b["y"] - a["y"])).alias("y"))


def _half(ring: Column, axis: str, limit: Column, sign: int) -> Column:
    """The part of a ring on one side of a line across an axis."""
    inside = lambda p: (p[axis] - limit) * sign >= 0

    def at(b: Column, i: Column) -> Column:
        a = F.get(ring, F.when(i == 0, F.size(ring)).otherwise(i) - 1)
        crossing = _between(a, b, (limit - a[axis]) / (b[axis] - a[axis]))
        crossing = F.struct(*((limit if c == axis else crossing[c]).alias(c) for c in ("x", "y")))
        own = F.struct(b["x"].alias("x"), b["y"].alias("y"))
        none = F.array().cast(POINTS)
        return F.when(inside(a) != inside(b), F.when(inside(b), F.array(crossing, own)).otherwise(F.array(crossing))).when(inside(b), F.array(own)).otherwise(none)

    return F.flatten(F.transform(ring, at))


def _column(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def clip_to_box(ring: Column, w: Column | float, s: Column | float, e: Column | float, n: Column | float) -> Column:
    """The part of a ring inside a box, one side of the box after the other; empty if none is, null for a null ring."""

    def half(axis: str, limit: Column | float, sign: int):  # noqa: ANN202
        return lambda r: _half(r, axis, _column(limit), sign)

    for side in (half("x", w, 1), half("x", e, -1), half("y", s, 1), half("y", n, -1)):
        ring = bound(ring, side)
    return ring


def _part_inside(a: Column, b: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """Where a segment enters and leaves a box, as shares t0 <= t1 of its length; null if it doesn't touch it."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    sides = [(-dx, a["x"] - w), (dx, e - a["x"]), (-dy, a["y"] - s), (dy, n - a["y"])]
    enters = F.greatest(F.lit(0.0), *(F.when(p < 0, q / p) for p, q in sides))
    leaves = F.least(F.lit(1.0), *(F.when(p > 0, q / p) for p, q in sides))
    beside = sum(((p == 0) & (q < 0)).cast("int") for p, q in sides)
    return F.when((beside == 0) & (enters <= leaves), F.struct(enters.alias("t0"), leaves.alias("t1")))


def clip_line(path: Column, w: Column | float, s: Column | float, e: Column | float, n: Column | float) -> Column:
    """The parts of a path inside a box, each an array of two points or more; a path that leaves and returns has several."""
    sides = [_column(x) for x in (w, s, e, n)]
    lines, none = f"array<{POINTS}>", F.array().cast(POINTS)

    def closed(so_far: Column) -> Column:
        return F.when(F.size(so_far["open"]) > 1, F.concat(so_far["done"], F.array(so_far["open"]))).otherwise(so_far["done"])

    def step(so_far: Column, g: Column) -> Column:
        def kept(t: Column) -> Column:
            first, last = _between(g["a"], g["b"], t["t0"]), _between(g["a"], g["b"], t["t1"])
            goes_on = (t["t0"] == 0) & (F.size(so_far["open"]) > 0)
            done = F.when(t.isNull() | ~goes_on, closed(so_far)).otherwise(so_far["done"])
            now = F.when(t.isNull(), none).when(goes_on, F.concat(so_far["open"], F.array(last))).otherwise(F.array(first, last))
            return F.struct(done.alias("done"), now.alias("open"), (F.coalesce(t["t1"], F.lit(0.0)) < 1).alias("left"))

        def settled(x: Column) -> Column:
            return F.struct(F.when(x["left"], closed(x)).otherwise(x["done"]).alias("done"), F.when(x["left"], none).otherwise(x["open"]).alias("open"))

        return bound(bound(_part_inside(g["a"], g["b"], *sides), kept), settled)

    def over(p: Column) -> Column:
        point = lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))
        segments = F.transform(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda a, i: F.struct(point(a).alias("a"), point(F.get(p, i + 1)).alias("b")))
        return F.aggregate(segments, F.struct(F.array().cast(lines).alias("done"), none.alias("open")), step, closed)

    return bound(path, over)
