"""Layers of polygons over one another: the strongest in each cell, sources that replace one another, points near areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as Geo
from . import polygons as P

KM_PER_DEGREE = 111.32


def days_by_source(rows: DataFrame, read: DataFrame, day: str, source: str, rank: str) -> DataFrame:
    """``rows`` of each day's best source only: a day that a better source was read for is taken from it, even if it has no rows.

    ``read`` lists (day, source, rank) of what was read, the lowest rank best; equal ranks go by the source's name.
    """
    best = read.groupBy(day).agg(F.min(F.struct(rank, source)).alias("_b")).select(day, F.col(f"_b.{source}").alias(source))
    return rows.join(best, [day, source], "left_semi")


def strongest_cells(polygons: DataFrame, day: str, strength: str, label: str, *, rings: str = "rings", **grid: float) -> DataFrame:
    """(day, j, i, strength, label): of the polygons over a cell's centre the greatest strength, on ties the smallest label."""
    cells = P.covered_cells(polygons, [day, strength, label], rings=rings, **grid)
    best = F.min(F.struct((-F.col(strength)).alias("s"), F.col(label)))
    return cells.groupBy(day, "j", "i").agg(best.alias("b")).select(day, "j", "i", (-F.col("b.s")).alias(strength), F.col(f"b.{label}").alias(label))


def _km_to_edge(x: Column, y: Column, e: Column) -> Column:
    """Distance from a point to a segment on a plane with the point's own scale of longitude."""
    k = F.cos(F.radians(y))
    ax, ay, bx, by = (e["a"]["x"] - x) * k, e["a"]["y"] - y, (e["b"]["x"] - x) * k, e["b"]["y"] - y
    dx, dy = bx - ax, by - ay
    t = F.least(F.greatest(F.coalesce(F.try_divide(-(ax * dx + ay * dy), dx * dx + dy * dy), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    return F.hypot(ax + t * dx, ay + t * dy) * KM_PER_DEGREE


def points_near(points: DataFrame, polygons: DataFrame, km: float, *, x: str = "x", y: str = "y", rings: str = "rings", cell: float = 1.0) -> DataFrame:
    """Every pair of a point and a polygon that holds it or whose rings pass within ``km``, with ``distance`` (0 inside).

    A polygon is listed for the squares of ``cell`` degrees that its box touches, widened by ``km`` at the latitude where a degree
    is narrowest, and meets the points there; the exact test follows. No pair of a point and a polygon elsewhere is made.
    """
    square = lambda v: F.floor(v / cell).cast("long")
    up = km / KM_PER_DEGREE
    boxed = polygons.where(F.size(rings) > 0).withColumn("_o", Geo.box(F.get(rings, F.lit(0))))
    highest = F.least(F.greatest(F.abs(F.col("_o.s")), F.abs(F.col("_o.n"))) + up, F.lit(89.0))
    out = F.lit(up) / F.cos(F.radians(highest))
    boxed = boxed.withColumn("_out", out)
    out = F.col("_out")
    listed = boxed.withColumn("_i", F.explode(F.sequence(square(F.col("_o.w") - out), square(F.col("_o.e") + out)))).withColumn("_j", F.explode(F.sequence(square(F.col("_o.s") - up), square(F.col("_o.n") + up))))
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("_i", square(F.col(x))).withColumn("_j", square(F.col(y)))
    near = F.array_min(F.transform(F.flatten(F.transform(rings, Geo.edges)), lambda e: _km_to_edge(F.col(x), F.col(y), e)))
    distance = F.when(P.inside(F.col(x), F.col(y), F.col(rings)), 0.0).otherwise(near)
    around = F.col(x).between(F.col("_o.w") - out, F.col("_o.e") + out) & F.col(y).between(F.col("_o.s") - up, F.col("_o.n") + up)
    # Exploded, so that a pair's distance is made once and not again by the filter.
    met = placed.join(listed, ["_i", "_j"]).where(around).withColumn("distance", F.explode(F.filter(F.array(distance), lambda d: d <= km)))
    return met.drop("_i", "_j", "_o", "_out")


def best_area(pairs: DataFrame, keys: list[str], strength: str, label: str) -> DataFrame:
    """For each point of ``pairs`` its strongest area: (keys, n, label, strength, distance); ties go to the nearer, then the smaller label."""
    order = Window.partitionBy(*keys).orderBy(F.desc(strength), "distance", label)
    n = F.count("*").over(Window.partitionBy(*keys))
    return pairs.withColumn("n", n).withColumn("_r", F.row_number().over(order)).where("_r = 1").select(*keys, "n", label, strength, "distance")
