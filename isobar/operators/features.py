"""Lines with attributes on a map that wraps round: unwrapping, copies one turn east and west, clipping to a box.

A line is its vertices' rows (keys, an order, x, y and what each vertex carries), so that its length is bounded by nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Box = tuple[float, float, float, float]


def unwrapped(vertices: DataFrame, keys: list[str], order: str, x: str = "x") -> DataFrame:
    """``vertices`` whose x goes on beyond 180 degrees: a step of more than half a turn counts as one the other way round.

    The turns up to a vertex are a running sum over its line. A step of exactly half a turn stays as it is.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    d = F.col(x) - F.lag(x).over(w)
    turn = F.when(d > 180, -1).when(d < -180, 1).otherwise(0)
    return vertices.withColumn("_turn", turn).withColumn(x, F.col(x) + 360 * F.sum("_turn").over(w)).drop("_turn")


def _inside(a: dict[str, Column], b: dict[str, Column], box: Box) -> tuple[Column, Column]:
    """Shares of a segment's length at which it enters and leaves a box; entering after leaving if it doesn't touch it."""
    w, s, e, n = (F.lit(float(v)) for v in box)
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    sides = [(-dx, a["x"] - w), (dx, e - a["x"]), (-dy, a["y"] - s), (dy, n - a["y"])]
    # A segment that runs beside a side enters behind its end, so that it has no part inside.
    enters = F.greatest(F.lit(0.0), *(F.when(p < 0, q / p).when((p == 0) & (q < 0), 2.0) for p, q in sides))
    leaves = F.least(F.lit(1.0), *(F.when(p > 0, q / p) for p, q in sides))
    return enters, leaves


def clipped_parts(vertices: DataFrame, keys: list[str], order: str, box: Box, carried: list[str], *, x: str = "x", y: str = "y") -> DataFrame:
    """(keys, copy, part, points) of every part of a line inside ``box``, for the line itself and one turn west and east.

    ``points`` is an array of (x, y, carried...), what a vertex carries interpolated along each edge to where the edge enters
    and leaves. A line that leaves and returns has several parts, numbered from 1 in its order; a touch in a single point is a
    part of no length and is left out. Edges are rows: a line is unwrapped before (:func:`unwrapped`), and edges
    that touch no copy of the box go before anything is put together. Vertices without a place are left out.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    there = vertices.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    names = [x, y, *carried]
    edges = there.select(*keys, order, F.row_number().over(w).alias("_n"), *(F.col(c).cast("double").alias(f"_a_{c}") for c in names), *(F.lead(c).over(w).cast("double").alias(f"_b_{c}") for c in names)).where(F.col(f"_b_{x}").isNotNull())
    copies = edges.withColumn("copy", F.explode(F.array(F.lit(-360), F.lit(0), F.lit(360))))
    end = lambda k: {"x": F.col(f"_{k}_{x}") + F.col("copy"), "y": F.col(f"_{k}_{y}")}
    a, b = end("a"), end("b")
    near = (F.greatest(a["x"], b["x"]) >= box[0]) & (F.least(a["x"], b["x"]) <= box[2]) & (F.greatest(a["y"], b["y"]) >= box[1]) & (F.least(a["y"], b["y"]) <= box[3])
    enters, leaves = _inside(a, b, box)
    cut = copies.where(near).withColumn("_t0", enters).withColumn("_t1", leaves).where("_t0 < _t1")

    def at(t: str) -> Column:
        along = lambda c: F.col(f"_a_{c}") + F.col(t) * (F.col(f"_b_{c}") - F.col(f"_a_{c}"))
        return F.struct((along(x) + F.col("copy")).alias(x), *(along(c).alias(c) for c in (y, *carried)))

    own = Window.partitionBy(*keys, "copy").orderBy(order)
    # An edge goes on where it starts inside and the edge before it, the line's own, ended inside.
    goes_on = (F.col("_t0") == 0) & (F.lag("_t1").over(own) == 1) & (F.lag("_n").over(own) == F.col("_n") - 1)
    parts = cut.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("part", F.sum("_new").over(own).cast("int"))
    lines = parts.groupBy(*keys, "copy", "part").agg(F.sort_array(F.collect_list(F.struct(F.col("_n"), at("_t0").alias("p"), at("_t1").alias("q")))).alias("e"))
    points = F.concat(F.array(F.get("e", F.lit(0))["p"]), F.transform("e", lambda s: s["q"]))
    return lines.select(*keys, "copy", "part", points.alias("points"))
