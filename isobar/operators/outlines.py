"""Rings of a group simplified together, so that the group's points stay within one budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.simplification import above, rounded_ring, significance
from ..sources.steps import step

#: The first tolerance in degrees, which doubles, and the number of tolerances tried.
FIRST, STEPS = 0.05, 8


def cleaned(ring: Column) -> Column:
    """A ring's points with finite coordinates, without the first point again at its end."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    points = F.filter(ring, lambda p: p.isNotNull() & finite(p["x"]) & finite(p["y"]))
    again = lambda a: (F.size(a) > 1) & (F.get(a, F.size(a) - 1) == F.get(a, F.lit(0)))
    return F.get(F.transform(F.array(points), lambda a: F.slice(a, F.lit(1), F.size(a) - F.when(again(a), 1).otherwise(0))), F.lit(0))


def within_budget(rings: DataFrame, group: list[str], ring: str, budget: int, *, first: float = FIRST, steps: int = STEPS) -> DataFrame:
    """``rings`` simplified, with ``tolerance``; those that collapse, are empty or null go. A group keeps at most ``budget`` points.

    The tolerance of a group is the first of ``first``, twice as much, ... at which its rings fit, counted after rounding to one
    decimal. If none of ``steps`` tolerances fits, the group keeps its most significant vertices over all rings: the tolerance is
    the significance of the first one that the budget has no place for, and a ring's three last points stay or go together.
    Significances are found once; the tolerances are compared by sums that each task makes for its own rings, and the rare
    groups beyond them by a ranking that Spark cuts to the budget in each task before the shuffle.
    """
    worth, others = "_worth", [c for c in rings.columns if c != ring]
    found = rings.withColumn(ring, cleaned(F.col(ring))).where(F.size(ring) >= 3)
    found = step(found.withColumn(worth, significance(F.col(ring), "line", closed=True)), "significance")
    tolerances = [first * 2**k for k in range(steps)]
    sizes = [F.sum(F.size(rounded_ring(above(F.col(ring), F.col(worth), t)))).alias(f"_n{k}") for k, t in enumerate(tolerances)]
    sums = found.groupBy(*group).agg(*sizes)
    fits = F.coalesce(*(F.when(F.col(f"_n{k}") <= budget, F.lit(t)) for k, t in enumerate(tolerances)))
    chosen = step(sums.select(*group, fits.alias("tolerance")), "tolerances")
    beyond = chosen.where("tolerance is null").select(*group)
    # The first two points of a ring go with its third: without it there is no ring. A triangle's is its height over its longer side.
    away = lambda i, c: F.get(ring, F.lit(i))[c] - F.get(ring, F.lit(0))[c]
    base = F.greatest(*(F.hypot(away(i, "x"), away(i, "y")) for i in (1, 2)))
    height = F.try_divide(F.abs(away(1, "x") * away(2, "y") - away(2, "x") * away(1, "y")), base)
    third = F.when(F.size(ring) == 3, F.coalesce(height, F.lit(0.0))).otherwise(F.element_at(F.sort_array(worth, asc=False), 3))
    vertices = found.join(beyond, group, "left_semi").select(*group, F.explode(F.transform(worth, lambda s: F.least(s, third))).alias("_s"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_s")))
    cut = vertices.withColumn("_r", place).where(F.col("_r") <= budget + 1).where(F.col("_r") == budget + 1).select(*group, F.col("_s").alias("_cut"))
    limits = chosen.join(cut, group, "left").select(*group, F.coalesce("tolerance", "_cut", F.lit(0.0)).alias("tolerance"))
    out = found.join(limits.join(beyond.withColumn("_beyond", F.lit(True)), group, "left"), group)
    gone = F.col("_beyond").isNotNull() & (third <= F.col("tolerance"))
    out = out.withColumn(ring, F.when(gone, F.slice(ring, 1, 0)).otherwise(above(F.col(ring), F.col(worth), F.col("tolerance"))))
    out = out.withColumn(ring, rounded_ring(F.col(ring))).where(F.size(ring) > 0)
    return out.select(*others, ring, "tolerance")
