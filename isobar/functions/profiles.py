"""Vertical profiles as arrays of values at ascending levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def crossings(levels: Column, values: Column, core: Column, least: Column | float) -> Column:
    """Where a profile falls under ``least`` on both sides of its core, as (below, above, depth) in the levels' unit.

    One pass over the pairs of neighbouring levels that have values (missing ones are bridged): below the core the last pair
    that rises to ``least`` counts, above it the first that falls under it; each crossing is linear between its levels. A side
    on which the profile doesn't get there is null, and so is then the depth.
    """
    limit = least if isinstance(least, Column) else F.lit(float(least))
    points = F.filter(F.arrays_zip(levels.alias("z"), values.alias("v")), lambda p: p["z"].isNotNull() & p["v"].isNotNull() & ~F.isnan(p["v"]))
    none = F.lit(None).cast("double")
    start = F.struct(none.alias("z"), none.alias("v"), none.alias("below"), none.alias("above"))

    def step(s: Column, p: Column) -> Column:
        z, v = p["z"].cast("double"), p["v"].cast("double")
        at = s["z"] + (limit - s["v"]) / (v - s["v"]) * (z - s["z"])
        rises = (z <= core) & (s["v"] < limit) & (v >= limit)
        falls = s["above"].isNull() & (s["z"] >= core) & (s["v"] >= limit) & (v < limit)
        return F.struct(z.alias("z"), v.alias("v"), F.when(rises, at).otherwise(s["below"]).alias("below"), F.when(falls, at).otherwise(s["above"]).alias("above"))

    return F.aggregate(points, start, step, lambda s: F.struct(s["below"].alias("below"), s["above"].alias("above"), (s["above"] - s["below"]).alias("depth")))
