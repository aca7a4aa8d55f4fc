"""Aggregations: hours per cell, hotspots, first-seen modes, k-th highest values, shares over members."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.steps import step
from .ordered import first_per
from .running import running


def hours_per_cell(frames: DataFrame, keys: list[str]) -> DataFrame:
    """(date, keys, hours): distinct hours in which a cell was lit, however many frames an hour has."""
    return frames.select("date", *keys, "hour").distinct().groupBy("date", *keys).agg(F.count("*").alias("hours"))


def day_stats(hours: DataFrame, cell: str) -> DataFrame:
    """Per day: the most hours, the lit cells and the peak cell (the first one on ties)."""
    peak = F.max(F.struct(F.col("hours").alias("h"), (-F.col(cell)).alias("c")))
    return hours.groupBy("date").agg(F.max("hours").alias("max_hours"), F.count("*").alias("cells"), (-peak["c"]).alias("peak_cell"))


def hotspots(hours: DataFrame, area: str, k: int = 6) -> DataFrame:
    """The areas of most cell-hours (by name on ties), each with its peak day (the earliest on ties)."""
    by_day = hours.groupBy(area, "date").agg(F.sum("hours").alias("h"))
    peak = F.max(F.struct(F.col("h"), (-F.datediff("date", F.lit("1970-01-01").cast("date"))).alias("d"), F.col("date")))
    total = by_day.groupBy(area).agg(F.sum("h").alias("cell_hours"), peak.alias("_p"))
    return total.orderBy(F.desc("cell_hours"), area).limit(k).select(area, "cell_hours", F.col("_p.date").alias("peak_date"), F.col("_p.h").alias("peak_cell_hours"))


def first_seen_mode(df: DataFrame, keys: list[str], value: str, seen: str) -> DataFrame:
    """The most frequent value of each key; on ties the one seen first."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(seen).alias("_seen"))
    return first_per(n, keys, [F.desc("n"), F.col("_seen"), F.col(value)]).drop("_seen")


def kth_highest(values: Column, k: int) -> Column:
    """The k-th highest of an aggregate's values; null with fewer. For groups of bounded size: their values are held in one array."""
    return F.get(F.sort_array(F.collect_list(values), asc=False), F.lit(k - 1))


def at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(keys, n, one column per rank): the exact values at places of each key's sorted values, nulls left out.

    ``ranks`` gives each place (from 0) as a function of the key's number of values. Equal values count once with their
    number; running counts say which value holds a place, over sampled ranges of a large key's values, so that no task holds or sorts all
    its values. A null key is a key; one without values isn't there. A place beyond the values is null.
    """
    some = df.where(F.col(value).isNotNull())
    counted = some.groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    run = step(running(counted, keys, [F.col("_v")], sums={"_to": F.col("_c")}), "running-counts")
    sizes = run.groupBy(*keys).agg(F.max("_to").alias("n"))
    places = F.array(*(F.struct(F.lit(name).alias("name"), at(F.col("n")).cast("long").alias("at")) for name, at in ranks.items()))
    asked = sizes.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.explode(places).alias("_w"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    held = run.join(asked, same & (F.col("_w.at") >= F.col("_to") - F.col("_c")) & (F.col("_w.at") < F.col("_to")))
    found = held.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(*(F.max(F.when(F.col("_w.name") == name, F.col("_v"))).alias(name) for name in ranks))
    return sizes.join(found, same, "left").select(*keys, "n", *ranks)


def ranked_value(values: Column, position: Column) -> Column:
    """The value at a position (from 0) of a sorted array."""
    return F.get(F.sort_array(values), position.cast("int"))


def member_share(flags: DataFrame, keys: list[str], flag: str, member: str, least: int) -> DataFrame:
    """Rounded percentage of members with the flag among those with data; keys with under ``least`` members go."""
    agg = flags.groupBy(*keys).agg(F.sum(F.col(flag).cast("int")).alias("hits"), F.count(flag).alias("seen"), F.count_distinct(member).alias("members"))
    return agg.where(F.col("members") >= least).withColumn("share", F.floor(100.0 * F.col("hits") / F.col("seen") + 0.5).cast("long"))
