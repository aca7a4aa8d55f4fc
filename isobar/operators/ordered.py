"""Operators over an order: newest, ranges, islands, unions of intervals, portions, sliding sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .running import running


def first_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key. Give an order without ties; Spark cuts each task's rows to n before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def day_ranges(days: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Consecutive distinct days as (first_day, last_day, n_days)."""
    w = Window.partitionBy(*keys).orderBy(day)
    rows = days.select(*keys, day).distinct().withColumn("_g", F.date_sub(day, F.row_number().over(w)))
    return rows.groupBy(*keys, "_g").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("n_days")).drop("_g")


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Touching or overlapping intervals of a key as one."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.where(F.col(end) > F.col(start)).withColumn("_new", F.when(before >= F.col(start), 0).otherwise(1))
    islands = opened.withColumn("_i", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return islands.groupBy(*keys, "_i").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_i")


def gap_sessions(df: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """Rows whose distance to the row before stays within ``seconds``, as (session_start, session_end, n)."""
    w = Window.partitionBy(*keys).orderBy(ts)
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(w).cast("timestamp"))
    new = df.withColumn("_new", F.when(gap <= seconds * 1_000_000, 0).otherwise(1))
    rows = new.withColumn("_s", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy(*keys, "_s").agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("n")).drop("_s")


def capped_by_length(df: DataFrame, keys: list[str], order: list[str], length: Column, budget: int) -> DataFrame:
    """Rows in order as long as the sum of their lengths stays within a budget."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_sum", F.sum(length).over(w)).where(F.col("_sum") <= budget).drop("_sum")


def program_windows(events: DataFrame, keys: list[str]) -> DataFrame:
    """Stops and programs from advisories and cancellations, as (start, end, days, cancelled) per key.

    ``events``: t, cancel, p_start, p_end, day. An advisory that is sent before the open window's end, or whose period
    begins within 60 seconds of it, revises the window: the newest end wins, so a window can shrink. Without a period a
    window goes on within its day only. A cancellation ends it at the minute it was sent.

    An advisory that no window before can reach starts an island: the one after a cancellation, and one of a later day that
    neither is sent before the latest end so far nor begins within its minute. The window before is closed by then, whatever it
    was, so that islands are folded by themselves, in time order, and no task holds a large key's advisories.
    """
    minute = 60
    item = F.struct("t", F.col("cancel").cast("int").alias("cancel"), "p_start", "p_end", "day")
    kind = "struct<start:bigint,end:bigint,days:array<string>,cancelled:boolean>"
    none = F.lit(None).cast(kind)
    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), none.alias("cur"))
    null = F.lit(None).cast("bigint")

    def window(a: Column, b: Column, days: Column, cancelled: Column) -> Column:
        return F.struct(a.cast("bigint").alias("start"), b.cast("bigint").alias("end"), days.cast("array<string>").alias("days"), cancelled.alias("cancelled"))

    def step(s: Column, e: Column) -> Column:
        cur, has = s["cur"], s["cur"].isNotNull()
        period = e["p_start"].isNotNull() & e["p_end"].isNotNull()
        closed = F.when(has, F.array_append(s["done"], cur)).otherwise(s["done"])
        cut = has & (cur["end"].isNull() | (e["t"] < cur["end"]))
        ended = window(cur["start"], F.when(cur["start"].isNotNull(), F.greatest(cur["start"], e["t"])), cur["days"], F.lit(True))
        on_cancel = F.when(cut, F.array_append(s["done"], ended)).otherwise(closed)
        goes_on = F.coalesce(has & F.when(cur["end"].isNull(), F.element_at(cur["days"], -1) == e["day"]).otherwise((e["t"] <= cur["end"]) | (period & (e["p_start"] <= cur["end"] + minute))), F.lit(False))
        days = F.when(F.array_contains(cur["days"], e["day"]), cur["days"]).otherwise(F.array_append(cur["days"], e["day"]))
        timed = period & cur["start"].isNotNull()
        revised = window(F.when(timed, F.least(cur["start"], e["p_start"])), F.when(timed, e["p_end"]), days, F.lit(False))
        opened = window(F.when(period, e["p_start"]).otherwise(null), F.when(period, e["p_end"]).otherwise(null), F.array(e["day"]), F.lit(False))
        plain = F.struct(F.when(goes_on, s["done"]).otherwise(closed).alias("done"), F.when(goes_on, revised).otherwise(opened).alias("cur"))
        return F.when(e["cancel"] == 1, F.struct(on_cancel.alias("done"), none.alias("cur"))).otherwise(plain)

    sent = events.where("t is not null").withColumn("_item", item)
    latest = F.when(F.col("p_start").isNotNull(), F.col("p_end"))
    seen = running(sent, keys, [F.col("_item")], maxima={"_end": latest, "_day": F.col("day"), "_last": F.col("_item")}, current=False)
    reached = (F.col("t") <= F.col("_end")) | (F.col("p_start") <= F.col("_end") + minute)
    first = F.col("_last").isNull() | (F.col("_last.cancel") == 1) | ((F.col("day") > F.col("_day")) & ~F.coalesce(reached, F.lit(False)))
    parts = running(seen, keys, [F.col("_item")], maxima={"_island": F.when(first & (F.col("_item.cancel") == 0), F.col("_item"))})
    rows = parts.groupBy(*keys, "_island").agg(F.array_sort(F.collect_list("_item")).alias("e"))
    last = rows.select(*keys, F.aggregate("e", start, step, lambda s: F.when(s["cur"].isNotNull(), F.array_append(s["done"], s["cur"])).otherwise(s["done"])).alias("w"))
    return last.select(*keys, F.explode("w").alias("w")).select(*keys, "w.*")
