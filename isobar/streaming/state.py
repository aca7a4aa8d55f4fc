"""Incremental versions: what is new is folded into a keyed table, and the result equals a full recompute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregates import hours_per_cell

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def lit_hours(events: DataFrame) -> DataFrame:
    """(date, hour, cell) that an error lights, once each."""
    cell = F.pmod(F.col("user_id"), F.lit(10)) * 12 + F.least(F.floor(F.col("value") / 50), F.lit(11))
    lit = events.where("event_type = 'error'").select(F.to_date("ts").alias("date"), F.hour("ts").alias("hour"), cell.cast("long").alias("cell"))
    return lit.distinct()


def folded(state: DataFrame | None, new: DataFrame) -> DataFrame:
    """The state with new rows: a set, so that frames that come twice or late change nothing already counted."""
    return new.distinct() if state is None else state.unionByName(new).distinct()


def keep_hours(spark: SparkSession, source: str, state_path: str, checkpoint: str) -> StreamingQuery:
    """Reads new event files once each and keeps one state folder per batch; :func:`hours` gives the counts.

    A batch writes its own folder, overwritten when the batch is repeated after a failure: no row is counted twice and no
    earlier state is rewritten.
    """

    def fold(batch: DataFrame, number: int) -> None:
        lit_hours(batch).write.mode("overwrite").parquet(f"{state_path}/batch={number}")

    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 16).parquet(source)
    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hours(spark: SparkSession, state_path: str) -> DataFrame:
    """Hours per cell and day from the state of all batches."""
    return hours_per_cell(spark.read.schema("date date, hour int, cell long").parquet(state_path), ["cell"])


def counts_by_window(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "30 minutes") -> DataFrame:
    """(start, event_type, n) by tumbling or sliding windows; events later than the watermark no longer change a window."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    window = F.window("at", size, slide) if slide else F.window("at", size)
    return timed.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """(user_id, start, end, n) by gaps; only where windows never shrink."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.session_window("at", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def without_repeats(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events whose payload didn't come before within the watermark; state is bounded by it."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withColumn("hash", F.sha1("props")).withWatermark("at", late)
    return timed.dropDuplicatesWithinWatermark(["hash", "user_id"])


def given_up(attempts: DataFrame, most: int = 3) -> DataFrame:
    """(key, misses, state) of a log of attempts (key, at, ok): read, open, or given up after ``most`` misses in a row."""
    last_ok = F.max(F.when(F.col("ok"), F.col("at")))
    rows = attempts.join(attempts.groupBy("key").agg(last_ok.alias("_ok")), "key")
    g = rows.groupBy("key").agg(F.max("_ok").alias("_ok"), F.count_if(~F.col("ok") & (F.col("_ok").isNull() | (F.col("at") > F.col("_ok")))).alias("misses"))
    state = F.when(F.col("_ok").isNotNull(), "read").when(F.col("misses") >= most, "given up").otherwise("open")
    return g.select("key", "misses", state.alias("state"))


def run_to_end(df: DataFrame, name: str, mode: str = "append", each: Callable[[StreamingQuery], None] | None = None) -> DataFrame:
    """Runs a streaming plan over what is there and gives its rows from memory: for tests and small reports only."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    if each:
        each(q)
    return df.sparkSession.table(name)
