"""Hours per day and pixel, counted from frames that come in any order, come again, are replaced or turn out to be stray.

A frame is an hour's lit pixels in a version. Of a frame the highest version counts; one stray row makes that version stray,
and it then takes back all that it gave. A batch is merged by the difference between what its frames should hold and what they
do hold: signed, sparse rows, so that the counters are sums and a batch costs as much as the frames that it touches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.steps import step

FRAME = ["day", "hour"]
#: Schemas of the state: heads of frames, signed rows of their pixels, and the sums of days that are final.
HEADS, DELTAS, FINAL = "day date, hour int, version long, stray boolean", "day date, hour int, pixel long, n int", "day date, pixel long, n long"
#: Batches after which the state is written anew as one base, without what its days no longer need.
REBASE = 16


@dataclass(frozen=True)
class State:
    """``heads`` and ``deltas`` of open days, all batches so far, and ``final`` counts of closed ones."""

    heads: DataFrame
    deltas: DataFrame
    final: DataFrame


def empty_state(spark: SparkSession) -> State:
    return State(*(spark.createDataFrame([], s) for s in (HEADS, DELTAS, FINAL)))


def _heads(rows: DataFrame) -> DataFrame:
    """The highest version of each frame, stray if one of its rows is."""
    top = rows.groupBy(*FRAME).agg(F.max(F.struct("version", "stray")).alias("top"))
    return top.select(*FRAME, "top.version", "top.stray")


def _held(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*FRAME, "pixel").agg(F.sum("n").alias("n")).where("n > 0").drop("n")


def difference(state: State, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heads, deltas) that ``batch`` (day, hour, version, stray, pixel) adds to ``state``.

    A frame of a version below the held one changes nothing; of the held version, its rows join those held; above it, they
    replace them. Rows of final days change nothing. Null pixels are frames without a lit pixel. The result doesn't depend on
    the order of batches, on how rows are dealt among them or on repeats.
    """
    closed = state.final.select("day").distinct()
    rows = batch.join(closed, "day", "left_anti").withColumn("stray", F.coalesce("stray", F.lit(False)))
    before = _heads(state.heads).withColumnRenamed("version", "held_version").withColumnRenamed("stray", "held_stray")
    touched = _heads(rows).join(before, FRAME, "left").where("held_version is null or version >= held_version")
    same = F.coalesce(F.col("version") == F.col("held_version"), F.lit(False))
    touched = touched.select(*FRAME, "version", (F.col("stray") | (same & F.coalesce("held_stray", F.lit(False)))).alias("stray"), same.alias("same"))
    touched = step(touched, "touched")
    held = _held(state.deltas.join(touched.select(*FRAME), FRAME, "left_semi"))
    given = rows.where("pixel is not null").join(touched.where("not stray"), [*FRAME, "version"], "left_semi").select(*FRAME, "pixel")
    kept = held.join(touched.where("same and not stray"), FRAME, "left_semi")
    target = given.unionByName(kept).distinct()
    signed = target.withColumn("n", F.lit(1)).unionByName(held.withColumn("n", F.lit(-1)))
    deltas = signed.groupBy(*FRAME, "pixel").agg(F.sum("n").cast("int").alias("n")).where("n <> 0")
    return touched.drop("same"), deltas


def closed_days(state: State, keep_days: int) -> State:
    """``state`` in which days that lie ``keep_days`` or more before the newest one are final: their sums stay, all else goes."""
    newest = state.heads.agg(F.max("day").alias("d")).first().d
    if newest is None:
        return state
    bound = F.date_sub(F.lit(newest), keep_days)
    heads, deltas = _heads(state.heads), _held(state.deltas).withColumn("n", F.lit(1))
    # A final day without a lit pixel stays known by one row of no pixel.
    days = heads.where(F.col("day") <= bound).select("day", F.lit(None).cast("long").alias("pixel"), F.lit(0).cast("long").alias("n")).distinct()
    sums = deltas.where(F.col("day") <= bound).groupBy("day", "pixel").agg(F.count("*").alias("n"))
    return State(heads.where(F.col("day") > bound), deltas.where(F.col("day") > bound), state.final.unionByName(days).unionByName(sums))


def counts(state: State) -> DataFrame:
    """(day, pixel, n): the hours for which each pixel is lit, of open and final days."""
    opened = state.deltas.groupBy("day", "pixel").agg(F.sum("n").cast("long").alias("n")).where("n > 0")
    return opened.unionByName(state.final.where("pixel is not null"))


def merged(state: State, batch: DataFrame, keep_days: int | None = None) -> State:
    """``state`` after ``batch``, as written tables; with ``keep_days`` rewritten without the days that became final."""
    heads, deltas = difference(state, batch)
    out = State(state.heads.unionByName(heads), state.deltas.unionByName(step(deltas, "deltas")), state.final)
    if keep_days is None:
        return out
    out = closed_days(out, keep_days)
    return State(step(out.heads, "heads"), step(out.deltas, "deltas"), step(out.final, "final"))


def state_before(spark: SparkSession, path: str, batch: int) -> State:
    """The state that the batches before ``batch`` left under ``path``: the newest base and what was written after it."""
    base = (batch - 1) // REBASE * REBASE if batch > 0 else 0
    read = lambda kind, schema, numbers: spark.read.schema(schema).parquet(*[f"{path}/{kind}/batch={k}" for k in numbers]) if numbers else spark.createDataFrame([], schema)
    since = list(range(base, batch))
    old = [base] if base else []
    both = lambda kind, schema: read(f"base-{kind}", schema, old).unionByName(read(kind, schema, since))
    return State(both("heads", HEADS), both("deltas", DELTAS), read("base-final", FINAL, old))


def keep_counters(frames: DataFrame, path: str, checkpoint: str, keep_days: int) -> StreamingQuery:
    """Merges a stream of frames into the state under ``path``; :func:`counters` reads the counts.

    A batch writes folders of its own number and reads those before: repeated after a failure it overwrites them with the same
    rows. Every REBASE batches the state is written as a base that holds open days and the sums of final ones only.
    """

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = state_before(spark, path, number)
        if number and number % REBASE == 0:
            state = closed_days(state, keep_days)
            for kind in ("heads", "deltas", "final"):
                getattr(state, kind).write.mode("overwrite").parquet(f"{path}/base-{kind}/batch={number}")
            state = State(*(spark.read.schema(s).parquet(f"{path}/base-{kind}/batch={number}") for kind, s in (("heads", HEADS), ("deltas", DELTAS), ("final", FINAL))))
        heads, deltas = difference(state, batch)
        heads.write.mode("overwrite").parquet(f"{path}/heads/batch={number}")
        deltas.write.mode("overwrite").parquet(f"{path}/deltas/batch={number}")

    return frames.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counters(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The counts after the first ``batches`` batches."""
    return counts(state_before(spark, path, batches))
