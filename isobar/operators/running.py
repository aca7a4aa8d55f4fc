"""Running sums and maxima over whole tables or by keys of any size, without a task that holds a large key's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.steps import step


#: Rows of a key up to which one window takes them; larger keys are cut into ranges.
MANY = 100_000


def running(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None, *, current: bool = True) -> DataFrame:
    """``rows`` with the sum or maximum of a value over the rows of its key up to each row in ``order``, with or without itself.

    No keys: over all rows. Keys of up to MANY rows go through one shuffle by key; the rows of larger keys, or of all rows where
    there are no keys, are cut into ranges. Without rows before, a sum is 0 and a maximum null. Null keys are one key.
    ``order`` tells the rows of a key apart, else the order among equal ones is arbitrary.
    """
    kinds = {n: (F.sum, c) for n, c in (sums or {}).items()} | {n: (F.max, c) for n, c in (maxima or {}).items()}
    if not keys:
        return _over_ranges(rows, keys, order, kinds, current)
    held = step(rows, "running")
    large = step(held.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > MANY).select(*(F.col(k).alias(f"_k_{k}") for k in keys)), "large-keys")
    if large.isEmpty():
        return _by_key(held, keys, order, kinds, current)
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    split = lambda how: held.join(F.broadcast(large), same, how)
    return _by_key(split("left_anti"), keys, order, kinds, current).unionByName(_over_ranges(split("left_semi"), keys, order, kinds, current))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _by_key(rows: DataFrame, keys: list[str], order: list[Column], kinds: dict, current: bool) -> DataFrame:
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)
    return rows.select("*", *((_zero(agg(c).over(upto)) if agg is F.sum else agg(c).over(upto)).alias(n) for n, (agg, c) in kinds.items()))


def _over_ranges(rows: DataFrame, keys: list[str], order: list[Column], kinds: dict, current: bool) -> DataFrame:
    """Spark cuts the rows into ranges by sampling, whatever the keys' sizes, and a range is worked on by itself after what
    earlier ranges hold of its key. Only the key that a range begins with can have rows before it, so that what is handed over
    is one row for each range.
    """
    ranged = step(rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    by_part = ranged.groupBy("_part", *keys).agg(*(agg(c).alias(f"_e_{n}") for n, (agg, c) in kinds.items()), F.lit(1).alias("_one"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    handed = by_part.select(F.col("_part").alias("_p"), *(F.col(k).alias(f"_k_{k}") for k in keys), *(agg(f"_e_{n}").over(before).alias(f"_e_{n}") for n, (agg, _) in kinds.items()), F.count("_one").over(before).alias("_parts")).where("_parts > 0")
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    upto = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow if current else -1)
    inside = ranged.select("*", *(agg(c).over(upto).alias(f"_i_{n}") for n, (agg, c) in kinds.items()))
    both = inside.join(F.broadcast(handed), same, "left")
    made = [(_zero(F.col(f"_i_{n}")) + _zero(F.col(f"_e_{n}")) if agg is F.sum else F.greatest(f"_i_{n}", f"_e_{n}")).alias(n) for n, (agg, _) in kinds.items()]
    return both.select(*rows.columns, *made)
