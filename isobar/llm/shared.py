"""Tables that a job writes for its own later steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, a new local one if Spark runs in one process (tests), else an error."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        given = tempfile.mkdtemp(prefix="isobar-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def written(df: DataFrame, name: str, rows_per_batch: int = 512) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, its lineage cut, safe from lost executors."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows: whole texts of any length then fit in a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``work`` on each group's rows, one group in memory at a time; the caller bounds the groups' size.

    Many tiny groups share Arrow batches, which is far cheaper than one Python call frame and batch for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        held_key = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                out = work(pa.concat_tables(held))
                if out is not None and out.num_rows:
                    yield from out.to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            columns = [table[k].to_pylist() for k in keys]
            at = 0
            rows = list(zip(*columns, strict=True))
            while at < len(rows):
                to = at
                while to < len(rows) and rows[to] == rows[at]:
                    to += 1
                if rows[at] != held_key:
                    yield from flush()
                    held, held_key = [], rows[at]
                held.append(table.slice(at, to - at))
                at = to
        yield from flush()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


#: Rows up to which a counted table is broadcast, and the copies of a larger one, among which a hot key's rows are dealt.
BROADCAST_ROWS, SALTS = 200_000, 16


def beside(rows: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """``rows`` joined with ``small`` (one row for each key): broadcast if a count finds few rows, else in salted parts.

    In the second case each row of ``small`` is there once for each salt, so that no key's rows all meet in one task.
    """
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), on, how)
    salt = free_name(rows, "salt")
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)), F.lit(SALTS)))
    copies = small.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(copies, [*on, salt], how).drop(salt)


def numbered(rows: DataFrame, order: list[Column], name: str, upto: int | None = None) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3... in ``order`` over the whole table; beyond ``upto`` null.

    Spark cuts the rows into ranges by sampling. Each range is numbered by itself, after as many as the ranges before it hold;
    one task sees one row for each range, never all rows. Ranges that lie beyond ``upto`` aren't sorted.
    """
    part, before = free_name(rows, "part"), free_name(rows, "before")
    ranged = written(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(part).agg(F.count("*").alias(before))
    earlier = F.sum(before).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(part, F.coalesce(earlier, F.lit(0)).alias(before))
    placed = ranged.join(F.broadcast(sizes), part)  # one row for each range
    number = F.row_number().over(Window.partitionBy(part).orderBy(*order)) + F.col(before)
    kept = [F.col(f"`{c}`") for c in rows.columns]
    if upto is None:
        return placed.select(*kept, number.cast("long").alias(name))
    near = placed.where(F.col(before) < upto).select(*kept, F.when(number <= upto, number).cast("long").alias(name))
    return near.unionByName(placed.where(F.col(before) >= upto).select(*kept, F.lit(None).cast("long").alias(name)))
