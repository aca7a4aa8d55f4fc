"""Tables that a job writes for its own later steps: computed once, lineage cut, safe from lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, a new local one if Spark runs in one process, else an error."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        given = tempfile.mkdtemp(prefix="isobar-")
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def step(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder."""
    path = place(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
