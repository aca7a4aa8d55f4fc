"""Publishing: contract checks first, then one replaced pointer file makes the new output the current one."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, Column], key: Column) -> DataFrame:
    """(rule, key) for every row that breaks a rule; a rule without an answer counts as broken. No rows: the contract holds."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return df.select(F.explode(broken).alias("rule"), key.alias("key"))


_POINTER = "current"


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(df: DataFrame, path: str, rules: dict[str, Column], key: Column) -> DataFrame:
    """Writes ``df`` as a new version under ``path``, checks what was written, then points ``path`` at it; else the old one stays.

    The pointer is a small file that is replaced by one rename: readers by :func:`published` see the old version or the new
    one, whenever a job stops. Older versions stay until :func:`drop_old`. A breach raises ValueError with the rules' names.
    """
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    bad = [r["rule"] for r in violations(spark.read.parquet(f"{path}/{version}"), rules, key).select("rule").distinct().collect()]
    jvm, at, fs = _files(spark, path)
    if bad:
        fs.delete(jvm.org.apache.hadoop.fs.Path(at, version), True)
        raise ValueError(f"not published: {', '.join(sorted(bad))}")
    staged = jvm.org.apache.hadoop.fs.Path(at, f"{_POINTER}-{version}")
    out = fs.create(staged, True)
    out.write(bytearray(version.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(staged, jvm.org.apache.hadoop.fs.Path(at, _POINTER), overwrite)
    return published(spark, path)


def _version(spark: SparkSession, path: str) -> str:
    return spark.read.text(f"{path}/{_POINTER}", wholetext=True).first()[0]


def published(spark: SparkSession, path: str) -> DataFrame:
    """The version that ``path`` points at."""
    return spark.read.parquet(f"{path}/{_version(spark, path)}")


def drop_old(spark: SparkSession, path: str) -> int:
    """Deletes every version but the current one; run it when no reader is left on them. Gives their number."""
    jvm, at, fs = _files(spark, path)
    now = _version(spark, path)
    old = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("version-") and f.getPath().getName() != now]
    for f in old:
        fs.delete(f, True)
    return len(old)


def stamp(parameters: dict) -> Column:
    """Twelve hex digits of the parameters, whatever their order: two outputs of one stamp come from the same producer."""
    rows = sorted((k, str(v)) for k, v in parameters.items())
    return F.substring(F.sha2(F.to_json(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in rows])), 256), 1, 12)


def is_stamp(text: Column) -> Column:
    """Whether a text is a stamp: twelve lowercase hex digits and nothing else."""
    return F.coalesce(text.rlike("^[0-9a-f]{12}$"), F.lit(False))


def stamp_of(**parameters: Column) -> Column:
    """:func:`stamp` of parameters that are columns: the same for the same values as text, null values as an empty text."""
    rows = [F.struct(F.lit(k).alias("k"), F.coalesce(v.cast("string"), F.lit("")).alias("v")) for k, v in sorted(parameters.items())]
    return F.substring(F.sha2(F.to_json(F.array(*rows)), 256), 1, 12)
