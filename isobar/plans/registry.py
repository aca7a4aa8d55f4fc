"""The queries over the driver's tables and, for each, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import reachable

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


_QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Adds a query under ``name``, with its SQL where SQL can express it."""

    def add(run: Run) -> Run:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    from . import areas, bulletins, contracts, due, frames, lookups, nested, notices, products, scalars, shapes, texts, tiles, views  # noqa: F401


def queries() -> dict[str, Run]:
    _load()
    return {k: q.run for k, q in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: q.sql for k, q in _QUERIES.items() if q.sql}
