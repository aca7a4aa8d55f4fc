"""The session that jobs and tests share."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "isobar", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; every other setting is the cluster's own."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def reachable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from its checkout, where it isn't installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
