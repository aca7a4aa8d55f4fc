"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_dir


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Each round takes the least label among neighbours, then the label's own label (pointer jumping), so a chain of n
    nodes needs about log n rounds. Labels are checkpointed each round; neither links nor labels go to the driver.
    """
    shared_dir(links.sparkSession)
    near = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    near = near.union(links.select(F.col("b"), F.col("a"))).distinct().checkpoint()
    labels = near.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("component"))
    labels = labels.checkpoint()
    while True:
        there = labels.select(F.col("node").alias("other"), F.col("component").alias("c"))
        best = near.join(there, "other").groupBy("node").agg(F.min("c").alias("m"))
        step = labels.join(best, "node").select("node", F.col("component").alias("before"), F.least("component", "m").alias("component"))
        roots = step.select(F.col("node").alias("component"), F.col("component").alias("root"))
        step = step.join(roots, "component").select("node", "before", F.least("component", "root").alias("component")).checkpoint()
        moved = step.where("component <> before").limit(1).count()
        labels = step.select("node", "component")
        if not moved:
            return labels
