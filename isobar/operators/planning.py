"""Which due items are read now: a lattice of slots less what is held, in an order of priority, under limits of cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.steps import step
from .running import running


def spread_rank(slot: Column, bits: int) -> Column:
    """Where a slot of 0 .. 2^bits - 1 comes if every next one halves the widest gap: its bits in reverse."""
    out = F.lit(0)
    for k in range(bits):
        out = out + F.shiftright(slot, k).bitwiseAND(F.lit(1)) * (1 << (bits - 1 - k))
    return out


def budgeted(slots: DataFrame, host: str, order: list[Column], cost: str, per_host: int, in_all: int) -> DataFrame:
    """``slots`` with ``chosen`` and ``reason``.

    ``state`` of a slot is null where it is due, else the reason why it isn't asked for. Due slots of a host are taken in
    ``order`` while their running cost stays within ``per_host``; of those taken, over all hosts, while it stays within
    ``in_all``. A slot that doesn't fit ends its host's turn, so that no cheaper one overtakes it. ``order`` ends in columns that
    no two slots share. Costs are of 0 or more; null costs nothing.
    """
    priced = step(slots.withColumn(cost, F.coalesce(F.col(cost), F.lit(0))), "priced")
    # What is due and its running costs are read twice: for what fits and for what doesn't. Where a slot is due its state says nothing.
    due = step(running(priced.where("state is null").drop("state"), [host], order, sums={"host_total": F.col(cost)}), "due")
    fits = due.where(F.col("host_total") <= per_host)
    fits = running(fits, [], order, sums={"total": F.col(cost)})
    said = F.when(F.col("total") <= in_all, F.lit("chosen")).otherwise(F.lit("limit in all"))
    columns = [c for c in slots.columns if c != "state"]
    chosen = fits.select(*columns, "host_total", "total", said.alias("reason"))
    nothing = F.lit(None).cast("long")
    over = due.where(F.col("host_total") > per_host).select(*columns, "host_total", nothing.alias("total"), F.lit("limit of its host").alias("reason"))
    rest = priced.where("state is not null").select(*columns, nothing.alias("host_total"), nothing.alias("total"), F.col("state").alias("reason"))
    return chosen.unionByName(over).unionByName(rest).withColumn("chosen", F.col("reason") == "chosen")
