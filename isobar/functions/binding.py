"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, work: Callable[[Column], Column]) -> Column:
    """``work(value)`` with ``value`` made once, however often ``work`` uses it: inside it is a variable, not its expression."""
    return F.get(F.transform(F.array(value), work), F.lit(0))
