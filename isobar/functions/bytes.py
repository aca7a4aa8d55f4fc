"""Layers of one byte a cell as base64, as a published map carries them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed(values: Column, unit: float) -> Column:
    """Base64 of a byte for each value: its multiple of ``unit``, at least 1 and at most 255; 0 for missing values and those not above 0."""
    number = lambda v: F.when(v.isNull() | F.isnan(v) | ~(v > 0), F.lit(0)).otherwise(F.least(F.greatest(F.floor(v / unit + 0.5), F.lit(1)), F.lit(255)).cast("int"))
    text = F.base64(F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(number(v)), 2, "0")), "")))
    return F.replace(text, F.lit("\r\n"), F.lit(""))  # Spark breaks long lines


def unpacked(layer: Column, unit: float) -> Column:
    """The values of such a layer, 0 where they are missing; an empty or null layer has none."""
    pairs = F.regexp_extract_all(F.hex(F.unbase64(F.coalesce(layer, F.lit("")))), F.lit("(..)"), F.lit(1))
    return F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("int") * unit)


def cells_at_least(layer: Column, unit: float, least: float) -> Column:
    """How many cells reach ``least``, decided on the bytes: those whose byte is not under the threshold's."""
    bound = F.lpad(F.hex(F.lit(max(1, min(255, int(-(-least // unit)))))), 2, "0")
    return F.size(F.filter(F.regexp_extract_all(F.hex(F.unbase64(layer)), F.lit("(..)"), F.lit(1)), lambda p: p >= bound))
