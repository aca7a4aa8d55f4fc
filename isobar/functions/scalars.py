"""Column expressions: rounding, wind, atmosphere, humidity, contrails, cloud cover, display."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Standard atmosphere, unit conversions, saturation and contrail parameters.
FEET = 3.280839895
KNOTS = 1.943844
EARTH_KM = 6371.0
ETA, EI_H2O, Q_FUEL, CP, EPS = 0.3, 1.23, 43.13e6, 1004.0, 287.05 / 461.51
RHI_PERSISTENT = 0.95
ZERO_C = 273.15
#: Cover at rates of 1e-6 kg m-2 s-1, logarithmic in between.
COVER_RATES = [1.6, 3.6, 8.1, 18.5, 39.0, 89.0, 197.0, 440.0, 984.0]
COVERS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
SECTORS = "N NNE NE ENE E ESE SE SSE S SSW SW WSW W WNW NW NNW".split()


def half_up(x: Column, digits: int = 0) -> Column:
    """Rounds halves towards plus infinity, as ``round`` doesn't."""
    return F.floor(x + 0.5) if digits == 0 else F.floor(x * 10.0**digits + 0.5) / 10.0**digits


def no_nan(x: Column) -> Column:
    """NaN as null: nulls lose comparisons, NaN would win them."""
    return F.when(~F.isnan(x), x)


def wind_knots(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v) * KNOTS


def isa_feet(p: Column) -> Column:
    """Pressure altitude in feet of a pressure in hPa: the layer with a lapse rate, then the isothermal one."""
    low = 44330.77 * (1 - F.pow(p / 1013.25, F.lit(0.190263)))
    return F.when(p >= 226.32, low).otherwise(11000 + 6341.62 * F.ln(226.32 / p)) * FEET


def flight_level(p: Column) -> Column:
    return half_up(isa_feet(p) / 100)


def level_byte(fl: Column) -> Column:
    """A flight level in fives within 1 to 255; 0 for a missing one."""
    return F.when(fl.isNull() | F.isnan(fl), 0).otherwise(F.least(F.greatest(half_up(fl / 5), F.lit(1)), F.lit(255)))


def vapour_over_water(t: Column) -> Column:
    tail = 53.878 - 1331.22 / t - 9.44523 * F.ln(t) + 0.014025 * t
    return F.exp(54.842763 - 6763.22 / t - 4.21 * F.ln(t) + 0.000367 * t + F.tanh(0.0415 * (t - 218.8)) * tail)


def vapour_over_ice(t: Column) -> Column:
    return F.exp(9.550426 - 5723.265 / t + 3.53068 * F.ln(t) - 0.00728332 * t)


def mixing_slope(p: Column) -> Column:
    return EI_H2O * CP * p / (EPS * Q_FUEL * (1 - ETA))


def threshold_temperature(slope: Column) -> Column:
    x = F.ln(slope - 0.053)
    return ZERO_C - 46.46 + 9.43 * x + 0.72 * x * x


def critical_humidity(t: Column, slope: Column) -> Column:
    """Humidity over water from which a contrail forms; null where it is too warm for any."""
    limit = threshold_temperature(slope)
    raw = (slope * (t - limit) + vapour_over_water(limit)) / vapour_over_water(t)
    return F.when(t <= limit, F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)))


def ice_humidity(q: Column, p: Column, t: Column) -> Column:
    return q * p / (EPS * vapour_over_ice(t))


def water_humidity(rhi: Column, t: Column) -> Column:
    return rhi * vapour_over_ice(t) / vapour_over_water(t)


def contrail_class(t: Column, rhi: Column, p: Column) -> Column:
    """0 none, 1 short-lived, 2 persistent, 255 without data."""
    forms = water_humidity(rhi, t) > critical_humidity(t, mixing_slope(p))
    return F.when(t.isNull() | rhi.isNull(), 255).when(~F.coalesce(forms, F.lit(False)), 0).when(rhi >= RHI_PERSISTENT, 2).otherwise(1)


def cloud_cover(rate: Column) -> Column:
    """Cover of convective cloud from a rain rate in kg m-2 s-1, 0 to 0.8."""
    c = rate * 1e6
    out = F.when(c <= COVER_RATES[0], 0.0)
    for k in range(1, len(COVERS)):
        a, b = COVER_RATES[k - 1], COVER_RATES[k]
        out = out.when(c <= b, COVERS[k - 1] + (COVERS[k] - COVERS[k - 1]) * F.ln(c / a) / math.log(b / a))
    return F.when(c.isNull(), 0.0).otherwise(out.otherwise(COVERS[-1]))


def classes(x: Column, edges: list[float]) -> Column:
    """How many edges x has reached; 0 for a missing value."""
    return sum((F.when(x >= e, 1).otherwise(0) for e in edges), F.lit(0))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    return EARTH_KM * F.acos(F.least(F.lit(1.0), F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(d)))


def wrap_180(lon: Column) -> Column:
    x = F.pmod(lon + 180, F.lit(360)) - 180
    return F.when(x == -180, 180).otherwise(x)


def sector(degrees: Column) -> Column:
    """One of 16 compass points."""
    return F.get(F.array(*map(F.lit, SECTORS)), (half_up(F.pmod(degrees, F.lit(360)) / 22.5) % 16).cast("int"))


def pressure_altitude(z: Column, surfaces: Column) -> Column:
    """z less its offset from the standard atmosphere, interpolated between surfaces (z, d) sorted by z and held beyond them."""
    first, last = F.get(surfaces, F.lit(0)), F.element_at(surfaces, -1)
    after = F.filter(surfaces, lambda s: s["z"] >= z)
    before = F.filter(surfaces, lambda s: s["z"] < z)
    a, b = F.element_at(before, -1), F.get(after, F.lit(0))
    between = a["d"] + (z - a["z"]) / (b["z"] - a["z"]) * (b["d"] - a["d"])
    return z - F.when(F.size(surfaces) == 0, 0.0).when(z <= first["z"], first["d"]).when(z > last["z"], last["d"]).otherwise(between)
