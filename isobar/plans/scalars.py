"""Queries that apply the scalar functions to values derived from ``part`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from .registry import register, table

#: Temperatures 200-259 K, relative humidities 0-1.29, pressures 150-949 hPa from a part's key.
_IN = "select p_partkey, 200.0::double + p_partkey % 60 as t, (p_partkey % 130) / 100.0::double as rh, 150.0::double + p_partkey * 7 % 800 as p from part"
_EW = "exp(54.842763 - 6763.22 / {t} - 4.21 * ln({t}) + 0.000367 * {t} + tanh(0.0415 * ({t} - 218.8)) * (53.878 - 1331.22 / {t} - 9.44523 * ln({t}) + 0.014025 * {t}))"
_EI = "exp(9.550426 - 5723.265 / {t} + 3.53068 * ln({t}) - 0.00728332 * {t})"
_G = "(1.23 * 1004.0 * ({p} * 100) / (287.05 / 461.51 * 43.13e6 * (1 - 0.3)))"
_TLM = "(273.15 - 46.46 + 9.43 * ln(g - 0.053) + 0.72 * ln(g - 0.053) * ln(g - 0.053))"


def inputs(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", (F.lit(200.0) + k % 60).alias("t"), (k % 130 / 100.0).alias("rh"), (F.lit(150.0) + k * 7 % 800).alias("p"))


_FT = "(case when p >= 226.32 then 44330.77 * (1 - pow(p / 1013.25, 0.190263)) else 11000 + 6341.62 * ln(226.32 / p) end * 3.280839895)"


@register("standard_atmosphere", f"with x as ({_IN}) select p_partkey, round({_FT}, 4) as feet, floor({_FT} / 100 + 0.5)::bigint as fl, least(greatest(floor(floor({_FT} / 100 + 0.5) / 5 + 0.5), 1), 255)::bigint as byte from x")
def standard_atmosphere(spark, d):
    x = inputs(spark, d)
    return x.select("p_partkey", F.round(S.isa_feet(F.col("p")), 4).alias("feet"), S.flight_level(F.col("p")).alias("fl"), S.level_byte(S.flight_level(F.col("p"))).cast("long").alias("byte"))


@register("saturation_pressures", f"with x as ({_IN}) select p_partkey, round({_EW.format(t='t')}, 6) as water, round({_EI.format(t='t')}, 6) as ice from x")
def saturation_pressures(spark, d):
    return inputs(spark, d).select("p_partkey", F.round(S.vapour_over_water(F.col("t")), 6).alias("water"), F.round(S.vapour_over_ice(F.col("t")), 6).alias("ice"))


@register("humidity_conversions", f"with x as ({_IN}) select p_partkey, round(rh * {_EW.format(t='t')} / {_EI.format(t='t')}, 7) as over_ice, round(rh * {_EI.format(t='t')} / {_EW.format(t='t')}, 7) as over_water, round(rh / 1000 * p * 100 / (287.05 / 461.51 * {_EI.format(t='t')}), 6) as from_q from x")
def humidity_conversions(spark, d):
    t, rh, p = F.col("t"), F.col("rh"), F.col("p")
    return inputs(spark, d).select("p_partkey", F.round(rh * S.vapour_over_water(t) / S.vapour_over_ice(t), 7).alias("over_ice"), F.round(S.water_humidity(rh, t), 7).alias("over_water"), F.round(S.ice_humidity(rh / 1000, p * 100, t), 6).alias("from_q"))


@register(
    "contrail_classes",
    f"""with x as ({_IN}), g as (select *, {_G.format(p='p')} as g from x), l as (select *, {_TLM} as tl from g),
    c as (select *, case when t <= tl then least(1, greatest(0, (g * (t - tl) + {_EW.format(t='tl')}) / {_EW.format(t='t')})) end as crit from l)
    select p_partkey, round(tl, 6) as threshold, round(crit, 6) as critical, (case when not coalesce(rh * {_EI.format(t='t')} / {_EW.format(t='t')} > crit, false) then 0 when rh >= 0.95 then 2 else 1 end)::integer as class from c""",
)
def contrail_classes(spark, d):
    t, rh, p = F.col("t"), F.col("rh"), F.col("p") * 100
    g = S.mixing_slope(p)
    return inputs(spark, d).select("p_partkey", F.round(S.threshold_temperature(g), 6).alias("threshold"), F.round(S.critical_humidity(t, g), 6).alias("critical"), S.contrail_class(t, rh, p).alias("class"))


@register(
    "humidity_convention",
    f"""with x as ({_IN}), r as (select p_partkey % 3 as level, (rh * 100) / 100 / (rh * (0.97 + (p_partkey % 7) / 100.0)) as ratio from x where t < 233 and rh * 100 > 5)
    select level, count(*) as n, round(median(ratio), 3) as ratio, case when count(*) < 100 then null when median(ratio) > 0.9 and median(ratio) < 1.1 then 'ice' when median(ratio) > 0.5 and median(ratio) < 0.75 then 'water' end as convention from r group by level""",
)
def humidity_convention(spark, d):
    k = F.col("p_partkey")
    r = inputs(spark, d).where("t < 233 and rh * 100 > 5").select((k % 3).alias("level"), (F.col("rh") * 100 / 100 / (F.col("rh") * (0.97 + k % 7 / 100.0))).alias("ratio"))
    m = r.groupBy("level").agg(F.count("*").alias("n"), F.median("ratio").alias("m"))
    kind = F.when(F.col("n") < 100, None).when((F.col("m") > 0.9) & (F.col("m") < 1.1), "ice").when((F.col("m") > 0.5) & (F.col("m") < 0.75), "water")
    return m.select("level", "n", F.round("m", 3).alias("ratio"), kind.alias("convention"))


def _cover_sql() -> str:
    steps = "".join(f" when c <= {S.COVER_RATES[k]} then {S.COVERS[k - 1]} + {S.COVERS[k] - S.COVERS[k - 1]} * ln(c / {S.COVER_RATES[k - 1]}) / ln({S.COVER_RATES[k]}::double / {S.COVER_RATES[k - 1]})" for k in range(1, len(S.COVERS)))
    return f"with x as (select p_partkey, (p_partkey % 1200)::double as c from part) select p_partkey, round(case when c <= 1.6 then 0.0{steps} else 0.8 end, 9) as cover from x"


@register("cloud_cover", _cover_sql())
def cloud_cover(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(S.cloud_cover((F.col("p_partkey") % 1200).cast("double") / 1e6), 9).alias("cover"))


@register(
    "convective_class",
    "select p_partkey, case when p_size % 9 = 0 then null when p_retailprice < 1000 then 0 when p_size >= 25 then 2 else 1 end as class, case when p_size >= 40 then 'high' when p_size >= 20 then 'moderate' else 'low' end as band, (p_retailprice >= 950)::integer + (p_retailprice >= 1000)::integer + (p_retailprice >= 1100)::integer as step from part",
)
def convective_class(spark, d):
    cape = F.when(F.col("p_size") % 9 != 0, F.col("p_retailprice"))
    kind = F.when(cape.isNull(), None).when(cape < 1000, 0).when(F.col("p_size") >= 25, 2).otherwise(1)
    band = F.when(F.col("p_size") >= 40, "high").when(F.col("p_size") >= 20, "moderate").otherwise("low")
    return table(spark, d, "part").select("p_partkey", kind.alias("class"), band.alias("band"), S.classes(F.col("p_retailprice"), [950.0, 1000.0, 1100.0]).alias("step"))


@register(
    "rounding_and_wrapping",
    """select p_partkey, floor(p_retailprice - 1000 + 0.5)::bigint as whole, floor((p_retailprice - 1000) * 10 + 0.5) / 10 as tenth, case when (p_partkey * 37 % 720 + 180) % 360 = 0 then 180 else (p_partkey * 37 % 720 + 180) % 360 - 180 end as lon,
    ['N','NNE','NE','ENE','E','ESE','SE','SSE','S','SSW','SW','WSW','W','WNW','NW','NNW'][(floor((p_partkey % 360) / 22.5 + 0.5) % 16)::integer + 1] as sector, floor((p_partkey * 13 % 997) / 50.0 + 0.5)::bigint * 50 as fifties from part""",
)
def rounding_and_wrapping(spark, d):
    k = F.col("p_partkey")
    lon = S.wrap_180(k * 37 % 720 - 360)
    return table(spark, d, "part").select("p_partkey", S.half_up(F.col("p_retailprice") - 1000).alias("whole"), S.half_up(F.col("p_retailprice") - 1000, 1).alias("tenth"), lon.alias("lon"), S.sector(k % 360).alias("sector"), (S.half_up(k * 13 % 997 / 50.0) * 50).alias("fifties"))


@register(
    "great_circle",
    "select p_partkey, round(6371.0 * acos(least(1.0, sin(radians(p_partkey % 80)) * sin(radians(p_size)) + cos(radians(p_partkey % 80)) * cos(radians(p_size)) * cos(radians((p_partkey % 170) - p_size)))), 3) as km from part",
)
def great_circle(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", F.round(S.great_circle_km(F.col("p_size"), F.col("p_size"), k % 80, k % 170), 3).alias("km"))


@register(
    "pressure_altitude",
    """with x as (select p_partkey, 500.0 + p_partkey % 7000 as z, 1400.0 + p_size as a, 2900.0 + p_size as b, 5400.0 + p_size as c from part),
    y as (select *, a - 44330.77 * (1 - pow(850 / 1013.25, 0.190263)) as da, b - 44330.77 * (1 - pow(700 / 1013.25, 0.190263)) as db, c - 44330.77 * (1 - pow(500 / 1013.25, 0.190263)) as dc from x)
    select p_partkey, round(z - case when z <= a then da when z > c then dc when z <= b then da + (z - a) / (b - a) * (db - da) else db + (z - b) / (c - b) * (dc - db) end, 6) as metres from y""",
)
def pressure_altitude(spark, d):
    surface = lambda z, hpa: F.struct((F.lit(z) + F.col("p_size")).alias("z"), (F.lit(z) + F.col("p_size") - 44330.77 * (1 - F.pow(F.lit(hpa / 1013.25), F.lit(0.190263)))).alias("d"))
    surfaces = F.array(surface(1400.0, 850.0), surface(2900.0, 700.0), surface(5400.0, 500.0))
    x = table(spark, d, "part").select("p_partkey", (500.0 + F.col("p_partkey") % 7000).alias("z"), surfaces.alias("s"))
    return x.select("p_partkey", F.round(S.pressure_altitude(F.col("z"), F.col("s")), 6).alias("metres"))


@register(
    "iso_weeks",
    """select o_orderkey, strftime(o_orderdate, '%G-W%V') as week, cast(o_orderdate as date) + 6 as last_day, cast(date_trunc('week', o_orderdate) as date) as monday,
    cast(least(date_trunc('week', o_orderdate), o_orderdate - interval 2 day) as date) as since from orders""",
)
def iso_weeks(spark, d):
    day = F.to_date("o_orderdate")
    monday = F.to_date(F.date_trunc("week", "o_orderdate"))
    thursday = F.date_add(monday, 3)
    week = F.format_string("%d-W%02d", F.year(thursday), F.weekofyear(day))
    return table(spark, d, "orders").select("o_orderkey", week.alias("week"), F.date_add(day, 6).alias("last_day"), monday.alias("monday"), F.least(monday, F.date_sub(day, 2)).alias("since"))


@register(
    "day_of_month_resolved",
    """with x as (select o_orderkey, cast(o_orderdate as date) as d, (o_orderkey % 28 + 1)::integer as dom from orders), y as (select *, cast(date_trunc('month', d) as date) + (dom - 1)::integer as c from x)
    select o_orderkey, case when c - d > 15 then cast(c - interval 1 month as date) when c - d < -15 then cast(c + interval 1 month as date) else c end as resolved from y""",
)
def day_of_month_resolved(spark, d):
    day = F.to_date("o_orderdate")
    c = F.date_add(F.trunc(day, "month"), (F.col("o_orderkey") % 28).cast("int"))
    apart = F.datediff(c, day)
    return table(spark, d, "orders").select("o_orderkey", F.when(apart > 15, F.add_months(c, -1)).when(apart < -15, F.add_months(c, 1)).otherwise(c).alias("resolved"))


@register("newest_cycles", "select o_orderkey, time_bucket(interval '6 hours', o_orderdate - to_minutes((o_orderkey % 700 + 240)::integer), timestamp '2000-01-01') as cycle, hour(time_bucket(interval '12 hours', o_orderdate - to_minutes((o_orderkey % 700 + 420)::integer), timestamp '2000-01-01')) as fallback_hour from orders")
def newest_cycles(spark, d):
    at = lambda lag: F.unix_seconds(F.col("o_orderdate").cast("timestamp")) - (F.col("o_orderkey") % 700 + lag) * 60
    floor = lambda s, h: F.timestamp_seconds(F.floor(s / (h * 3600)) * (h * 3600)).cast("timestamp_ntz")
    return table(spark, d, "orders").select("o_orderkey", floor(at(240), 6).alias("cycle"), F.hour(floor(at(420), 12)).alias("fallback_hour"))


@register("layer_turbulence", """select p_partkey, round(case when dz > 0 then sqrt(du * du + dv * dv) / dz * (da + db) / 2 * 1e7 end, 6) as ti from (select p_partkey, (p_size - 20)::double as du, (p_partkey % 30 - 10)::double as dv, (p_partkey % 50 * 40 - 200)::double as dz, p_size * 1e-6 as da, (p_partkey % 9) * 1e-6 as db from part)""")
def layer_turbulence(spark, d):
    k, s = F.col("p_partkey"), F.col("p_size")
    du, dv, dz = (s - 20).cast("double"), (k % 30 - 10).cast("double"), (k % 50 * 40 - 200).cast("double")
    ti = F.when(dz > 0, F.try_divide(F.sqrt(du * du + dv * dv), dz) * (s * 1e-6 + k % 9 * 1e-6) / 2 * 1e7)
    return table(spark, d, "part").select("p_partkey", F.round(ti, 6).alias("ti"))


@register("missing_aware_maximum", "select vec_id, greatest(case when embedding[1] > 0 then embedding[1] end, case when embedding[2] > 0 then embedding[2] end) as top from embeddings")
def missing_aware_maximum(spark, d):
    """A missing value (NaN at its source) never wins, and a value beside a missing one counts."""
    of = lambda k: F.when(F.get("embedding", F.lit(k)) > 0, F.get("embedding", F.lit(k))).otherwise(F.lit(float("nan")).cast("float"))
    return table(spark, d, "embeddings").select("vec_id", F.greatest(S.no_nan(of(0)), S.no_nan(of(1))).alias("top"))
