"""Queries without SQL, held against plain versions in tests: clipping, simplifying, axes of flow, coded observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as Geo
from ..functions import observations as Ob
from ..functions import simplification as Si
from ..operators import outlines, tracing
from .registry import register, table


def paths(spark, d):
    """Orders of a customer as a path in the order of their keys."""
    p = F.struct("o_orderkey", (F.col("o_orderkey") % 170 / 10.0).alias("x"), (F.col("o_orderkey") % 130 / 10.0).alias("y"))
    g = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(p)).alias("p"))
    return g.select("o_custkey", F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))).alias("p"))


@register("clipped_rings")
def clipped_rings(spark, d):
    clipped = paths(spark, d).select("o_custkey", Geo.clip_to_box(F.col("p"), 2.0, 2.0, 12.0, 9.0).alias("ring"))
    return clipped.select("o_custkey", F.size("ring").alias("points"), F.round(Geo.area_km2(F.col("ring"), F.lit(50.0)), 3).alias("km2"))


@register("simplified_paths")
def simplified_paths(spark, d):
    p = paths(spark, d)
    sizes = [F.size(Si.simplify(F.col("p"), 1.5, m)).alias(m) for m in ("segment", "line", "cosine")]
    return p.select("o_custkey", F.size("p").alias("points"), *sizes)


@register("outlines_within_budget")
def outlines_within_budget(spark, d):
    """Orders of a customer as a ring, simplified so that a nation's rings keep 300 points in all."""
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return outlines.within_budget(paths(spark, d).join(nation, "o_custkey"), ["c_nationkey"], "p", 300)


@register("axes_of_flow")
def axes_of_flow(spark, d):
    """Pairs of tiles as west-east and south-north wind on a coarse grid."""
    t = table(spark, d, "embeddings").withColumn("v", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 400))
    u = t.where("vec_id % 2 = 0").select("vec_id", F.col("v").alias("u"))
    w = t.where("vec_id % 2 = 1").select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("v"))
    both = u.join(w, "vec_id").withColumn("speed", F.zip_with("u", "v", lambda a, b: F.sqrt(a * a + b * b)))
    grid = [F.lit(8).alias("nlat"), F.lit(8).alias("nlon"), F.lit(40.0).alias("south"), F.lit(-30.0).alias("west"), F.lit(2.0).alias("step")]
    return tracing.axes(both.select("vec_id", "u", "v", "speed", *grid), ["vec_id"], tracing.Options(least_speed=60.0, least_km=300.0))


@register("decoded_reports")
def decoded_reports(spark, d):
    k = F.col("event_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    weather = F.get(F.array(*map(F.lit, ["-RA BR", "+TSRA", "", "FG", "SHSN", "DU"])), (k % 6).cast("int"))
    seen = F.when(k % 4 == 0, F.concat_ws(" ", (k % 9).cast("string"), F.lit("1/2SM"))).when(k % 4 == 1, "CAVOK").otherwise(F.lpad((k % 97 * 100).cast("string"), 4, "0"))
    report = F.concat_ws(" ", F.lit("METAR XXXX"), F.concat(two(k % 28 + 1), two(F.hour("ts")), F.lit("50Z")), F.concat(F.lit("270"), two(k % 60), F.when(k % 3 == 0, F.concat(F.lit("G"), two(k % 60 + 10))).otherwise(""), F.lit("KT")), seen, weather, F.concat(F.when(k % 2 == 0, "M").otherwise(""), two(k % 30), F.lit("/10")))
    r = table(spark, d, "events").select("event_id", Ob.observed(F.regexp_replace(report, " +", " ")).alias("o"))
    return r.select("event_id", F.concat_ws(" ", "o.weather").alias("weather"), "o.visibility_m", "o.gust_kt", "o.temperature_c", Ob.phenomena(F.col("o.weather"), F.col("o.visibility_m"))["fog"].alias("fog"))


@register(
    "rings_out",
    """with p as (select o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as n, floor(o_orderkey % 170 / 40.0 * 10 + 0.5) / 10 as x, floor(o_orderkey % 130 / 40.0 * 10 + 0.5) / 10 as y from orders),
    d as (select *, lag(x) over w as px, lag(y) over w as py from p window w as (partition by o_custkey order by n)),
    k as (select o_custkey, x, y, row_number() over (partition by o_custkey order by n) as i, count(*) over (partition by o_custkey) as m, first_value(x) over (partition by o_custkey order by n) as fx, first_value(y) over (partition by o_custkey order by n) as fy from d where px is null or px <> x or py <> y),
    r as (select * from k where not (i = m and m > 1 and x = fx and y = fy))
    select o_custkey, count(*)::integer as points, round(sum(x * i), 6) as xs, round(sum(y * i), 6) as ys from r group by o_custkey having count(*) >= 3""",
)
def rings_out(spark, d):
    """Rings as they are published: rounded to one decimal, without neighbours' repeats, open, of three points or more."""
    scaled = paths(spark, d).select("o_custkey", F.transform("p", lambda q: F.struct((q["x"] / 4).alias("x"), (q["y"] / 4).alias("y"))).alias("p"))
    r = scaled.select("o_custkey", Si.rounded_ring(F.col("p")).alias("r")).where(F.size("r") > 0)
    total = lambda c: F.round(F.aggregate(F.transform("r", lambda q, i: q[c] * (i + 1)), F.lit(0.0), lambda s, v: s + v), 6)
    return r.select("o_custkey", F.size("r").alias("points"), total("x").alias("xs"), total("y").alias("ys"))
