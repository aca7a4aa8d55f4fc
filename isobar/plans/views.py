"""Queries over customers and orders as places and lines of a map: what a satellite sees, layers of areas, clipped lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import profiles, view
from ..operators import features, layers
from ..operators import places as near
from . import areas
from .registry import register, table

#: The extent of a lightning imager's frame, its band of scan angles, and a grid of half degrees under it.
VIEW = view.View(south=-10.0, north=72.0, west=-80.0, east=82.0, band=7.15)
GRID = view.Grid(lat0=-90.0, lon0=-180.0, step=0.5, nlat=360, nlon=720)
_PLACES = "select c_custkey, c_nationkey, c_custkey * 97 % 3600 / 10.0 - 180 as lon, (c_acctbal + 1000) / 80 - 60 as lat from customer"


def places(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", (F.col("c_custkey") * 97 % 3600 / 10.0 - 180).alias("lon"), ((F.col("c_acctbal") + 1000) / 80 - 60).alias("lat"))


_SEEN = f"""
with p as ({_PLACES}),
c as (select *, floor((lat + 90) / 0.5) as j, floor((lon + 180) / 0.5) as i from p),
m as (select *, -90 + (j + 0.5) * 0.5 as y, -180 + (i + 0.5) * 0.5 as x from c),
a as (select *, 6371.0 * cos(radians(y)) * cos(radians(x)) - 42164.0 as dx, 6371.0 * cos(radians(y)) * sin(radians(x)) as dy, 6371.0 * sin(radians(y)) as dz from m),
s as (select *, j between 0 and 359 and i between 0 and 719 and y between -10 and 72 and x between -80 and 82 and cos(radians(y)) * cos(radians(x)) > 6371.0 / 42164.0
  and abs(degrees(atan2(dz, sqrt(dx * dx + dy * dy))) - degrees(atan2(dy, -dx))) / sqrt(2) <= 7.15 as seen from a)"""


@register("places_in_view", f"{_SEEN} select c_nationkey, count(*) as n, count(*) filter (seen) as seen, floor(100.0 * count(*) filter (seen) / count(*) + 0.5)::integer as percent from s group by 1")
def places_in_view(spark, d):
    """Of each nation's customers the percentage in cells that the imager sees."""
    p = view.with_seen(places(spark, d), "lat", "lon", VIEW, GRID)
    n, seen = F.count("*"), F.count_if("seen")
    return p.groupBy("c_nationkey").agg(n.alias("n"), seen.alias("seen"), F.floor(100.0 * seen / n + 0.5).cast("int").alias("percent"))


@register("cells_in_view", f"{_SEEN} select j::integer as j, i::integer as i, seen, count(*) as n from s group by all")
def cells_in_view(spark, d):
    """Cells that hold customers, seen or not."""
    p = view.with_seen(places(spark, d), "lat", "lon", VIEW, GRID)
    return p.groupBy(GRID.row(F.col("lat")).alias("j"), GRID.column(F.col("lon")).alias("i"), "seen").agg(F.count("*").alias("n"))


@register(
    "tile_core_depth",
    """
with v as (select vec_id, j, p, embedding[j * 8 + p + 1]::double as v from embeddings, range(8) a(j), range(8) b(p) where not (vec_id % 5 = 0 and p = 3)),
core as (select vec_id, j, arg_max(p, (v, -p)) as core from v group by all),
s as (select v.*, core, lead(v) over w as nv, lead(p) over w as np from v join core using (vec_id, j) window w as (partition by vec_id, j order by p)),
x as (select *, p + (0.05::double - v) / (nv - v) * (np - p) as z from s where (v < 0.05::double) <> (nv < 0.05::double))
select c.vec_id, c.j::integer as j, core::integer as core, round(max(z) filter (v < nv and np <= c.core), 6) as below, round(min(z) filter (v > nv and p >= c.core), 6) as above,
  round(min(z) filter (v > nv and p >= c.core) - max(z) filter (v < nv and np <= c.core), 6) as depth
from core c left join x using (vec_id, j, core) group by all""",
)
def tile_core_depth(spark, d):
    """Each row of a tile as a profile of eight levels: where it falls under 0.05 on both sides of its greatest value. Some levels are missing."""
    t = table(spark, d, "embeddings").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(7))))
    missing = lambda p: (F.col("vec_id") % 5 == 0) & (p == 3)
    level = F.transform(F.slice("embedding", F.col("j") * 8 + 1, 8), lambda v, p: F.when(~missing(p), v.cast("double")))
    t = t.select("vec_id", "j", level.alias("v"))
    core = (F.array_position("v", F.array_max("v")) - 1).cast("int")
    t = t.withColumn("core", core).withColumn("c", profiles.crossings(F.sequence(F.lit(0), F.lit(7)), F.col("v"), F.col("core"), 0.05))
    return t.select("vec_id", "j", "core", *(F.round(f"c.{k}", 6).alias(k) for k in ("below", "above", "depth")))


#: A day's polygons come from sources of three ranks; its best one replaces the others.
_LAYERS = f"select *, (s_suppkey * 7 % 3)::integer as rank, 'source ' || s_suppkey * 7 % 3 as source, (1 + s_suppkey % 4)::integer as strength, 'kind ' || kind as label from ({areas._SHAPE})"


def layered(spark, d):
    k = F.col("s_suppkey")
    rank = (k * 7 % 3).cast("int")
    return areas.shapes(spark, d).select("s_suppkey", "day", "rings", "exact", rank.alias("rank"), F.concat(F.lit("source "), rank).alias("source"), (1 + k % 4).cast("int").alias("strength"), F.concat(F.lit("kind "), F.col("kind")).alias("label"))


@register(
    "strongest_layer_cells",
    f"""with l as ({_LAYERS}), best as (select day, min((rank, source)) as first_ from l group by day), s as (select l.* from l join best using (day) where (rank, source) = first_),
    t as (select *, 0 as turn from s union all select *, -360 as turn from s where cx + a > 180),
    g as (select j.j, i.i, -180.0 + (i.i + 0.5) * 5 as x, -60.0 + (j.j + 0.5) * 5 as y from (select unnest(range(28)) as j) j, (select unnest(range(72)) as i) i),
    h as (select day, j, i, strength, label from t join g on {areas._inside_sql("x", "y", "turn")})
    select day::integer as day, j::integer as j, i::integer as i, max(strength) as strength, arg_min(label, (-strength, label)) as label from h group by day, j, i""",
)
def strongest_layer_cells(spark, d):
    rows = layered(spark, d)
    best = layers.days_by_source(rows, rows.select("day", "source", "rank").distinct(), "day", "source", "rank")
    return layers.strongest_cells(best, "day", "strength", "label", rings="exact", **areas._GRID)


def _edge_sql(f: float, k: int) -> str:
    (ax, ay), (bx, by) = areas._CORNERS[k], areas._CORNERS[(k + 1) % 4]
    dx, dy = f"((a * {bx * f} - a * {ax * f}) * cos(radians(y)))", f"(b * {by * f} - b * {ay * f})"
    px, py = f"((cx + a * {ax * f} - x) * cos(radians(y)))", f"(cy + b * {ay * f} - y)"
    t = f"least(greatest(-({px} * {dx} + {py} * {dy}) / ({dx} * {dx} + {dy} * {dy}), 0), 1)"
    return f"sqrt(pow({px} + {t} * {dx}, 2) + pow({py} + {t} * {dy}, 2)) * 111.32"


_NEAR = f"least({', '.join(_edge_sql(f, k) for f in (1.0, areas._HOLE) for k in range(4))})"


@register(
    "places_near_areas",
    f"""with p as (select c_custkey, lon as x, lat as y from ({_PLACES})), l as ({_LAYERS}),
    n as (select c_custkey, label, strength, s_suppkey, case when {areas._inside_sql("x", "y")} then 0.0 else {_NEAR} end as distance from p join l on abs(y - cy) <= b + 2.5 and abs(x - cx) * cos(radians(y)) <= a + 2.5),
    h as (select *, count(*) over (partition by c_custkey) as n, row_number() over (partition by c_custkey order by strength desc, round(distance, 3), s_suppkey) as r from n where distance <= 250)
    select c_custkey, n, label, strength, round(distance, 3) as distance from h where r = 1""",
)
def places_near_areas(spark, d):
    """Customers within 250 km of an area: how many areas, and the strongest of them; distances tell areas apart to a metre."""
    points = places(spark, d).select("c_custkey", F.col("lon").alias("x"), F.col("lat").alias("y"))
    best = near.strongest_near(points, layered(spark, d), 250.0, "c_custkey", "s_suppkey", "strength", rings="exact")
    return best.join(layered(spark, d).select("s_suppkey", "label"), "s_suppkey").select("c_custkey", "n", "label", "strength", "distance")


#: The part of the map that lines are clipped to.
BOX = (-170.0, 13.0, 40.0, 75.0)
_LINES = "select o_custkey, o_orderkey, (o_orderkey * 53 % 3600) / 10.0 - 180 as x, (o_orderkey * 29 % 1400) / 10.0 - 60 as y, o_totalprice as worth from orders"


@register(
    "clipped_lines",
    f"""
with v as ({_LINES}),
s as (select *, x - lag(x) over w as dx from v window w as (partition by o_custkey order by o_orderkey)),
u as (select *, x + 360 * sum(case when dx > 180 then -1 when dx < -180 then 1 else 0 end) over (partition by o_custkey order by o_orderkey rows unbounded preceding) as ux from s),
e as (select o_custkey, row_number() over w as n, ux as ax, y as ay, worth as aw, lead(ux) over w as bx, lead(y) over w as by_, lead(worth) over w as bw from u window w as (partition by o_custkey order by o_orderkey)),
c as (select o_custkey, n, copy, ax + copy as ax, ay, aw, bx + copy as bx, by_ as by_, bw from e, (select unnest([-360, 0, 360]) as copy) where bx is not null),
t as (
  select *, greatest(0.0::double, {", ".join(f"case when {p} < 0 then {q} / {p} when {p} = 0 and {q} < 0 then 2.0::double end" for p, q in (("(ax - bx)", f"(ax - ({BOX[0]}))"), ("(bx - ax)", f"({BOX[2]} - ax)"), ("(ay - by_)", f"(ay - {BOX[1]})"), ("(by_ - ay)", f"({BOX[3]} - ay)")))}) as t0,
    least(1.0::double, {", ".join(f"case when {p} > 0 then {q} / {p} end" for p, q in (("(ax - bx)", f"(ax - ({BOX[0]}))"), ("(bx - ax)", f"({BOX[2]} - ax)"), ("(ay - by_)", f"(ay - {BOX[1]})"), ("(by_ - ay)", f"({BOX[3]} - ay)")))}) as t1
  from c
),
k as (select *, case when t0 = 0 and lag(t1) over w = 1 and lag(n) over w = n - 1 then 0 else 1 end as new from t where t0 < t1 window w as (partition by o_custkey, copy order by n)),
q as (select *, sum(new) over (partition by o_custkey, copy order by n rows unbounded preceding) as part from k)
select o_custkey, copy, part::integer as part, (count(*) + 1)::integer as points, round(sum(sqrt(pow((bx - ax) * (t1 - t0), 2) + pow((by_ - ay) * (t1 - t0), 2))), 6) as length,
  round(max(greatest(aw + t0 * (bw - aw), aw + t1 * (bw - aw))), 4) as worth
from q group by o_custkey, copy, part""",
)
def clipped_lines(spark, d):
    """Orders of a customer as a line round the world: its parts inside a box, their lengths in degrees and greatest worth."""
    o = F.col("o_orderkey")
    v = table(spark, d, "orders").select("o_custkey", "o_orderkey", (o * 53 % 3600 / 10.0 - 180).alias("x"), (o * 29 % 1400 / 10.0 - 60).alias("y"), F.col("o_totalprice").alias("worth"))
    p = features.clipped_parts(features.unwrapped(v, ["o_custkey"], "o_orderkey"), ["o_custkey"], "o_orderkey", BOX, ["worth"])
    steps = F.zip_with("points", F.slice("points", F.lit(2), F.size("points") - 1), lambda a, b: F.coalesce(F.hypot(b["x"] - a["x"], b["y"] - a["y"]), F.lit(0.0)))
    length = F.aggregate(steps, F.lit(0.0), lambda s, q: s + q)
    return p.select("o_custkey", "copy", "part", F.size("points").alias("points"), F.round(length, 6).alias("length"), F.round(F.array_max(F.transform("points", lambda q: q["worth"])), 4).alias("worth"))
