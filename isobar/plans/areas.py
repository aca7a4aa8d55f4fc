"""Queries over ``supplier`` as polygons with holes, ``customer`` as points, and fixed areas of a map."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as Geo
from ..operators import places as N
from ..operators import polygons as P
from .registry import register, table

#: Areas of the map as (name, west, south, east, north).
AREAS = [("na", -170.0, 13.0, -50.0, 72.0), ("atl", -80.0, 25.0, 40.0, 75.0), ("me", 14.0, 3.0, 82.0, 47.0)]
#: Corners of a polygon as shares of its two half widths, its hole at 0.4 of them.
_CORNERS = [(-1.0, -0.5), (0.5, -1.0), (1.0, 0.5), (-0.5, 1.0)]
_HOLE = 0.4
_SHAPE = "select s_suppkey, s_suppkey % 24 // 8 as day, s_suppkey % 8 as sample, s_nationkey % 2 as kind, s_suppkey * 37 % 400 - 190.3 as cx, s_suppkey * 11 % 120 - 50.7 as cy, 4.0 + s_suppkey % 13 as a, 3.0 + s_suppkey % 7 as b from supplier"
_GRID = {"x0": -180.0, "y0": -60.0, "step": 5.0, "nx": 72, "ny": 28}


def shapes(spark, d):
    """Suppliers as polygons: ``rings`` in doubles, ``exact`` in decimals as the SQL has them, for tests of what lies inside."""
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select(
        "s_suppkey", F.floor(k % 24 / 8).cast("int").alias("day"), (k % 8).cast("int").alias("sample"), (F.col("s_nationkey") % 2).cast("int").alias("kind"),
        (k * 37 % 400 - 190.3).alias("cx"), (k * 11 % 120 - 50.7).alias("cy"), (4.0 + k % 13).alias("a"), (3.0 + k % 7).alias("b"),
    )
    corner = lambda x, y, f: F.struct((F.col("cx") + F.col("a") * (x * f)).alias("x"), (F.col("cy") + F.col("b") * (y * f)).alias("y"))
    dec = lambda v: F.lit(f"{v:.1f}").cast("decimal(2,1)")
    digits = lambda v: v.cast("decimal(18,0)")
    cx, cy, a, b = digits(k * 37 % 400) - F.lit("190.3").cast("decimal(4,1)"), digits(k * 11 % 120) - F.lit("50.7").cast("decimal(3,1)"), digits(4 + k % 13), digits(3 + k % 7)
    placed = lambda x, y, f: F.struct((cx + a * dec(x * f)).cast("decimal(9,2)").alias("x"), (cy + b * dec(y * f)).cast("decimal(9,2)").alias("y"))
    rings = lambda at: F.array(*(F.array(*(at(x, y, f) for x, y in _CORNERS)) for f in (1.0, _HOLE)))
    return s.withColumn("rings", rings(corner)).withColumn("exact", rings(placed))


def _ring_sql(x: str, y: str, f: float, turn: str = "0") -> str:
    """Whether (x, y) lies in the ring of scale f, by counting crossings."""
    parts = []
    for k, (ax, ay) in enumerate(_CORNERS):
        bx, by = _CORNERS[(k + 1) % len(_CORNERS)]
        x1, y1, x2, y2 = f"(cx + a * {ax * f} + {turn})", f"(cy + b * {ay * f})", f"(cx + a * {bx * f} + {turn})", f"(cy + b * {by * f})"
        parts.append(f"(case when ({y1} > {y}) <> ({y2} > {y}) and {x} < ({x2} - {x1}) * ({y} - {y1}) / ({y2} - {y1}) + {x1} then 1 else 0 end)")
    return f"(({' + '.join(parts)}) % 2 = 1)"


def _inside_sql(x: str, y: str, turn: str = "0") -> str:
    return f"({_ring_sql(x, y, 1.0, turn)} and not {_ring_sql(x, y, _HOLE, turn)})"


_POINT = "select c_custkey, (c_custkey * 97 % 3600) / 10.0 - 180 as x, (c_acctbal + 1000) / 80 - 60 as y from customer"


@register("points_in_polygons", f"with s as ({_SHAPE}), p as ({_POINT}) select c_custkey, s_suppkey from p join s on abs(x - cx) <= a and abs(y - cy) <= b and {_inside_sql('x', 'y')}")
def points_in_polygons(spark, d):
    p = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * 97 % 3600 / 10.0 - 180).alias("x"), ((F.col("c_acctbal") + 1000) / 80 - 60).alias("y"))
    return P.points_in(p, shapes(spark, d).select("s_suppkey", "exact"), rings="exact", cell=10.0).select("c_custkey", "s_suppkey")


def _turned(inner: str) -> str:
    return f"select * from ({inner}), (select unnest([0, -360]) as turn) where turn = 0 or cx + a > 180"


@register(
    "polygon_cell_percentages",
    f"""with s as ({_turned(_SHAPE)}), g as (select j.j, i.i, {_GRID["x0"]} + (i.i + 0.5) * 5 as x, {_GRID["y0"]} + (j.j + 0.5) * 5 as y from (select unnest(range({_GRID["ny"]})) as j) j, (select unnest(range({_GRID["nx"]})) as i) i),
    h as (select distinct day, sample, kind, j, i from s join g on {_inside_sql("x", "y", "turn")}), n as (select day, count(distinct sample) as n from s group by day)
    select day::integer as day, kind::integer as kind, j::integer as j, i::integer as i, floor(100.0 * count(*) / any_value(n) + 0.5)::integer as percent from h join n using (day) group by day, kind, j, i""",
)
def polygon_cell_percentages(spark, d):
    s = shapes(spark, d)
    return P.cell_percentages(s, s, day="day", sample="sample", kind="kind", rings="exact", **_GRID)


def _apart_sql(w: str, s: float, e: str, n: float) -> str:
    """Whether a convex ring and a box are apart: on one of their sides' normals their shadows don't meet."""
    xs, ys = [f"(cx + a * {x})" for x, _ in _CORNERS], [f"(cy + b * {y})" for _, y in _CORNERS]
    ends = lambda v: (f"least({', '.join(v)})", f"greatest({', '.join(v)})")
    (x0, x1), (y0, y1) = ends(xs), ends(ys)
    tests = [f"{x1} <= {w}", f"{x0} >= {e}", f"{y1} <= {s}", f"{y0} >= {n}"]
    for k in range(4):
        m = (k + 1) % 4
        nx, ny = f"({ys[m]} - {ys[k]})", f"({xs[k]} - {xs[m]})"
        own = ends([f"({x} * {nx} + {y} * {ny})" for x, y in zip(xs, ys, strict=True)])
        box = ends([f"({x} * {nx} + {y} * {ny})" for x in (w, e) for y in (s, n)])
        tests += [f"{own[1]} <= {box[0]}", f"{own[0]} >= {box[1]}"]
    return "(" + " or ".join(tests) + ")"


def _touched_sql() -> str:
    each = [f"case when not {' or not '.join(_apart_sql(f'({w + t})', s, f'({e + t})', n) for t in (0, -360, 360))} then '{name}' end" for name, w, s, e, n in AREAS]
    return f"select s_suppkey, cx, cy, list_filter([{', '.join(each)}], lambda v: v is not null) as areas from ({_SHAPE})"


@register("touched_areas", f"select s_suppkey, array_to_string(areas, ',') as areas from ({_touched_sql()})")
def touched_areas(spark, d):
    return shapes(spark, d).select("s_suppkey", F.array_join(P.touched(F.get("rings", F.lit(0)), AREAS), ",").alias("areas"))


@register(
    "home_areas",
    f"""with t as ({_touched_sql()}), h as (select *, {", ".join(f"(list_contains(areas, '{name}') and cx >= {w} and cx <= {e} and cy >= {s} and cy <= {n}) as in_{name}" for name, w, s, e, n in AREAS)} from t)
    select s_suppkey, case when in_atl and in_na then case when cx < -60 then 'na' else 'atl' end when in_atl and in_me then case when cx < 30 or cy >= 40 then 'atl' else 'me' end
    when in_atl then 'atl' when in_na then 'na' when in_me then 'me' else areas[1] end as home from h""",
)
def home_areas(spark, d):
    """The touched area that holds the middle; where areas overlap, west of 60W is na, west of 30E or from 40N on atl."""
    s = shapes(spark, d).withColumn("areas", P.touched(F.get("rings", F.lit(0)), AREAS))
    x, y = F.col("cx"), F.col("cy")
    hit = {name: F.array_contains("areas", name) & x.between(w, e) & y.between(so, n) for name, w, so, e, n in AREAS}
    home = F.when(hit["atl"] & hit["na"], F.when(x < -60, "na").otherwise("atl")).when(hit["atl"] & hit["me"], F.when((x < 30) | (y >= 40), "atl").otherwise("me"))
    for name in ("atl", "na", "me"):
        home = home.when(hit[name], name)
    return s.select("s_suppkey", home.otherwise(F.get("areas", F.lit(0))).alias("home"))


@register("worst_days")
def worst_days(spark, d):
    """Per area the day of the highest index: moderate area, three times the severe one; ties go to more severe area, then the earlier day."""
    s = shapes(spark, d).withColumn("severe", F.col("kind") == 1)
    rows = s.select("day", "severe", F.explode(F.array(*(F.struct(F.lit(name).alias("area"), P.area_inside(F.get("rings", F.lit(0)), w, so, e, n).alias("km2")) for name, w, so, e, n in AREAS))).alias("r"))
    g = rows.groupBy("r.area", "day").agg(F.sum(F.when(~F.col("severe"), F.col("r.km2")).otherwise(0.0)).alias("moderate"), F.sum(F.when(F.col("severe"), F.col("r.km2")).otherwise(0.0)).alias("severe"))
    scored = g.withColumn("index", F.floor((F.col("moderate") + 3 * F.col("severe")) / 1000 + 0.5).cast("long"))
    first = F.row_number().over(Window.partitionBy("area").orderBy(F.desc("index"), F.desc("severe"), "day"))
    return scored.withColumn("r", first).where("r = 1").select("area", "day", "index", F.floor(F.col("severe") / 1000 + 0.5).cast("long").alias("severe"))


def _shoelace_sql(f: float) -> str:
    return "abs(" + " + ".join(f"((cx + a * {ax * f}) * (cy + b * {by * f}) - (cx + a * {bx * f}) * (cy + b * {ay * f}))" for (ax, ay), (bx, by) in ((_CORNERS[k], _CORNERS[(k + 1) % 4]) for k in range(4))) + ") / 2"


@register("polygon_areas", f"select s_suppkey, round((({_shoelace_sql(1.0)}) - ({_shoelace_sql(_HOLE)})) * 111.32 * 111.32 * cos(radians(cy + b * ({' + '.join(str(y) for _, y in _CORNERS)}) / 4)), 3) as km2 from ({_SHAPE})")
def polygon_areas(spark, d):
    """Square kilometres of polygons less their holes."""
    return shapes(spark, d).select("s_suppkey", F.round(Geo.polygon_km2(F.col("rings")), 3).alias("km2"))


_FEATURE = """select s_suppkey, case when s_suppkey % 3 = 0 then 'Polygon' when s_suppkey % 3 = 1 then 'MultiPolygon' else 'LineString' end as kind, s_suppkey * 37 % 400 - 190 as x, s_suppkey * 11 % 120 - 50 as y from supplier"""


@register(
    "geojson_features",
    f"""select s_suppkey, kind, case kind when 'MultiPolygon' then 2 else 1 end as rings, case kind when 'LineString' then 2 when 'Polygon' then 4 else 8 end as points, 'area ' || s_suppkey as name, x::double as west from ({_FEATURE})""",
)
def geojson_features(spark, d):
    """GeoJSON documents of forty suppliers each, read as features: their kinds, rings and properties."""
    from ..sources import tables as T

    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", (k * 37 % 400 - 190).alias("x"), (k * 11 % 120 - 50).alias("y"))
    at = lambda dx, dy: F.concat(F.lit("["), F.col("x") + dx, F.lit(","), F.col("y") + dy, F.lit("]"))
    listed = lambda *parts: F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    ring = listed(at(0, 0), at(2, 0), at(2, 2), at(0, 2))
    shape = lambda kind, text: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), text, F.lit("}"))
    geometry = F.when(k % 3 == 0, shape("Polygon", listed(ring))).when(k % 3 == 1, shape("MultiPolygon", listed(listed(ring), listed(listed(at(5, 0), at(6, 0), at(6, 1), at(5, 1)))))).otherwise(shape("LineString", listed(at(0, 0), at(1, 1))))
    one = F.concat(F.lit('{"type":"Feature","properties":{"key":"'), k, F.lit('","name":"area '), k, F.lit('"},"geometry":'), geometry, F.lit("}"))
    documents = s.groupBy(F.floor(k / 40)).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(one), ","), F.lit("]}")).alias("value"))
    f = T.features(documents)
    west = F.array_min(F.transform(F.flatten("rings"), lambda p: p["x"]))
    p = lambda name: F.get_json_object("properties", f"$.{name}")
    return f.select(p("key").cast("long").alias("s_suppkey"), "kind", F.size("rings").alias("rings"), F.size(F.flatten("rings")).alias("points"), p("name").alias("name"), west.alias("west"))


#: Categories of an outlook by their number.
LEVELS = {2: "TSTM", 3: "MRGL", 4: "SLGT", 5: "ENH", 6: "MDT", 8: "HIGH"}
_OUTLOOK = f"select *, (case s_suppkey * 5 % 7 when 5 then 8 when 6 then 0 else s_suppkey * 5 % 7 + 2 end)::integer as dn, s_suppkey % 3 as period from ({_SHAPE})"
_DN_NAME = "case dn " + " ".join(f"when {k} then '{v}'" for k, v in LEVELS.items()) + " else dn::varchar end"


@register(
    "outlook_levels",
    f"""with l as ({_OUTLOOK}), drawn as (select * from l where dn >= 2), top as (select period, max(dn) as dn from drawn group by period), t as (select d.* from drawn d join top using (period, dn)),
    area as (select period, dn, floor(sum((({_shoelace_sql(1.0)}) - ({_shoelace_sql(_HOLE)})) * 111.32 * 111.32 * cos(radians(cy + b * ({" + ".join(str(y) for _, y in _CORNERS)}) / 4))) / 1000 + 0.5)::bigint * 1000 as km2,
      floor(min(cy - b) * 10 + 0.5) / 10 as south, floor(min(cx - a) * 10 + 0.5) / 10 as west, floor(max(cy + b) * 10 + 0.5) / 10 as north, floor(max(cx + a) * 10 + 0.5) / 10 as east, count(*) as areas from t group by period, dn),
    p as ({_POINT}), held as (select period, count(distinct c_custkey) as hubs from t join p on abs(x - cx) <= a and abs(y - cy) <= b and {_inside_sql("x", "y")} group by period),
    lower as (select period, string_agg(name, ',' order by dn) as lower from (select distinct d.period, d.dn, {_DN_NAME.replace("dn", "d.dn")} as name from drawn d join top t on t.period = d.period and t.dn > d.dn) group by period)
    select period::integer as period, {_DN_NAME} as level, km2, south, west, north, east, areas, coalesce(hubs, 0) as hubs, coalesce(lower, '') as lower from area left join held using (period) left join lower using (period)""",
)
def outlook_levels(spark, d):
    """Each period's highest category: its name, area to 1,000 square kilometres, box, number of areas, customers inside, and the lower ones drawn."""
    k = F.col("s_suppkey")
    number = F.when(k * 5 % 7 == 5, 8).when(k * 5 % 7 == 6, 0).otherwise(k * 5 % 7 + 2).cast("int")
    drawn = shapes(spark, d).select("s_suppkey", "rings", "exact", number.alias("dn"), (k % 3).cast("int").alias("period")).where("dn >= 2")
    name = F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])
    named = lambda c: F.coalesce(F.try_element_at(name, F.col(c)), F.col(c).cast("string"))
    top = drawn.groupBy("period").agg(F.max("dn").alias("top"))
    t = drawn.join(F.broadcast(top), "period")  # one row for each period
    best = t.where("dn = top").withColumn("o", Geo.box(F.get("rings", F.lit(0))))
    one = lambda c: F.floor(c * 10 + 0.5) / 10
    area = best.groupBy("period", "dn").agg(
        (F.floor(F.sum(Geo.polygon_km2(F.col("rings"))) / 1000 + 0.5) * 1000).cast("long").alias("km2"), one(F.min("o.s")).alias("south"), one(F.min("o.w")).alias("west"), one(F.max("o.n")).alias("north"), one(F.max("o.e")).alias("east"),
        F.count("*").alias("areas"),
    )
    points = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * 97 % 3600 / 10.0 - 180).alias("x"), ((F.col("c_acctbal") + 1000) / 80 - 60).alias("y"))
    held = N.held_by_any(points, best.select("period", "exact"), "c_custkey", "period", rings="exact").groupBy("period").agg(F.count_distinct("c_custkey").alias("hubs"))
    lower = t.where("dn < top").groupBy("period").agg(F.array_sort(F.collect_set(F.struct("dn", named("dn").alias("n")))).alias("l"))
    out = area.join(held, "period", "left").join(lower, "period", "left")
    below = F.coalesce(F.array_join(F.transform("l", lambda x: x["n"]), ","), F.lit(""))
    return out.select("period", named("dn").alias("level"), "km2", "south", "west", "north", "east", "areas", F.coalesce("hubs", F.lit(0)).cast("long").alias("hubs"), below.alias("lower"))
