"""Queries over orders, lines, customers, suppliers and parts as validity intervals, observations and reference lists."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as Geo
from ..functions import scalars as S
from ..operators import lookup as L
from ..operators import ordered as O
from .registry import register, table

_SPANS = "select o_orderkey, o_custkey, o_orderdate as a, o_orderdate + to_days((o_orderkey % 9)::integer) as b from orders"


def spans(spark, d):
    days = F.expr("make_dt_interval(cast(o_orderkey % 9 as int))")
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + days).alias("b"))


@register("interval_join_by_key", f"with s as ({_SPANS}) select l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderkey from lineitem join s on s.o_orderkey % 100 = l_suppkey % 100 and l_shipdate >= a and l_shipdate < b")
def interval_join_by_key(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", (F.col("l_suppkey") % 100).alias("k"))
    s = spans(spark, d).withColumn("k", F.col("o_orderkey") % 100)
    return L.interval_pairs(lines, s, "l_shipdate", "a", "b", "o_orderkey", keys=["k"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderkey")


@register("interval_join_counts", f"with s as ({_SPANS}) select l_orderkey, count(*) as n from lineitem join s on l_shipdate >= a and l_shipdate < b and date_diff('day', a, l_shipdate) < 3 group by l_orderkey")
@register("interval_join_counts_all")
def interval_join_counts(spark, d):
    """Live intervals that are less than three days old at the time; equal moments and equal intervals are joined once."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_shipdate").agg(F.count("*").alias("lines"))
    s = spans(spark, d).groupBy("a", "b").agg(F.count("*").alias("spans"))
    hits = L.interval_join(lines.select("l_shipdate").distinct(), s, "l_shipdate", "a", "b", bucket_seconds=3 * 86_400)
    live = hits.where(F.datediff("l_shipdate", "a") < 3).groupBy("l_shipdate").agg(F.sum("spans").alias("live"))
    return lines.join(live, "l_shipdate").groupBy("l_orderkey").agg(F.sum(F.col("lines") * F.col("live")).alias("n"))


@register(
    "union_of_intervals",
    f"""with s as ({_SPANS}), m as (select *, max(b) over (partition by o_custkey order by a, b rows between unbounded preceding and 1 preceding) as pb from s where b > a),
    g as (select *, sum(case when pb >= a then 0 else 1 end) over (partition by o_custkey order by a, b rows unbounded preceding) as k from m),
    i as (select o_custkey, k, min(a) as a, max(b) as b from g group by all) select o_custkey, count(*) as windows, sum(date_diff('day', a, b))::bigint as days from i group by o_custkey""",
)
def union_of_intervals(spark, d):
    m = O.merged_intervals(spans(spark, d), ["o_custkey"], "a", "b")
    return m.groupBy("o_custkey").agg(F.count("*").alias("windows"), F.sum(F.datediff("b", "a")).alias("days"))


@register(
    "window_portions",
    """with w as (select o_custkey, min(o_orderdate) as a, max(o_orderdate) + interval 5 day as b from orders group by o_custkey),
    d as (select distinct o.o_custkey, o.o_orderdate as day, w.a, w.b from orders o join w using (o_custkey)),
    p as (select *, lead(day) over (partition by o_custkey order by day) as nx from d)
    select o_custkey, day, date_diff('day', greatest(a, day), least(b, coalesce(nx, b)))::bigint as days from p""",
)
def window_portions(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.col("o_orderdate").alias("day"))
    w = Window.partitionBy("o_custkey")
    ends = o.withColumn("a", F.min("day").over(w)).withColumn("b", F.max("day").over(w) + F.expr("interval 5 days")).distinct()
    p = ends.withColumn("nx", F.lead("day").over(w.orderBy("day")))
    return p.select("o_custkey", "day", F.datediff(F.least("b", F.coalesce("nx", "b")), F.greatest("a", "day")).cast("long").alias("days"))


_BOXES = [("low", 0, 5, -1000, 3000), ("middle", 3, 15, 0, 6000), ("high", 0, 25, 5000, 9000)]


@register("first_box_half_open", "select c_custkey, case " + " ".join(f"when c_nationkey >= {y0} and c_nationkey < {y1} and c_acctbal >= {x0} and c_acctbal < {x1} then '{n}'" for n, y0, y1, x0, x1 in _BOXES) + " else 'near ' || floor(c_acctbal + 0.5)::bigint end as area from customer")
def first_box_half_open(spark, d):
    near = F.concat(F.lit("near "), S.half_up(F.col("c_acctbal")).cast("string"))
    return table(spark, d, "customer").select("c_custkey", L.first_box(F.col("c_acctbal"), F.col("c_nationkey"), _BOXES, near).alias("area"))


@register("first_box_inclusive", "select c_custkey, case " + " ".join(f"when c_nationkey between {y0} and {y1} and c_acctbal between {x0} and {x1} then '{n}'" for n, y0, y1, x0, x1 in _BOXES) + " else 'other' end as area from customer")
def first_box_inclusive(spark, d):
    return table(spark, d, "customer").select("c_custkey", L.first_box(F.col("c_acctbal"), F.col("c_nationkey"), _BOXES, F.lit("other"), inclusive=True).alias("area"))


@register("customers_without_orders", "select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_totalprice > 200000)")
def customers_without_orders(spark, d):
    return L.missing(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@register("customers_with_orders", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')")
def customers_with_orders(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "left_semi")


@register(
    "compare_models",
    """with a as (select cast(o_orderdate as date) as date, floor(sum(o_totalprice))::bigint as x from orders where o_orderstatus = 'F' group by 1), b as (select cast(o_orderdate as date) as date, floor(sum(o_totalprice))::bigint as y from orders where o_orderstatus = 'O' group by 1)
    select date, x - y as difference, abs(x - y) < 200000 as agree from a join b using (date)""",
)
def compare_models(spark, d):
    """The sums are the SQL's, of doubles: rows are added in the order of the table, so that no split of the files changes them."""
    o = table(spark, d, "orders").where("o_orderdate is not null and o_orderstatus in ('F', 'O')")
    placed = o.select(F.to_date("o_orderdate").alias("date"), "o_orderstatus", "o_totalprice", F.struct("_metadata.file_path", "_metadata.row_index").alias("at"))
    by = Window.partitionBy("date", "o_orderstatus").orderBy("at")
    upto = placed.withColumn("sum", F.sum("o_totalprice").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sums = upto.groupBy("date", "o_orderstatus").agg(F.floor(F.max_by("sum", "at")).cast("long").alias("sum"))
    total = lambda s, n: sums.where(F.col("o_orderstatus") == s).select("date", F.col("sum").alias(n))
    return total("F", "x").join(total("O", "y"), "date").select("date", (F.col("x") - F.col("y")).alias("difference"), (F.abs(F.col("x") - F.col("y")) < 200000).alias("agree"))


@register(
    "dimension_spine",
    """select n.n_name, s.status, count(o.o_orderkey) as n from nation n cross join (select unnest(['F', 'O', 'P']) as status) s left join customer c on c.c_nationkey = n.n_nationkey
    left join orders o on o.o_custkey = c.c_custkey and o.o_orderstatus = s.status group by all""",
)
def dimension_spine(spark, d):
    spine = table(spark, d, "nation").withColumn("status", F.explode(F.array(F.lit("F"), F.lit("O"), F.lit("P"))))
    counts = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "o_orderstatus").agg(F.count("*").alias("n"))
    left = spine.join(counts, (F.col("n_nationkey") == F.col("c_nationkey")) & (F.col("status") == F.col("o_orderstatus")), "left")
    return left.select("n_name", "status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@register("pivot_by_status", "select c_nationkey, count(*) filter (o_orderstatus = 'F') as f, count(*) filter (o_orderstatus = 'O') as o, count(*) filter (o_orderstatus = 'P') as p from orders join customer on o_custkey = c_custkey group by c_nationkey")
def pivot_by_status(spark, d):
    both = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    p = both.groupBy("c_nationkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c.lower())
    return p.select("c_nationkey", zero("F"), zero("O"), zero("P"))


@register("names_not_taken", "select p_partkey from part p where not exists (select 1 from supplier s where upper(s.s_name) = upper(p.p_name))")
def names_not_taken(spark, d):
    s = table(spark, d, "supplier").select(F.upper("s_name").alias("u"))
    p = table(spark, d, "part").withColumn("u", F.upper("p_name"))
    return p.join(s, "u", "left_anti").select("p_partkey")


@register(
    "alias_lookup",
    "select l_orderkey, l_linenumber, l_partkey, coalesce(a.s_name, b.s_name, 'unknown') as name from lineitem left join supplier a on a.s_suppkey = l_partkey left join supplier b on b.s_suppkey = l_partkey % 150",
)
def alias_lookup(spark, d):
    s = table(spark, d, "supplier")
    a, b = s.select(F.col("s_suppkey").alias("l_partkey"), F.col("s_name").alias("by_id")), s.select(F.col("s_suppkey").alias("alias"), F.col("s_name").alias("by_alias"))
    lines = table(spark, d, "lineitem").withColumn("alias", F.col("l_partkey") % 150)
    return lines.join(a, "l_partkey", "left").join(b, "alias", "left").select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce("by_id", "by_alias", F.lit("unknown")).alias("name"))


@register(
    "ranked_candidates",
    """with c as (select p_partkey, p_brand as key, 20 + p_size % 3 as rank from part union all select p_partkey, p_type, 10 + p_size % 3 from part union all select p_partkey, p_name, p_size % 3 from part)
    select key, p_partkey, rank from (select *, row_number() over (partition by key order by rank desc, p_partkey) as r from c) where r = 1""",
)
def ranked_candidates(spark, d):
    p = table(spark, d, "part")
    of = lambda c, base: p.select("p_partkey", F.col(c).alias("key"), (base + F.col("p_size") % 3).alias("rank"))
    every = of("p_brand", 20).unionByName(of("p_type", 10)).unionByName(of("p_name", 0))
    return O.first_per(every, ["key"], [F.desc("rank"), F.col("p_partkey")])


@register(
    "coalesced_resolution",
    """with l as (select o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) as p from orders where o_orderstatus = 'P' group by o_custkey),
    m as (select o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) as p from orders where o_orderstatus = 'F' group by o_custkey)
    select c_custkey, coalesce(l.p, m.p, c_mktsegment) as resolved from customer left join l on l.o_custkey = c_custkey left join m on m.o_custkey = c_custkey""",
)
def coalesced_resolution(spark, d):
    def first(status, name):
        o = table(spark, d, "orders").where(F.col("o_orderstatus") == status)
        return o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("m")).select("c_custkey", F.col("m.o_orderpriority").alias(name))

    c = table(spark, d, "customer").join(first("P", "a"), "c_custkey", "left").join(first("F", "b"), "c_custkey", "left")
    return c.select("c_custkey", F.coalesce("a", "b", "c_mktsegment").alias("resolved"))


_LAT = "(s_suppkey % 60)::double"
_LON = "(s_suppkey * 7 % 90)::double"


@register(
    "nearest_within_400_km",
    """with q as (select n_nationkey, (n_nationkey * 3 % 60)::double as la, (n_nationkey * 11 % 90)::double as lo from nation),
    s as (select s_suppkey, (s_suppkey % 60)::double as la, (s_suppkey * 7 % 90)::double as lo from supplier),
    d as (select q.n_nationkey, s.s_suppkey, 6371.0 * acos(least(1.0, sin(radians(q.la)) * sin(radians(s.la)) + cos(radians(q.la)) * cos(radians(s.la)) * cos(radians(s.lo - q.lo)))) as km from q, s)
    select n_nationkey, s_suppkey, floor(km + 0.5)::bigint as km from (select *, row_number() over (partition by n_nationkey order by floor(km * 1000), s_suppkey) as r from d) where r = 1 and km <= 400""",
)
def nearest_within_400_km(spark, d):
    """Suppliers as a short reference list (broadcast is Spark's choice by its size), one nearest for each place."""
    q = table(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") * 3 % 60).cast("double").alias("la"), (F.col("n_nationkey") * 11 % 90).cast("double").alias("lo"))
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 60).cast("double").alias("sla"), (F.col("s_suppkey") * 7 % 90).cast("double").alias("slo"))
    # 400 km are at most 3.6 degrees of latitude: bands of four degrees and their neighbours hold every candidate.
    near = q.withColumn("band", F.explode(F.sequence(F.floor(F.col("la") / 4) - 1, F.floor(F.col("la") / 4) + 1))).join(s.withColumn("band", F.floor(F.col("sla") / 4)), "band")
    km = near.withColumn("d", S.great_circle_km(F.col("la"), F.col("lo"), F.col("sla"), F.col("slo")))
    best = O.first_per(km, ["n_nationkey"], [F.floor(F.col("d") * 1000), F.col("s_suppkey")])
    return best.where("d <= 400").select("n_nationkey", "s_suppkey", S.half_up(F.col("d")).cast("long").alias("km"))


@register(
    "first_available_candidate",
    """with c as (select o_custkey, k as pref, o_custkey * 4 + k as key from (select distinct o_custkey from orders), (select unnest(range(4)) as k))
    select o_custkey, min(pref)::integer as pref from c where key in (select o_orderkey from orders where o_orderstatus <> 'F') group by o_custkey""",
)
def first_available_candidate(spark, d):
    o = table(spark, d, "orders")
    c = o.select("o_custkey").distinct().withColumn("pref", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn("o_orderkey", F.col("o_custkey") * 4 + F.col("pref"))
    return c.join(o.where("o_orderstatus <> 'F'").select("o_orderkey"), "o_orderkey", "left_semi").groupBy("o_custkey").agg(F.min("pref").alias("pref"))


@register(
    "versions_by_name",
    """select cast(o_orderdate as date) as date, o_orderpriority as name, list_sort(list(distinct o_orderstatus)) as areas, count(*) as versions, max(o_orderkey) as newest from orders group by all""",
)
def versions_by_name(spark, d):
    g = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("name"))
    return g.agg(F.array_sort(F.collect_set("o_orderstatus")).alias("areas"), F.count("*").alias("versions"), F.max("o_orderkey").alias("newest"))


_RING = [(0.0, 0.0), (20.0, 2000.0), (24.0, 9000.0), (10.0, 6000.0), (3.0, 9500.0)]


def _ring_sql() -> str:
    parts = []
    for k, (ax, ay) in enumerate(_RING):
        bx, by = _RING[(k + 1) % len(_RING)]
        parts.append(f"case when ({ay} > c_acctbal) <> ({by} > c_acctbal) and c_nationkey < ({bx} - {ax}) * (c_acctbal - {ay}) / ({by} - {ay}) + {ax} then 1 else 0 end")
    return f"select c_custkey, ({' + '.join(parts)}) % 2 = 1 as inside from customer"


@register("point_in_ring", _ring_sql())
def point_in_ring(spark, d):
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in _RING])
    return table(spark, d, "customer").select("c_custkey", Geo.in_ring(F.col("c_nationkey").cast("double"), F.col("c_acctbal"), ring).alias("inside"))


@register(
    "ring_measures",
    """with p as (select c_nationkey, c_custkey, c_custkey % 100 / 10.0 as x, c_acctbal / 1000 as y, row_number() over (partition by c_nationkey order by c_custkey) as k, count(*) over (partition by c_nationkey) as n from customer),
    e as (select a.c_nationkey, a.x * b.y - b.x * a.y as t, a.x, a.y from p a join p b on b.c_nationkey = a.c_nationkey and b.k = a.k % a.n + 1)
    select c_nationkey, round(abs(sum(t)) / 2 * 111.32 * 111.32 * cos(radians(50)), 3) as km2, round(min(x), 6) as w, round(max(y), 6) as n, round(avg(x), 6) as mx from e group by c_nationkey""",
)
def ring_measures(spark, d):
    """Each edge comes from a vertex and the next one (after the last the first), so that no ring is held in one array."""
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    p = table(spark, d, "customer").select("c_nationkey", "c_custkey", (F.col("c_custkey") % 100 / 10.0).alias("x"), (F.col("c_acctbal") / 1000).alias("y"))
    e = p.withColumn("nx", F.coalesce(F.lead("x").over(w), F.first("x").over(w))).withColumn("ny", F.coalesce(F.lead("y").over(w), F.first("y").over(w)))
    area = F.abs(F.sum(F.col("x") * F.col("ny") - F.col("nx") * F.col("y"))) / 2 * 111.32 * 111.32 * F.cos(F.radians(F.lit(50.0)))
    return e.groupBy("c_nationkey").agg(F.round(area, 3).alias("km2"), F.round(F.min("x"), 6).alias("w"), F.round(F.max("y"), 6).alias("n"), F.round(F.avg("x"), 6).alias("mx"))


@register("path_length", """with p as (select o_custkey, o_orderkey, (o_orderkey % 170) / 10.0 as x, (o_orderkey % 130) / 10.0 as y, lag((o_orderkey % 170) / 10.0) over w as px, lag((o_orderkey % 130) / 10.0) over w as py from orders window w as (partition by o_custkey order by o_orderkey))
    select o_custkey, round(coalesce(sum(111.32 * sqrt(((x - px) * cos(radians((y + py) / 2))) ^ 2 + (y - py) ^ 2)), 0), 3) as km from p group by o_custkey""")
def path_length(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    p = table(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 170 / 10.0).alias("x"), (F.col("o_orderkey") % 130 / 10.0).alias("y"))
    p = p.withColumn("px", F.lag("x").over(w)).withColumn("py", F.lag("y").over(w))
    step = 111.32 * F.sqrt(F.pow((F.col("x") - F.col("px")) * F.cos(F.radians((F.col("y") + F.col("py")) / 2)), F.lit(2)) + F.pow(F.col("y") - F.col("py"), F.lit(2)))
    return p.groupBy("o_custkey").agg(F.round(F.coalesce(F.sum(step), F.lit(0.0)), 3).alias("km"))


@register("flag_pricing", "select l_returnflag, l_linestatus, sum(l_quantity)::bigint as sum_qty, count(*) as n, round(avg(l_discount), 6) as avg_disc from lineitem where l_shipdate <= timestamp '1998-09-02' group by all")
def flag_pricing(spark, d):
    g = table(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'").groupBy("l_returnflag", "l_linestatus")
    return g.agg(F.sum("l_quantity").cast("long").alias("sum_qty"), F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("avg_disc"))


@register("region_rollup", "select r_name, n_name, count(*) as n, sum(o_totalprice::decimal(18,2))::decimal(28,2) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by rollup (r_name, n_name)")
def region_rollup(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.rollup("r_name", "n_name").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
