"""Queries over text products that are made from rows: inventories, sections, trailing fields, contract checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ordered as O
from ..sources import sinks
from ..sources import tables as T
from ..streaming import state
from .registry import register, table

_VARS = "['UGRD', 'VGRD', 'HGT', 'TMP']"
_INV = f"""select user_id % 20 as file, event_id, sum(1 + event_id % 900) over (partition by user_id % 20 order by event_id rows unbounded preceding) - (1 + event_id % 900) as start,
    {_VARS}[(event_id % 4 + 1)::integer] as var, (250 + 50 * (event_id % 3)) || ' mb' as level from events"""


def lines(spark, d):
    """Inventory lines of 20 files, whose messages have 1 to 900 bytes."""
    from pyspark.sql.window import Window

    e = table(spark, d, "events").withColumn("file", (F.col("user_id") % 20).cast("string"))
    size = 1 + F.col("event_id") % 900
    start = F.sum(size).over(Window.partitionBy("file").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size
    var = F.get(F.array(*map(F.lit, ["UGRD", "VGRD", "HGT", "TMP"])), (F.col("event_id") % 4).cast("int"))
    line = F.concat_ws(":", F.col("event_id").cast("string"), start.cast("string"), F.lit("d=2026010200"), var, F.concat((250 + 50 * (F.col("event_id") % 3)).cast("string"), F.lit(" mb")), F.lit("anl"), F.lit(""))
    return e.select("file", line.alias("line"))


@register("inventory_rows", f"with i as ({_INV}) select file::varchar as file, start::bigint as start, (lead(start) over (partition by file order by start) - start)::bigint as length, var, level from i")
def inventory_rows(spark, d):
    return T.inventory(lines(spark, d)).select("file", "start", "length", "var", "level")


@register(
    "inventory_ranges",
    f"""with i as ({_INV}), l as (select *, lead(start) over (partition by file order by start) - start as length from i), h as (select * from l where (var = 'UGRD' or var = 'VGRD') and level <> '300 mb'),
    m as (select *, case when lag(start + length) over (partition by file order by start) = start then 0 else 1 end as n from h), g as (select *, sum(n) over (partition by file order by start rows unbounded preceding) as k from m)
    select file::varchar as file, min(start)::bigint as start, case when not bool_or(length is null) then max(start + length)::bigint - 1 end as "end", count(*) as messages from g group by file, k""",
)
def inventory_ranges(spark, d):
    wanted = spark.createDataFrame([(v, x) for v in ("UGRD", "VGRD") for x in ("250 mb", "350 mb")], "var string, level string")
    return T.wanted_ranges(T.inventory(lines(spark, d)), wanted)


@register("inventory_first", f"with i as ({_INV}) select file::varchar as file, min(start)::bigint as start from i where var = 'HGT' and level = '300 mb' group by file")
def inventory_first(spark, d):
    return T.inventory(lines(spark, d)).where("var = 'HGT' and level = '300 mb'").groupBy("file").agg(F.min("start").alias("start"))


@register(
    "sections_of_lines",
    """select user_id % 7 as file, event_id, last_value(case when event_type = 'signup' then value::varchar end ignore nulls) over (partition by user_id % 7 order by event_id rows unbounded preceding) as section from events
    qualify event_type <> 'signup' and section is not null""",
)
def sections_of_lines(spark, d):
    """A signup opens a section that its value names."""
    from pyspark.sql.window import Window

    e = table(spark, d, "events").withColumn("file", F.col("user_id") % 7)
    w = Window.partitionBy("file").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = e.withColumn("section", F.last(F.when(F.col("event_type") == "signup", F.col("value").cast("string")), ignorenulls=True).over(w))
    return marked.where("event_type <> 'signup' and section is not null").select("file", "event_id", "section")


@register("trailing_fields", "select event_id, user_id::varchar as who, value::varchar as amount, props || ',' || event_type || ',x' as free from events")
def trailing_fields(spark, d):
    e = table(spark, d, "events")
    line = F.concat_ws(",", F.col("user_id").cast("string"), "props", "event_type", F.lit("x"), F.col("value").cast("string"))
    got = T.trailing_fields(e.select(F.lit("f").alias("file"), F.col("event_id").alias("n"), line.alias("line")), ["who"], ["amount"], "free")
    return got.select(F.col("n").alias("event_id"), "who", "amount", "free")


@register(
    "contract_violations",
    """select 'price' as rule, o_orderkey as key from orders where not (o_totalprice < 400000) union all select 'status', o_orderkey from orders where o_orderstatus not in ('F', 'O')
    union all select 'window', o_orderkey from orders where not (o_orderdate >= timestamp '1993-01-01')""",
)
def contract_violations(spark, d):
    rules = {"price": F.col("o_totalprice") < 400000, "status": F.col("o_orderstatus").isin("F", "O"), "window": F.col("o_orderdate") >= F.lit("1993-01-01").cast("timestamp_ntz")}
    return sinks.violations(table(spark, d, "orders"), rules, F.col("o_orderkey"))


@register("layers_of_one_property", "select o_custkey from orders group by o_custkey having bool_and(o_totalprice > 20000)")
def layers_of_one_property(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.bool_and(F.col("o_totalprice") > 20000).alias("ok")).where("ok").select("o_custkey")


@register("digest_lines", "select event_type || ': ' || count(*) || ' reports, top ' || max(value)::varchar as line from events group by event_type")
def digest_lines(spark, d):
    g = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("top"))
    return g.select(F.concat("event_type", F.lit(": "), F.col("n").cast("string"), F.lit(" reports, top "), F.col("top").cast("string")).alias("line"))


_ENTRY = "select event_id, event_id * 100 as start, 50 + event_id % 40 as n, ['u', 'v', 'gh', 't'][event_id % 4 + 1] as param, ['250', '300', '850'][event_id % 3 + 1] as level, event_type from events"


@register("index_picked", f"select event_id, start, start + n - 1 as \"end\", param, level from ({_ENTRY}) where param in ('u', 'v') and level in ('250', '300') and event_type <> 'signup' and event_type <> 'view'")
def index_picked(spark, d):
    """Index lines of JSON objects by their attributes: winds at two levels. Signups are broken lines, views have no level."""
    k, kind = F.col("event_id"), F.col("event_type")
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), (k % n).cast("int"))
    entry = F.to_json(F.struct((k * 100).alias("_offset"), (50 + k % 40).alias("_length"), pick(["u", "v", "gh", "t"], 4).alias("param"), F.when(kind != "view", pick(["250", "300", "850"], 3)).alias("levelist")))
    lines = table(spark, d, "events").select("event_id", F.when(kind == "signup", F.substring(entry, 1, 20)).otherwise(entry).alias("line"))
    found = T.index_entries(lines, {"param": ("u", "v"), "levelist": ("250", "300")})
    return found.select("event_id", "start", "end", F.col("attributes")["param"].alias("param"), F.col("attributes")["levelist"].alias("level"))


@register("csv_lines", """select p_partkey as key, 'a "' || p_name || '", or ' || p_brand as text, p_size as size from part""")
def csv_lines(spark, d):
    """Quoted lines whose texts hold commas and quotes."""
    text = F.concat(F.lit('"a ""'), "p_name", F.lit('"", or '), "p_brand", F.lit('"'))
    lines = table(spark, d, "part").select(F.concat_ws(",", F.col("p_partkey").cast("string"), text, F.col("p_size").cast("string")).alias("line"))
    return T.csv_fields(lines, "key long, text string, size int").drop("line")


@register("kml_rings", "select 'area ' || s_suppkey as name, 'n ' || s_nationkey as description, 3 as points, s_suppkey * 37 % 400 - 190::double as west, s_suppkey * 11 % 120 - 50::double as south from supplier")
def kml_rings(spark, d):
    """KML documents of forty suppliers each: their names, descriptions and rings."""
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", (k * 37 % 400 - 190).alias("x"), (k * 11 % 120 - 50).alias("y"))
    at = lambda dx, dy: F.concat_ws(",", (F.col("x") + dx).cast("string"), (F.col("y") + dy).cast("string"), F.lit("0"))
    ring = F.concat_ws(" ", at(0, 0), at(2, 0), at(2, 3))
    mark = F.concat(F.lit("<Placemark><name>area "), k, F.lit("</name><description>n "), "s_nationkey", F.lit("</description><Polygon><outerBoundaryIs><LinearRing><coordinates>"), ring, F.lit("</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"))
    documents = s.groupBy(F.floor(k / 40)).agg(F.concat(F.lit("<kml><Document>"), F.array_join(F.collect_list(mark), ""), F.lit("</Document></kml>")).alias("value"))
    low = lambda c: F.array_min(F.transform("ring", lambda p: p[c]))
    return T.placemarks_of(documents).select("name", "description", F.size("ring").alias("points"), low("x").alias("west"), low("y").alias("south"))


@register(
    "producer_stamps",
    """select p_brand, substr(sha256('[{"k":"size","v":"' || p_size || '"},{"k":"type","v":"' || p_type || '"}]'), 1, 12) as stamp, count(*) as parts, count(*) filter (p_retailprice < 950) as kept
    from part group by p_brand, p_size, p_type""",
)
def producer_stamps(spark, d):
    """Parts of equal parameters have one producer's stamp; a layer whose stamp is cut short isn't taken for it."""
    p = table(spark, d, "part").withColumn("stamp", sinks.stamp_of(type=F.col("p_type"), size=F.col("p_size")))
    carried = F.when(F.col("p_retailprice") < 950, F.col("stamp")).otherwise(F.substring("stamp", 1, 11))
    return p.groupBy("p_brand", "stamp").agg(F.count("*").alias("parts"), F.count_if(sinks.is_stamp(carried)).alias("kept"))


@register(
    "frames_given_up",
    """with a as (select user_id % 97 || '|' || ts::date as key, ts as t, event_type <> 'error' and event_type <> 'signup' as ok from events), l as (select key, max(t) filter (ok) as last_ok from a group by 1)
    select key, count(*) filter (not ok and (last_ok is null or t > last_ok)) as misses,
      case when any_value(last_ok) is not null then 'read' when count(*) filter (not ok and (last_ok is null or t > last_ok)) >= 3 then 'given up' else 'open' end as state from a join l using (key) group by key""",
)
def frames_given_up(spark, d):
    """Attempts at frames: read once, open, or given up after three misses without a success."""
    e = table(spark, d, "events")
    ok = ~F.col("event_type").isin("error", "signup")
    return state.given_up(e.select(F.concat_ws("|", (F.col("user_id") % 97).cast("string"), F.to_date("ts").cast("string")).alias("key"), F.col("ts").alias("at"), ok.alias("ok")))


@register(
    "feed_items",
    """select event_id, event_type || ' no. ' || event_id as title, 'Value ' || (value * 100)::bigint || chr(10) || 'user ' || user_id as text, 'https://example.org/' || event_id as link, case when event_type <> 'click' then date_trunc('second', ts) end as published from events""",
)
def feed_items(spark, d):
    """RSS feeds of fifty events each, read item by item; clicks have no date."""
    e = table(spark, d, "events")
    text = F.concat(F.lit("<![CDATA[<p>Value <b>"), F.round(F.col("value") * 100).cast("long"), F.lit("</b><br/>user "), F.col("user_id"), F.lit("</p>]]>"))
    date = F.when(F.col("event_type") == "click", "soon").otherwise(F.concat(F.lit("Mon, "), F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
    item = F.concat(F.lit("<item><title>"), "event_type", F.lit(" no. "), F.col("event_id"), F.lit("</title><description>"), text, F.lit("</description><link>https://example.org/"), F.col("event_id"), F.lit("</link><pubDate>"), date, F.lit("</pubDate></item>"))
    feeds = e.groupBy(F.floor(F.col("event_id") / 50).alias("feed")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("value"))
    found = T.feed_items(feeds)
    return found.select(F.regexp_extract("title", r"(\d+)$", 1).cast("long").alias("event_id"), "title", "text", "link", "published")


@register(
    "lattices",
    """with p as (select c_nationkey, floor((c_acctbal + 1000) / 80) - 60 as lat, c_custkey * 97 % 360 - 180 as lon from customer), b as (select c_nationkey, min(lat) as s, max(lat) as n, min(lon) as w, max(lon) as e from p group by 1),
    g as (select *, floor((n - s) / 2.5 + 1e-9)::integer + 1 as nlat, floor((e - w) / 2.5 + 1e-9)::integer + 1 as nlon from b)
    select g.c_nationkey, s::double as lat0, w::double as lon0, nlat, nlon, count(distinct (floor((lat - s) / 2.5 + 0.5), floor((lon - w) / 2.5 + 0.5))) as used from g join p using (c_nationkey) group by all""",
)
def lattices(spark, d):
    """The lattice of 2.5 degrees over each nation's customers, and how many of its points are the nearest of one."""
    p = table(spark, d, "customer").select("c_nationkey", (F.floor((F.col("c_acctbal") + 1000) / 80) - 60).alias("lat"), (F.col("c_custkey") * 97 % 360 - 180).alias("lon"))
    box = p.groupBy("c_nationkey").agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lon").alias("w"), F.max("lon").alias("e"))
    size = lambda lo, hi: (F.floor((F.col(hi) - F.col(lo)) / 2.5 + 1e-9) + 1).cast("int")
    grid = box.select("c_nationkey", "s", "w", size("s", "n").alias("nlat"), size("w", "e").alias("nlon"))
    near = lambda c, o: F.floor((F.col(c) - F.col(o)) / 2.5 + 0.5)
    used = p.join(grid, "c_nationkey").groupBy("c_nationkey", "s", "w", "nlat", "nlon").agg(F.count_distinct(near("lat", "s"), near("lon", "w")).alias("used"))
    return used.select("c_nationkey", F.col("s").cast("double").alias("lat0"), F.col("w").cast("double").alias("lon0"), "nlat", "nlon", "used")


_TEN = "case when n = 1 then '1 report' else n || ' reports' end"


@register(
    "report_texts",
    f"""
with e as (select *, ts::date as day from events), d as (select event_type, day, count(*) as n from e group by all),
u as (select event_type, user_id, count(*) as n, row_number() over (partition by event_type order by count(*) desc, user_id) as r, count(*) over (partition by event_type) as m from e group by event_type, user_id),
names as (select event_type, string_agg('user ' || user_id, ', ' order by r) filter (r <= 3) as named, any_value(m) as m from u group by event_type),
t as (select event_type, sum(n)::bigint as n, count(*) as days, arg_max(day, (n, -(day - date '2000-01-01'))) as top, max(n) as most, min(day) as first, max(day) as last from d group by event_type),
h as (select event_type, count(*) filter (value >= 200) as strong from e group by event_type)
select event_type, upper(event_type[1]) || event_type[2:] || ': ' || ({_TEN}) || ' on ' || case when days = 1 then '1 day' else days || ' days' end || ', most on ' || strftime(top, '%a %-d %b') || ' (' || most || ').' || chr(10)
  || 'From ' || strftime(first, '%-d %b') || ' to ' || strftime(last, '%-d %b') || ': ' || case when m > 3 then named || ' and ' || (m - 3) || ' more' else named end || '.' || chr(10)
  || case when strong = 0 then 'No strong ones.' when strong = 1 then '1 strong one.' else strong || ' strong ones.' end as text
from t join names using (event_type) join h using (event_type)""",
)
def report_texts(spark, d):
    """A report of three lines for each type: how many on how many days and the day of most, from when to when and whose, how many strong ones."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    by_day = e.groupBy("event_type", "day").agg(F.count("*").alias("n"))
    top = F.max(F.struct("n", (-F.unix_date("day")).alias("k")))
    t = by_day.groupBy("event_type").agg(F.sum("n").alias("n"), F.count("*").alias("days"), top.alias("top"), F.min("day").alias("first"), F.max("day").alias("last"))
    users = e.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    # The first three and the number of all are enough for the list: no group's users come together.
    leaders = O.first_per(users, ["event_type"], [F.desc("n"), F.col("user_id")], 3)
    named = leaders.groupBy("event_type").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "user_id"))).alias("l"))
    m = users.groupBy("event_type").agg(F.count("*").alias("m"))
    strong = e.groupBy("event_type").agg(F.count_if(F.col("value") >= 200).alias("strong"))
    r = t.join(named, "event_type").join(m, "event_type").join(strong, "event_type")
    names = F.transform("l", lambda x: F.concat(F.lit("user "), x["user_id"].cast("string")))
    whose = F.when(F.col("m") > 3, F.concat(F.array_join(names, ", "), F.lit(" and "), (F.col("m") - 3).cast("string"), F.lit(" more"))).otherwise(F.array_join(names, ", "))
    day = lambda c, form: F.date_format(c, form)
    best = F.date_from_unix_date((-F.col("top.k")).cast("int"))
    first = F.concat(F.initcap("event_type"), F.lit(": "), X.counted(F.col("n"), "report", "reports"), F.lit(" on "), X.counted(F.col("days"), "day", "days"), F.lit(", most on "), day(best, "EEE d MMM"), F.lit(" ("), F.col("top.n").cast("string"), F.lit(")."))
    second = F.concat(F.lit("From "), day("first", "d MMM"), F.lit(" to "), day("last", "d MMM"), F.lit(": "), whose, F.lit("."))
    third = F.when(F.col("strong") == 0, "No strong ones.").when(F.col("strong") == 1, "1 strong one.").otherwise(F.concat(F.col("strong").cast("string"), F.lit(" strong ones.")))
    return r.select("event_type", F.concat_ws("\n", first, second, third).alias("text"))
