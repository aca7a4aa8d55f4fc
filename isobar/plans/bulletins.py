"""Queries over advisories, reports and messages made from rows of ``events`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import ordered as O
from .registry import register, table

_WORDS = "['NEG', 'LGT', 'LGT-MOD', 'MOD', 'MOD-SEV', 'SEV']"


@register(
    "severity_words",
    f"""with w as (select event_id, {_WORDS}[(user_id % 6 + 1)::integer] || ' AND ' || {_WORDS}[(event_id % 6 + 1)::integer] as words from events)
    select event_id, words, list_max(list_transform(regexp_extract_all(words, 'LGT|MOD|SEV'), lambda x: case x when 'LGT' then 1 when 'MOD' then 2 else 3 end))::integer as severity from w""",
)
def severity_words(spark, d):
    """The greatest intensity among the words of a report; null where none is a turbulence word."""
    names = F.array(*[F.lit(x) for x in ("NEG", "LGT", "LGT-MOD", "MOD", "MOD-SEV", "SEV")])
    w = table(spark, d, "events").select("event_id", F.concat_ws(" AND ", F.get(names, (F.col("user_id") % 6).cast("int")), F.get(names, (F.col("event_id") % 6).cast("int"))).alias("words"))
    level = F.transform(F.regexp_extract_all("words", F.lit("(LGT|MOD|SEV)"), F.lit(1)), lambda x: F.when(x == "LGT", 1).when(x == "MOD", 2).otherwise(3))
    return w.select("event_id", "words", F.array_max(level).alias("severity"))


@register("text_between_markers", r"select doc_id, trim(regexp_replace(split_part(substr(text, instr(text, '. ') + 2), chr(10), 1), '\s+', ' ', 'g')) as part from documents where instr(text, '. ') > 0")
def text_between_markers(spark, d):
    t = table(spark, d, "documents").where(F.instr("text", ". ") > 0)
    rest = F.substr(F.col("text"), F.instr("text", ". ") + 2)
    return t.select("doc_id", F.trim(F.regexp_replace(F.substring_index(rest, "\n", 1), r"\s+", " ")).alias("part"))


@register(
    "matrix_by_column",
    """with m as (select event_id, cast(ts as date) as day, [floor(value)::bigint, event_id % 9, user_id % 7] as v from events), r as (select day, u.i, m.v[u.i] as x from m, (select unnest([1, 2, 3]) as i) u)
    select day, (i - 1)::integer as col, max(x)::bigint as top, case when max(x) >= 300 then 'G2' when max(x) >= 100 then 'G1' end as category from r group by day, i""",
)
def matrix_by_column(spark, d):
    """Lines of blank-separated numbers as a matrix: the greatest value and category of each column and day."""
    line = F.concat_ws(" ", F.floor("value").cast("string"), (F.col("event_id") % 9).cast("string"), (F.col("user_id") % 7).cast("string"))
    cells = table(spark, d, "events").select(F.to_date("ts").alias("day"), F.posexplode(F.split(line, " ")).alias("col", "x"))
    g = cells.groupBy("day", "col").agg(F.max(F.col("x").cast("long")).alias("top"))
    return g.withColumn("category", F.when(F.col("top") >= 300, "G2").when(F.col("top") >= 100, "G1"))


@register("sent_times", "select o_orderkey, case when o_orderkey % 11 <> 0 then strptime(strftime(o_orderdate, '%m/%d/20%y') || ' ' || lpad((o_orderkey % 24)::varchar, 2, '0') || ':30', '%m/%d/%Y %H:%M') end as sent from orders")
def sent_times(spark, d):
    """``mm/dd/yyyy hh:mm`` as an instant; null where it is malformed."""
    good = F.concat(F.date_format("o_orderdate", "MM/dd/'20'yy"), F.lit(" "), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":30"))
    text = F.when(F.col("o_orderkey") % 11 == 0, "soon").otherwise(good)
    return table(spark, d, "orders").select("o_orderkey", F.try_to_timestamp(text, F.lit("MM/dd/yyyy HH:mm")).cast("timestamp_ntz").alias("sent"))


@register(
    "periods",
    """with p as (select o_orderkey, cast(o_orderdate as date) as d, (o_orderkey % 27 + 1)::integer as d1, (o_orderkey % 24)::integer as h1, (o_orderkey * 7 % 27 + 1)::integer as d2, (o_orderkey * 5 % 24)::integer as h2 from orders),
    i as (select o_orderkey, cast(date_trunc('month', d) as timestamp) + to_days(d1 - 1) + to_hours(h1) as a, cast(date_trunc('month', d) as timestamp) + to_days(d2 - 1) + to_hours(h2) as b from p)
    select o_orderkey, case when b > a then a end as start, case when b > a then b end as "end" from i""",
)
def periods(spark, d):
    """``dd/hhmm - dd/hhmm`` of a reference month as an interval; null unless it ends after it begins."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    k = F.col("o_orderkey")
    text = F.concat(two(k % 27 + 1), F.lit("/"), two(k % 24), F.lit("00 - "), two(k * 7 % 27 + 1), F.lit("/"), two(k * 5 % 24), F.lit("00"))
    month = F.trunc(F.to_date("o_orderdate"), "month")

    def at(first: int):
        n = lambda g: F.regexp_extract("text", r"^(\d\d)/(\d\d)(\d\d) - (\d\d)/(\d\d)(\d\d)$", g).cast("int")
        return F.timestamp_seconds(F.unix_date(F.date_add("month", n(first) - 1)) * F.lit(86_400).cast("long") + n(first + 1) * 3600 + n(first + 2) * 60).cast("timestamp_ntz")

    x = table(spark, d, "orders").select("o_orderkey", text.alias("text"), month.alias("month")).select("o_orderkey", at(1).alias("a"), at(4).alias("b"))
    ok = F.col("b") > F.col("a")
    return x.select("o_orderkey", F.when(ok, F.col("a")).alias("start"), F.when(ok, F.col("b")).alias("end"))


@register(
    "reason_from_newest_versions",
    """with v as (select user_id, event_id, case when value > 30 then props end as reason, row_number() over (partition by user_id order by event_id desc) as r from events where event_type = 'error')
    select user_id, arg_min(reason, r) filter (reason is not null) as reason, count(*) as looked_at from v where r <= 2 group by user_id""",
)
def reason_from_newest_versions(spark, d):
    """The reason of the newest of two versions that gives one."""
    v = table(spark, d, "events").where("event_type = 'error'").withColumn("reason", F.when(F.col("value") > 30, F.col("props")))
    two = O.first_per(v, ["user_id"], [F.desc("event_id")], 2)
    first = F.max(F.when(F.col("reason").isNotNull(), F.struct("event_id", "reason")))["reason"]
    return two.groupBy("user_id").agg(first.alias("reason"), F.count("*").alias("looked_at"))


@register(
    "regions_by_list_then_prefix",
    "select c_custkey, case when c_custkey in (3, 17, 400) then 'listed' when regexp_matches(c_mktsegment, '^(A|B)') then 'first' when regexp_matches(c_mktsegment, '^M') then 'middle' else 'rest' end as region from customer",
)
def regions_by_list_then_prefix(spark, d):
    seg = F.col("c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey").isin(3, 17, 400), "listed").when(seg.rlike("^(A|B)"), "first").when(seg.rlike("^M"), "middle").otherwise("rest").alias("region"))


@register(
    "hazards_counted_once",
    """with f as (select distinct on (props, user_id) user_id % 10 as region, event_type as hazard, cast(ts as date) as date, value from events order by props, user_id, event_id)
    select region, hazard, count(*) filter (value >= 5) as n, count(*) filter (value < 5) as cancelled, count(distinct date) as days from f group by all""",
)
def hazards_counted_once(spark, d):
    """Messages of one identity count once however often they were sampled; cancellations apart."""
    f = O.first_per(table(spark, d, "events"), ["props", "user_id"], [F.col("event_id")]).withColumn("date", F.to_date("ts"))
    g = f.groupBy((F.col("user_id") % 10).alias("region"), F.col("event_type").alias("hazard"))
    return g.agg(F.count_if(F.col("value") >= 5).alias("n"), F.count_if(F.col("value") < 5).alias("cancelled"), F.count_distinct("date").alias("days"))


@register("examples_per_kind", "select hazard, event_id from (select event_type as hazard, event_id, row_number() over (partition by event_type order by event_id) as r from (select event_type, min(event_id) as event_id from events group by event_type, user_id)) where r <= 8")
def examples_per_kind(spark, d):
    one = table(spark, d, "events").groupBy(F.col("event_type").alias("hazard"), "user_id").agg(F.min("event_id").alias("event_id"))
    return O.first_per(one, ["hazard"], [F.col("event_id")], 8).select("hazard", "event_id")


@register("days_complete", "select user_id, bool_and(n >= 1) and count(*) >= 25 as final from (select user_id, cast(ts as date) as d, count(*) as n from events group by all) group by user_id")
def days_complete(spark, d):
    days = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    return days.groupBy("user_id").agg((F.bool_and(F.col("n") >= 1) & (F.count("*") >= 25)).alias("final"))


@register(
    "grid_points_of_offsets",
    """select distinct floor(((s_suppkey % 60) + o.dy - 0.0) / 0.5 + 0.5)::bigint * 240 + floor(((s_suppkey * 7 % 90) + o.dx) / 0.5 + 0.5)::bigint as k from supplier,
    (select unnest([0.0, 0.4, -0.4, 0.0, 0.0]) as dy, unnest([0.0, 0.0, 0.0, 0.4, -0.4]) as dx) o""",
)
def grid_points_of_offsets(spark, d):
    """A position and four points around it as distinct grid indices."""
    offsets = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in ((0.0, 0.0), (0.4, 0.0), (-0.4, 0.0), (0.0, 0.4), (0.0, -0.4))])
    s = table(spark, d, "supplier").select((F.col("s_suppkey") % 60).alias("y"), (F.col("s_suppkey") * 7 % 90).alias("x"), F.explode(offsets).alias("o"))
    j, i = F.floor((F.col("y") + F.col("o.dy")) / 0.5 + 0.5), F.floor((F.col("x") + F.col("o.dx")) / 0.5 + 0.5)
    return s.select((j * 240 + i).alias("k")).distinct()


@register(
    "tracks_by_direction",
    """with c as (select cast(o_orderdate as date) as day, case when o_orderkey % 2 = 0 then 'west' else 'east' end as dir, arg_max(o_orderkey, (o_totalprice, o_orderkey)) as track from orders group by all)
    select day, max(track) filter (dir = 'west') as west, max(track) filter (dir = 'east') as east, case when count(*) < 2 then (case when bool_or(dir = 'west') then 'east' else 'west' end) end as missing from c group by day""",
)
def tracks_by_direction(spark, d):
    newest = F.max(F.struct("o_totalprice", "o_orderkey"))["o_orderkey"]
    o = table(spark, d, "orders").withColumn("dir", F.when(F.col("o_orderkey") % 2 == 0, "west").otherwise("east"))
    p = o.groupBy(F.to_date("o_orderdate").alias("day")).pivot("dir", ["west", "east"]).agg(newest)
    return p.withColumn("missing", F.when(F.col("west").isNull(), "west").when(F.col("east").isNull(), "east"))


@register("published_days", "select user_id, cast(ts as date) as day, event_type as kind, count(*) filter (cast(ts as date) between date '2024-01-05' and date '2024-01-11') as kept, count(*) filter (cast(ts as date) not between date '2024-01-05' and date '2024-01-11') as removed from events where event_type <> 'signup' group by all")
def published_days(spark, d):
    """The public columns and kinds only, with an audit of what the window removes."""
    e = table(spark, d, "events").where("event_type <> 'signup'").select("user_id", F.to_date("ts").alias("day"), F.col("event_type").alias("kind"))
    inside = F.col("day").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-11").cast("date"))
    return e.groupBy("user_id", "day", "kind").agg(F.count_if(inside).alias("kept"), F.count_if(~inside).alias("removed"))


@register("token_index", "select o_orderkey, list_position(string_split(o_orderpriority || ' ' || o_orderstatus || ' AFP', ' '), o_orderstatus)::integer - 1 as at from orders")
def token_index(spark, d):
    """Where an element's code stands among its words, in place of the code."""
    words = F.split(F.concat_ws(" ", "o_orderpriority", "o_orderstatus", F.lit("AFP")), " ")
    return table(spark, d, "orders").select("o_orderkey", (F.array_position(words, F.col("o_orderstatus")) - 1).cast("int").alias("at"))


@register("running_gap", "select user_id, event_id, date_diff('second', lag(ts) over (partition by user_id order by ts, event_id), ts) >= 7200 as gap from events where event_type = 'view'")
def running_gap(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    s = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    return table(spark, d, "events").where("event_type = 'view'").withColumn("before", F.lag("ts").over(w)).select("user_id", "event_id", (s("ts") - s("before") >= 7200).alias("gap"))
