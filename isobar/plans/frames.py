"""Queries over ``events``: each error marks a cell (row, column) as lit in its hour; see README for the stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import aggregates as A
from ..operators import lookup as L
from ..operators import ordered as O
from .registry import register, table

#: Named areas over (column, row), half-open; the first that holds a cell wins.
BOXES = [("south west", 0, 5, 0, 3), ("south", 0, 5, 0, 8), ("core", 3, 8, 2, 6), ("north", 5, 10, 0, 6), ("east", 0, 10, 6, 10)]
_CELL = "(user_id % 10) * 12 + least(floor(value / 50), 11)"
_LIT = f"select cast(ts as date) as date, hour(ts) as hour, cast({_CELL} as bigint) as cell from events where event_type = 'error'"
_HOURS = f"with lit as ({_LIT}), hours as (select date, cell, count(distinct hour) as hours from lit group by date, cell)"
_AREA = "case " + " ".join(f"when cell // 12 >= {y0} and cell // 12 < {y1} and cell % 12 >= {x0} and cell % 12 < {x1} then '{n}'" for n, y0, y1, x0, x1 in BOXES) + " else 'elsewhere' end"


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("date", F.to_date("ts")).withColumn("hour", F.hour("ts"))


def lit(spark: SparkSession, d: str) -> DataFrame:
    cell = F.pmod(F.col("user_id"), F.lit(10)) * 12 + F.least(F.floor(F.col("value") / 50), F.lit(11))
    return events(spark, d).where("event_type = 'error'").select("date", "hour", cell.cast("long").alias("cell"))


def named(df: DataFrame) -> DataFrame:
    return df.withColumn("area", L.first_box(F.col("cell") % 12, F.floor(F.col("cell") / 12), BOXES, F.lit("elsewhere")))


@register("hours_per_cell", f"{_HOURS} select date, cell, hours from hours")
def hours_per_cell(spark, d):
    return A.hours_per_cell(lit(spark, d), ["cell"])


@register("hours_day_stats", f"{_HOURS} select date, max(hours) as max_hours, count(*) as cells, arg_max(cell, hours * 1000 - cell) as peak_cell from hours group by date")
def hours_day_stats(spark, d):
    return A.day_stats(A.hours_per_cell(lit(spark, d), ["cell"]), "cell")


@register(
    "hours_hotspots",
    f"""{_HOURS}, named as (select *, {_AREA} as area from hours), by_day as (select area, date, sum(hours)::bigint as h from named group by area, date),
    peak as (select *, row_number() over (partition by area order by h desc, date) as r from by_day)
    select t.area, t.cell_hours, p.date as peak_date, p.h as peak_cell_hours from (select area, sum(h)::bigint as cell_hours from by_day group by area) t
    join peak p on p.area = t.area and p.r = 1 order by cell_hours desc, t.area limit 6""",
)
def hours_hotspots(spark, d):
    return A.hotspots(named(A.hours_per_cell(lit(spark, d), ["cell"])), "area")


@register("hours_week", f"{_HOURS} select cell, sum(hours)::bigint as week_hours, count(*) as days from hours group by cell")
def hours_week(spark, d):
    return A.hours_per_cell(lit(spark, d), ["cell"]).groupBy("cell").agg(F.sum("hours").alias("week_hours"), F.count("*").alias("days"))


@register(
    "missing_hours",
    """with seen as (select distinct cast(ts as date) as date, hour(ts) as hour from events where event_type = 'error'),
    spine as (select distinct cast(ts as date) as date, h.hour from events, (select unnest(range(24)) as hour) h)
    select s.date, s.hour::integer as hour from spine s anti join seen using (date, hour)""",
)
def missing_hours(spark, d):
    spine = events(spark, d).select("date").distinct().withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return L.missing(spine, lit(spark, d), ["date", "hour"])


@register(
    "frame_status",
    """with frames as (select cast(ts as date) as date, hour(ts) as hour, count(*) filter (event_type = 'error') as hit, count(*) as n from events group by 1, 2)
    select date, count(*) as samples, (24 - count(*)) as missing, count(*) filter (hit = 0) as empty from frames group by date""",
)
def frame_status(spark, d):
    frames = events(spark, d).groupBy("date", "hour").agg(F.count_if(F.col("event_type") == "error").alias("hit"))
    return frames.groupBy("date").agg(F.count("*").alias("samples"), (24 - F.count("*")).alias("missing"), F.count_if(F.col("hit") == 0).alias("empty"))


@register("frames_in_stratified_order", "select event_id, list_position([0,12,6,18,3,15,9,21,1,13,7,19,4,16,10,22,2,14,8,20,5,17,11,23], hour(ts)) - 1 as turn from events")
def frames_in_stratified_order(spark, d):
    #: Hours in the order in which they are read, spread over the day.
    order = [0, 12, 6, 18, 3, 15, 9, 21, 1, 13, 7, 19, 4, 16, 10, 22, 2, 14, 8, 20, 5, 17, 11, 23]
    return events(spark, d).select("event_id", (F.array_position(F.array(*map(F.lit, order)), F.col("hour")) - 1).cast("int").alias("turn"))


@register(
    "phenomena_by_station_day",
    """select user_id as station, cast(ts as date) as date, count(distinct hour(ts)) filter (event_type = 'error') as storm_hours,
    count(distinct hour(ts)) filter (event_type = 'view') as fog_hours, max(value) filter (event_type = 'click') as max_gust,
    min(value) filter (event_type = 'view') as min_visibility from events group by 1, 2""",
)
def phenomena_by_station_day(spark, d):
    e = events(spark, d)
    hours = e.groupBy(F.col("user_id").alias("station"), "date", "hour").agg(
        F.bool_or(F.col("event_type") == "error").alias("storm"), F.bool_or(F.col("event_type") == "view").alias("fog"),
        F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("gust"), F.min(F.when(F.col("event_type") == "view", F.col("value"))).alias("vis"),
    )
    return hours.groupBy("station", "date").agg(F.count_if("storm").alias("storm_hours"), F.count_if("fog").alias("fog_hours"), F.max("gust").alias("max_gust"), F.min("vis").alias("min_visibility"))


@register(
    "phenomena_week",
    """with d as (select user_id as station, cast(ts as date) as date, count(distinct hour(ts)) filter (event_type = 'error') as h from events group by 1, 2)
    select station, sum(h)::bigint as storm_hours, count(*) filter (h > 0) as storm_days, max(h) as worst_day from d group by station""",
)
def phenomena_week(spark, d):
    days = phenomena_by_station_day(spark, d)
    return days.groupBy("station").agg(F.sum("storm_hours").alias("storm_hours"), F.count_if(F.col("storm_hours") > 0).alias("storm_days"), F.max("storm_hours").alias("worst_day"))


@register(
    "first_seen_mode",
    """with n as (select user_id, cast(ts as date) as date, event_type, count(*) as n, min(event_id) as seen from events group by all)
    select user_id, date, event_type, n from (select *, row_number() over (partition by user_id, date order by n desc, seen) as r from n) where r = 1""",
)
def first_seen_mode(spark, d):
    return A.first_seen_mode(events(spark, d), ["user_id", "date"], "event_type", "event_id")


@register("newest_per_key", "select user_id, arg_max(event_id, (ts, event_id)) as event_id, max(ts) as ts from events group by user_id")
def newest_per_key(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.event_id", "m.ts")


@register("earliest_per_date", "select date, event_id, value from (select cast(ts as date) as date, event_id, value, row_number() over (partition by cast(ts as date) order by ts, event_id) as r from events) where r = 1")
def earliest_per_date(spark, d):
    return O.first_per(events(spark, d), ["date"], [F.col("ts"), F.col("event_id")]).select("date", "event_id", "value")


@register(
    "day_ranges",
    """with g as (select user_id, d, d - row_number() over (partition by user_id order by d)::integer as k from (select distinct user_id, cast(ts as date) as d from events where event_type = 'error'))
    select user_id, min(d) as first_day, max(d) as last_day, count(*) as n_days from g group by user_id, k""",
)
def day_ranges(spark, d):
    return O.day_ranges(events(spark, d).where("event_type = 'error'"), ["user_id"], "date")


@register("buckets_3h", "select time_bucket(interval '3 hours', ts, timestamp '2024-01-01') as bucket, event_type, count(*) as n, max(value) as top from events group by all")
def buckets_3h(spark, d):
    return table(spark, d, "events").groupBy(F.window("ts", "3 hours")["start"].alias("bucket"), "event_type").agg(F.count("*").alias("n"), F.max("value").alias("top"))


@register("buckets_hourly", "select date_trunc('hour', ts) as hour, count(*) as n, count(distinct user_id) as users from events group by 1")
def buckets_hourly(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@register(
    "sliding_windows",
    """select time_bucket(interval '1 hour', ts, timestamp '2024-01-01') - to_hours(k) as start, count(*) as n from events, (select unnest(range(3)) as k) group by 1""",
)
def sliding_windows(spark, d):
    return table(spark, d, "events").groupBy(F.window("ts", "3 hours", "1 hour")["start"].alias("start")).agg(F.count("*").alias("n"))


@register(
    "gap_sessions",
    """with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval '6 hours' then 0 else 1 end as n from events),
    s as (select user_id, ts, sum(n) over (partition by user_id order by ts rows unbounded preceding) as k from g)
    select user_id, min(ts) as session_start, max(ts) as session_end, count(*) as n from s group by user_id, k""",
)
def gap_sessions(spark, d):
    return O.gap_sessions(table(spark, d, "events"), ["user_id"], "ts", 6 * 3600)


@register(
    "duplicate_payloads",
    """with p as (select event_id, sha1(props) as hash, row_number() over (partition by sha1(props), cast(ts as date) order by ts, event_id) as r from events)
    select event_id, hash, (r > 1) as duplicate from p""",
)
def duplicate_payloads(spark, d):
    w = Window.partitionBy("hash", "date").orderBy("ts", "event_id")
    return events(spark, d).withColumn("hash", F.sha1("props")).select("event_id", "hash", (F.row_number().over(w) > 1).alias("duplicate"))


@register("rollup_two_levels", "select event_type, cast(ts as date) as date, count(*) as n, count(distinct user_id) as users from events group by rollup (event_type, cast(ts as date))")
def rollup_two_levels(spark, d):
    return events(spark, d).rollup("event_type", "date").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@register("grouping_sets", "select event_type, cast(ts as date) as date, count(*) as n from events group by grouping sets ((event_type), (cast(ts as date)), ())")
def grouping_sets(spark, d):
    e = events(spark, d)
    return e.groupingSets([[F.col("event_type")], [F.col("date")], []], F.col("event_type"), F.col("date")).agg(F.count("*").alias("n"))


@register(
    "quantile_rules",
    """with s as (select event_type, list(value order by value) as v, count(*) as n from events group by event_type)
    select event_type, v[ceil(0.95 * n)::integer] as nearest_rank, v[floor(0.5 * (n - 1) + 0.5)::integer + 1] as rounded_rank, v[least(n - 1, floor(0.9 * n))::integer + 1] as floored_rank,
    (v[(n + 1) // 2] + v[(n + 2) // 2]) / 2 as middle, v[n - 3] as fourth_highest from s""",
)
def quantile_rules(spark, d):
    at = {
        "nearest_rank": lambda n: F.ceil(0.95 * n) - 1,
        "rounded_rank": lambda n: F.floor(0.5 * (n - 1) + 0.5),
        "floored_rank": lambda n: F.least(n - 1, F.floor(0.9 * n)),
        "lower": lambda n: F.floor((n - 1) / 2),
        "upper": lambda n: F.floor(n / 2),
        "fourth_highest": lambda n: n - 4,
    }
    r = A.at_ranks(table(spark, d, "events"), ["event_type"], "value", at)
    return r.select("event_type", "nearest_rank", "rounded_rank", "floored_rank", ((F.col("lower") + F.col("upper")) / 2).alias("middle"), "fourth_highest")


@register("percentile_disc", "select event_type, quantile_disc(value, 0.95) as p95, quantile_disc(value, 0.5) as p50 from events group by event_type")
def percentile_disc(spark, d):
    return A.at_ranks(table(spark, d, "events"), ["event_type"], "value", {"p95": lambda n: F.ceil(0.95 * n) - 1, "p50": lambda n: F.ceil(0.5 * n) - 1}).drop("n")


@register(
    "archive_covers",
    """select cast(ts as date) as date, (min(ts) <= cast(ts as date)::timestamp + interval '90 minutes' and max(ts) >= cast(ts as date)::timestamp + interval '1350 minutes') as covered
    from events where event_type = 'view' group by cast(ts as date)""",
)
def archive_covers(spark, d):
    v = events(spark, d).where("event_type = 'view'").groupBy("date").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    midnight = F.col("date").cast("timestamp_ntz")
    return v.select("date", ((F.col("a") <= midnight + F.expr("interval 90 minutes")) & (F.col("b") >= midnight + F.expr("interval 1350 minutes"))).alias("covered"))


@register(
    "expected_kinds_missing",
    """with e as (select distinct user_id, k.kind from events, (select unnest(['error', 'view', 'click', 'signup', 'purchase']) as kind) k)
    select user_id, kind from e anti join (select distinct user_id, event_type as kind from events where value > 30) using (user_id, kind)""",
)
def expected_kinds_missing(spark, d):
    e = table(spark, d, "events")
    kinds = F.explode(F.array(*map(F.lit, ["error", "view", "click", "signup", "purchase"])))
    expected = e.select("user_id").distinct().select("user_id", kinds.alias("kind"))
    return L.missing(expected, e.where("value > 30").select("user_id", F.col("event_type").alias("kind")), ["user_id", "kind"])


@register("complete_users", "select user_id from events group by user_id having count(distinct event_type) = 5 and bool_and(value >= 0)")
def complete_users(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.count_distinct("event_type").alias("k"), F.bool_and(F.col("value") >= 0).alias("ok"))
    return g.where("k = 5 and ok").select("user_id")


@register("first_message_wins", "select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by event_id) as r from events) where r = 1")
def first_message_wins(spark, d):
    return O.first_per(table(spark, d, "events"), ["user_id", "event_type"], [F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@register(
    "reports_unpivoted",
    """with r as (select distinct on (ts, user_id, props) ts, user_id, value from events order by ts, user_id, props, event_id)
    select ts, user_id, kind, sev from (select ts, user_id, 'T' as kind, least(floor(value / 20), 3)::bigint as sev from r union all
    select ts, user_id, 'I' as kind, least(floor(value / 40), 3)::bigint as sev from r) where sev > 0""",
)
def reports_unpivoted(spark, d):
    r = O.first_per(table(spark, d, "events"), ["ts", "user_id", "props"], [F.col("event_id")])
    sev = lambda by: F.least(F.floor(F.col("value") / by), F.lit(3))
    wide = r.select("ts", "user_id", sev(20).cast("long").alias("T"), sev(40).cast("long").alias("I"))
    return wide.unpivot(["ts", "user_id"], ["T", "I"], "kind", "sev").where("sev > 0")


@register("json_props", "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@register(
    "day_finality",
    """with reads as (select cast(ts as date) as date, user_id % 3 as run, count(*) as n, count(distinct hour(ts)) >= 24 as final from events group by all)
    select date, run, n, final from (select *, row_number() over (partition by date order by final desc, n desc, run desc) as r from reads) where r = 1""",
)
def day_finality(spark, d):
    reads = events(spark, d).groupBy("date", (F.col("user_id") % 3).alias("run")).agg(F.count("*").alias("n"), (F.count_distinct("hour") >= 24).alias("final"))
    return O.first_per(reads, ["date"], [F.desc("final"), F.desc("n"), F.desc("run")])


@register(
    "due_gates",
    """select event_id, case when ts > timestamp '2024-01-20' then 'future' when ts + interval '330 minutes' > timestamp '2024-01-20' then 'not due' else 'due' end as status from events""",
)
def due_gates(spark, d):
    now, ts = F.lit("2024-01-20").cast("timestamp_ntz"), F.col("ts")
    return table(spark, d, "events").select("event_id", F.when(ts > now, "future").when(ts + F.expr("interval 330 minutes") > now, "not due").otherwise("due").alias("status"))


@register(
    "by_day_and_centre",
    """select coalesce(a.date, b.date) as date, coalesce(a.centre, b.centre) as centre, coalesce(stops, 0)::bigint as stops, coalesce(reroutes, 0)::bigint as reroutes, coalesce(swap, false) as swap from
    (select cast(ts as date) as date, user_id % 20 as centre, count(*) as stops from events where event_type = 'error' and value > 40 group by all) a full join
    (select cast(ts as date) as date, user_id % 20 as centre, count(distinct user_id) as reroutes, bool_or(value > 90) as swap from events where event_type = 'signup' and value > 20 group by all) b
    on a.date = b.date and a.centre = b.centre""",
)
def by_day_and_centre(spark, d):
    e = events(spark, d).withColumn("centre", F.col("user_id") % 20)
    a = e.where("event_type = 'error' and value > 40").groupBy("date", "centre").agg(F.count("*").alias("stops"))
    b = e.where("event_type = 'signup' and value > 20").groupBy("date", "centre").agg(F.count_distinct("user_id").alias("reroutes"), F.bool_or(F.col("value") > 90).alias("swap"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return a.join(b, ["date", "centre"], "full").select("date", "centre", zero("stops"), zero("reroutes"), F.coalesce("swap", F.lit(False)).alias("swap"))


@register(
    "clusters",
    """select cast(ts as date) as date, hour(ts) as hour, count(distinct user_id) as airports, max(value) as worst from events where event_type = 'error' group by all
    having count(distinct user_id) >= 3 order by airports desc, worst desc, date, hour limit 10""",
)
def clusters(spark, d):
    g = events(spark, d).where("event_type = 'error'").groupBy("date", "hour").agg(F.count_distinct("user_id").alias("airports"), F.max("value").alias("worst"))
    return g.where("airports >= 3").orderBy(F.desc("airports"), F.desc("worst"), "date", "hour").limit(10)


@register(
    "majority_convention",
    """with c as (select cast(ts as date) as date, event_type, count(*) as n from events group by all),
    m as (select event_type from (select event_type, count(*) as days from (select date, event_type from (select *, row_number() over (partition by date order by n desc, event_type) as r from c) where r = 1) group by 1) order by days desc, event_type limit 1)
    select date, event_type, (event_type = (select event_type from m)) as kept from (select *, row_number() over (partition by date order by n desc, event_type) as r from c) where r = 1""",
)
def majority_convention(spark, d):
    c = events(spark, d).groupBy("date", "event_type").agg(F.count("*").alias("n"))
    per_day = O.first_per(c, ["date"], [F.desc("n"), F.col("event_type")]).select("date", "event_type")
    best = per_day.groupBy("event_type").agg(F.count("*").alias("days")).orderBy(F.desc("days"), "event_type").limit(1).select(F.col("event_type").alias("best"))
    return per_day.join(F.broadcast(best), F.lit(True), "cross").select("date", "event_type", (F.col("event_type") == F.col("best")).alias("kept"))


@register("split_detection", "select user_id, event_id, (lag(value) over (partition by user_id order by value desc, event_id) - value) >= 4 as split from events where event_type = 'purchase'")
def split_detection(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").where("event_type = 'purchase'").select("user_id", "event_id", ((F.lag("value").over(w) - F.col("value")) >= 4).alias("split"))


@register(
    "delta_index",
    """with x as (select user_id, event_id, event_id - coalesce(lag(event_id) over (partition by user_id order by event_id), 0) as delta from events)
    select user_id, event_id, delta, sum(delta) over (partition by user_id order by event_id rows unbounded preceding)::bigint as decoded from x""",
)
def delta_index(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    x = table(spark, d, "events").select("user_id", "event_id", (F.col("event_id") - F.coalesce(F.lag("event_id").over(w), F.lit(0))).alias("delta"))
    return x.withColumn("decoded", F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, 0)))


@register(
    "source_fallback",
    """with a as (select user_id, cast(ts as date) as date, max(value) as value, 0 as source_rank from events where event_type = 'view' group by all),
    b as (select user_id, cast(ts as date) as date, max(value) as value, 1 as source_rank from events where event_type = 'click' group by all)
    select user_id, date, value, source_rank from a union all select * from b anti join a using (user_id, date)""",
)
def source_fallback(spark, d):
    of = lambda k: events(spark, d).where(F.col("event_type") == k).groupBy("user_id", "date").agg(F.max("value").alias("value"))
    return L.by_preference([of("view"), of("click")], ["user_id", "date"]).select("user_id", "date", "value", "source_rank")


@register(
    "borrowed_names",
    """select event_id, coalesce(case when event_type = 'error' then props end, last_value(case when event_type = 'error' then props end ignore nulls)
    over (partition by user_id order by event_id rows between unbounded preceding and unbounded following)) as name from events""",
)
def borrowed_names(spark, d):
    own = F.when(F.col("event_type") == "error", F.col("props"))
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return table(spark, d, "events").select("event_id", F.coalesce(own, F.last(own, ignorenulls=True).over(w)).alias("name"))


@register(
    "corrected_reports",
    """select user_id, hour, event_id from (select user_id, date_trunc('hour', ts) as hour, event_id, row_number() over (partition by user_id, date_trunc('hour', ts) order by (event_type = 'signup') desc, event_id desc) as r
    from events semi join (select distinct user_id from events where event_type = 'error' and value > 100) h using (user_id)) where r = 1""",
)
def corrected_reports(spark, d):
    e = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    hubs = e.where("event_type = 'error' and value > 100").select("user_id").distinct()
    own = e.join(hubs, "user_id", "left_semi")
    return O.first_per(own, ["user_id", "hour"], [F.desc(F.col("event_type") == "signup"), F.desc("event_id")]).select("user_id", "hour", "event_id")


@register("distinct_by_region", "select user_id % 10 as region, event_type, count(distinct props) as kinds from events where value > 20 group by all")
def distinct_by_region(spark, d):
    return table(spark, d, "events").where("value > 20").groupBy((F.col("user_id") % 10).alias("region"), "event_type").agg(F.count_distinct("props").alias("kinds"))


@register(
    "peak_day",
    """select region, date, n from (select user_id % 5 as region, cast(ts as date) as date, count(*) as n, row_number() over (partition by user_id % 5 order by count(*) desc, cast(ts as date)) as r from events group by 1, 2) where r = 1""",
)
def peak_day(spark, d):
    n = events(spark, d).groupBy((F.col("user_id") % 5).alias("region"), "date").agg(F.count("*").alias("n"))
    return O.first_per(n, ["region"], [F.desc("n"), F.col("date")])


@register("top_states", "select user_id % 50 as state, count(*) as n, max(value) as top from events where event_type = 'error' group by 1 order by n desc, state limit 5")
def top_states(spark, d):
    g = table(spark, d, "events").where("event_type = 'error'").groupBy((F.col("user_id") % 50).alias("state")).agg(F.count("*").alias("n"), F.max("value").alias("top"))
    return g.orderBy(F.desc("n"), "state").limit(5)


_OVER = [("west", 0, 9, 0, 80), ("middle", 2, 7, 40, 160), ("all", 0, 9, 0, 1000)]


@register(
    "counts_in_overlapping_boxes",
    "select box, event_type, count(*) as n from (" + " union all ".join(f"select '{n}' as box, event_type from events where user_id % 10 between {y0} and {y1} and value between {x0} and {x1}" for n, y0, y1, x0, x1 in _OVER) + ") group by all",
)
def counts_in_overlapping_boxes(spark, d):
    rows = table(spark, d, "events").withColumn("box", F.explode(L.in_boxes(F.col("value"), F.col("user_id") % 10, _OVER)))
    return rows.groupBy("box", "event_type").agg(F.count("*").alias("n"))


@register(
    "only_moderate",
    """select cast(ts as date) as date, user_id % 10 as cell, count(distinct user_id) as reports from events e where value between 20 and 60 and not exists
    (select 1 from events s where s.user_id = e.user_id and cast(s.ts as date) = cast(e.ts as date) and s.value > 60) group by all""",
)
def only_moderate(spark, d):
    e = events(spark, d)
    left = e.where("value between 20 and 60").join(e.where("value > 60").select("user_id", "date").distinct(), ["user_id", "date"], "left_anti")
    return left.groupBy("date", (F.col("user_id") % 10).alias("cell")).agg(F.count_distinct("user_id").alias("reports"))


@register(
    "step_summary",
    """with s as (select *, cast(ts as date) as date, count(*) over (partition by cast(ts as date)) as cells from events)
    select date, any_value(cells) as cells, count(*) filter (value >= 50) as hits, count(*) filter (value >= 100) as severe, floor(100.0 * count(*) filter (value >= 50) / any_value(cells) + 0.5)::bigint as share,
    max(value) as top, arg_max(event_id, (value, -event_id)) as top_at from s group by date""",
)
def step_summary(spark, d):
    g = events(spark, d).groupBy("date")
    peak = F.max(F.struct("value", (-F.col("event_id")).alias("k")))
    hits = F.count_if(F.col("value") >= 50)
    return g.agg(
        F.count("*").alias("cells"), hits.alias("hits"), F.count_if(F.col("value") >= 100).alias("severe"), F.floor(100.0 * hits / F.count("*") + 0.5).cast("long").alias("share"), F.max("value").alias("top"), (-peak["k"]).alias("top_at")
    )


@register(
    "where_areas",
    """with n as (select cast(ts as date) as date, user_id % 4 as area, count(*) as n from events where value > 50 group by all), t as (select date, sum(n) as hits from n group by date)
    select date, area, n from (select n.*, row_number() over (partition by n.date order by n desc, area) as r from n join t on t.date = n.date where n >= greatest(2, hits / 5)) where r <= 3""",
)
def where_areas(spark, d):
    n = events(spark, d).where("value > 50").groupBy("date", (F.col("user_id") % 4).alias("area")).agg(F.count("*").alias("n"))
    big = n.withColumn("hits", F.sum("n").over(Window.partitionBy("date"))).where(F.col("n") >= F.greatest(F.lit(2.0), F.col("hits") / 5))
    return O.first_per(big.drop("hits"), ["date"], [F.desc("n"), F.col("area")], 3)


@register(
    "class_maximum",
    """select cast(ts as date) as date, user_id % 10 as cell, coalesce(max(nullif(case when value < 10 then 255 else least(floor(value / 40), 2) end, 255)), 255)::bigint as class from events group by all""",
)
def class_maximum(spark, d):
    c = F.when(F.col("value") < 10, 255).otherwise(F.least(F.floor(F.col("value") / 40), F.lit(2)))
    return events(spark, d).groupBy("date", (F.col("user_id") % 10).alias("cell")).agg(F.coalesce(F.max(F.nullif(c, F.lit(255))), F.lit(255)).cast("long").alias("class"))


@register(
    "ensemble_share",
    """select cast(ts as date) as date, user_id % 5 as cell, sum((value > 40)::integer)::bigint as hits, count(*) as seen, floor(100.0 * sum((value > 40)::integer) / count(*) + 0.5)::bigint as share
    from events group by all having count(distinct user_id) >= 21""",
)
def ensemble_share(spark, d):
    flags = events(spark, d).select("date", (F.col("user_id") % 5).alias("cell"), (F.col("value") > 40).alias("flag"), "user_id")
    return A.member_share(flags, ["date", "cell"], "flag", "user_id", 21).drop("members")


@register(
    "storm_cells_less_clutter",
    """with px as (select user_id as pixel, user_id % 10 as cell, cast(ts as date) as date, hour(ts) as hour, value from events),
    hot as (select pixel, cell from px group by pixel, cell having count(distinct hour) filter (value > 30) * 2 >= 24),
    clutter as (select cell, count(*) as n from hot group by cell), storm as (select date, cell, count(distinct pixel) as n from px where value > 30 group by all)
    select date, cell, greatest(storm.n - coalesce(clutter.n, 0), 0)::bigint as pixels, (storm.n - coalesce(clutter.n, 0)) >= 4 as lit from storm left join clutter using (cell)""",
)
def storm_cells_less_clutter(spark, d):
    px = events(spark, d).select(F.col("user_id").alias("pixel"), (F.col("user_id") % 10).alias("cell"), "date", "hour", "value")
    hot = px.where("value > 30").groupBy("pixel", "cell").agg(F.count_distinct("hour").alias("h")).where("h * 2 >= 24")
    clutter = hot.groupBy("cell").agg(F.count("*").alias("c"))
    storm = px.where("value > 30").groupBy("date", "cell").agg(F.count_distinct("pixel").alias("n"))
    left = F.col("n") - F.coalesce("c", F.lit(0))
    return storm.join(clutter, "cell", "left").select("date", "cell", F.greatest(left, F.lit(0)).cast("long").alias("pixels"), (left >= 4).alias("lit"))


@register("fourth_highest", "select cast(ts as date) as date, user_id % 5 as cell, list(value order by value desc)[4] as v, avg((value > 5)::integer) >= 0.5 as covered from events group by all")
def fourth_highest(spark, d):
    e = events(spark, d).select("date", (F.col("user_id") % 5).alias("cell"), "value")
    covered = e.groupBy("date", "cell").agg((F.avg((F.col("value") > 5).cast("int")) >= 0.5).alias("covered"))
    ranked = e.withColumn("r", F.row_number().over(Window.partitionBy("date", "cell").orderBy(F.desc("value")))).where("r <= 4")
    fourth = ranked.where("r = 4").select("date", "cell", F.col("value").alias("v"))
    return covered.join(fourth, ["date", "cell"], "left").select("date", "cell", "v", "covered")


@register("coverage_share", "select cast(ts as date) as date, floor(1000.0 * count(*) filter (value >= 40) / nullif(count(*) filter (value >= 5), 0) + 0.5)::bigint as permille from events group by 1")
def coverage_share(spark, d):
    return events(spark, d).groupBy("date").agg(F.floor(F.try_divide(1000.0 * F.count_if(F.col("value") >= 40), F.count_if(F.col("value") >= 5)) + 0.5).cast("long").alias("permille"))


@register(
    "covered_run",
    """with c as (select user_id % 10 as row, least(floor(value / 20), 11)::bigint as col from events where event_type = 'click' group by all),
    g as (select row, col, col - row_number() over (partition by row order by col) as k from c) select row, count(*) as run from g where k = -1 group by row""",
)
def covered_run(spark, d):
    c = table(spark, d, "events").where("event_type = 'click'").select((F.col("user_id") % 10).alias("row"), F.least(F.floor(F.col("value") / 20), F.lit(11)).cast("long").alias("col")).distinct()
    g = c.withColumn("k", F.col("col") - F.row_number().over(Window.partitionBy("row").orderBy("col")))
    return g.where("k = -1").groupBy("row").agg(F.count("*").alias("run"))


@register("capped_accumulation", "select event_id, user_id from (select *, sum(length(props)) over (partition by user_id order by ts, event_id rows unbounded preceding) as s from events) where s <= 100")
def capped_accumulation(spark, d):
    return O.capped_by_length(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.char_length("props"), 100).select("event_id", "user_id")


@register("sorted_counts", "select event_type, user_id, count(*) as n from events group by all order by n desc, event_type, user_id limit 12")
def sorted_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type", "user_id").limit(12)


@register("top_per_group", "select event_type, event_id, value from (select *, row_number() over (partition by event_type order by value desc, event_id) as r from events) where r <= 5")
def top_per_group(spark, d):
    return O.first_per(table(spark, d, "events"), ["event_type"], [F.desc("value"), F.col("event_id")], 5).select("event_type", "event_id", "value")


@register("set_operations", """select 'both' as kind, count(*) as n from (select user_id from events where value > 200 intersect select user_id from events where value < 5)
    union all select 'either', count(*) from (select user_id from events where value > 200 union select user_id from events where value < 5)
    union all select 'only high', count(*) from (select user_id from events where value > 200 except select user_id from events where value < 5)
    union all select 'all rows', count(*) from (select user_id from events where value > 200 union all select user_id from events where value < 5)""")
def set_operations(spark, d):
    e = table(spark, d, "events")
    a, b = e.where("value > 200").select("user_id"), e.where("value < 5").select("user_id")
    parts = [("both", a.intersect(b)), ("either", a.union(b).distinct()), ("only high", a.subtract(b)), ("all rows", a.unionByName(b))]
    out = None
    for kind, x in parts:
        row = x.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "program_windows_timed",
    None,
)
def program_windows_timed(spark, d):
    """Advisories from errors, cancellations from signups; the fold has no SQL and is held against a plain version in tests."""
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = events(spark, d).where("event_type in ('error', 'signup')").select(
        (F.col("user_id") % 40).alias("code"), t.alias("t"), (F.col("event_type") == "signup").alias("cancel"), F.when(F.col("value") > 10, t + 600).alias("p_start"), F.when(F.col("value") > 10, t + 600 + (F.col("value") * 300).cast("long")).alias("p_end"), F.col("date").cast("string").alias("day")
    )
    return O.program_windows(rows, ["code"])
