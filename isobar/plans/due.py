"""What is due, what is held and what is counted: plans under limits and counters that take back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.planning import budgeted, spread_rank
from ..streaming.counters import counts, empty_state, merged
from .registry import register, table

#: Most slots and cost of a plan, for a host and in all; hours by which a slot is late; misses after which it is given up.
PER_HOST, IN_ALL, LAG_HOURS, MISSES = 40, 1_000, 30, 3
_SLOT = 3


def slots_of_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(host, day, slot, state, cost, late): every three hours of every day for every user that has events.

    A view holds its slot, three errors or more give it up, and slots of the last LAG_HOURS hours aren't there yet. A slot costs
    one and the number of its clicks.
    """
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).withColumn("slot", F.floor(F.hour("ts") / _SLOT).cast("int"))
    # The table's first and last day and its newest moment: three values that every host's lattice is made from.
    ends = e.agg(F.min("day").alias("a"), F.max("day").alias("b"), F.max("ts").alias("now")).first()
    hosts = e.select(F.col("user_id").alias("host")).distinct()
    days = F.sequence(F.lit(ends.a), F.lit(ends.b)) if ends.a else F.array().cast("array<date>")
    every = hosts.select("host", F.explode(days).alias("day")).select("host", "day", F.explode(F.sequence(F.lit(0), F.lit(24 // _SLOT - 1))).alias("slot"))
    seen = e.groupBy(F.col("user_id").alias("host"), "day", "slot").agg(*(F.count_if(F.col("event_type") == k).alias(k) for k in ("view", "error", "click")))
    late = F.timestamp_diff("HOUR", F.make_timestamp_ntz(F.year("day"), F.month("day"), F.day("day"), F.col("slot") * _SLOT, F.lit(0), F.lit(0)), F.lit(ends.now).cast("timestamp_ntz"))
    rows = every.withColumn("late", late).join(seen, ["host", "day", "slot"], "left")
    state = F.when(F.col("view") > 0, "held").when(F.col("error") >= MISSES, "given up").when(F.col("late") < LAG_HOURS, "not yet there")
    return rows.select("host", "day", "slot", state.alias("state"), (1 + F.coalesce("click", F.lit(0))).cast("long").alias("cost"))


@register(
    "planned_slots",
    f"""
with e as (select *, ts::date as day, hour(ts) // {_SLOT} as slot from events),
lattice as (select day::date as day, slot, now from (select unnest(generate_series(a::timestamp, b::timestamp, interval 1 day)) as day, now from (select min(day) as a, max(day) as b, max(ts) as now from e)), range(8) r(slot)),
seen as (select user_id as host, day, slot, count(*) filter (event_type = 'view') as v, count(*) filter (event_type = 'error') as x, count(*) filter (event_type = 'click') as c from e group by all),
slots as (
  select h.host, l.day, l.slot, case when v > 0 then 'held' when x >= {MISSES} then 'given up' when floor(epoch_us(now) / 3600000000.0 - epoch_us(l.day::timestamp + to_hours((l.slot * {_SLOT})::integer)) / 3600000000.0) < {LAG_HOURS} then 'not yet there' end as state,
    1 + coalesce(c, 0) as cost, (l.slot & 1) * 4 + ((l.slot >> 1) & 1) * 2 + (l.slot >> 2) as spread
  from (select distinct user_id as host from e) h, lattice l left join seen s on s.host = h.host and s.day = l.day and s.slot = l.slot
),
due as (select *, sum(cost) over (partition by host order by spread, day desc, slot rows unbounded preceding) as host_total from slots where state is null),
fits as (select *, sum(cost) over (order by spread, day desc, host, slot rows unbounded preceding) as total from due where host_total <= {PER_HOST})
select host, day, slot::integer as slot, cost, host_total::bigint as host_total, total::bigint as total, case when total <= {IN_ALL} then 'chosen' else 'limit in all' end as reason, total <= {IN_ALL} as chosen from fits
union all select host, day, slot::integer, cost, host_total::bigint, null, 'limit of its host', false from due where host_total > {PER_HOST}
union all select host, day, slot::integer, cost, null, null, state, false from slots where state is not null""",
)
def planned_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slots to read now and the reasons why others wait: spread over the hours of the day first, then the newest days."""
    slots = slots_of_hosts(spark, sf_dir)
    order = [spread_rank(F.col("slot"), 3), F.col("day").desc(), F.col("host"), F.col("slot")]
    return budgeted(slots, "host", order, "cost", PER_HOST, IN_ALL)


def frames_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, hour, version, stray, pixel, arrived): an event lights a user's pixel in its hour; purchases above 150 are stray.

    Its version is its payload's number in quarters, and it arrives in the batch that its id gives, so that the versions of a
    frame come in any order and in several parts.
    """
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    version, stray = F.floor(k / 25).cast("long"), (F.col("event_type") == "purchase") & (F.col("value") > 150)
    return e.select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), version.alias("version"), stray.alias("stray"), F.col("user_id").alias("pixel"), (F.col("event_id") % 3).alias("arrived"))


@register(
    "counters_with_retraction",
    """
with f as (select ts::date as day, hour(ts) as hour, (props ->> '$.k')::integer // 25 as version, event_type = 'purchase' and value > 150 as stray, user_id as pixel from events),
h as (select day, hour, max(version) as version from f group by all),
ok as (select day, hour, version from f join h using (day, hour, version) group by all having not bool_or(stray))
select day, pixel, count(distinct hour)::bigint as n from f join ok using (day, hour, version) group by all""",
)
def counters_with_retraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches merged one after the other, all rows in all: the counts equal those of a single pass over the table."""
    frames, state = frames_of_events(spark, sf_dir), empty_state(spark)
    for k in (2, 0, 1):
        state = merged(state, frames.where(F.col("arrived") == k).drop("arrived"))
    return counts(state)


def selected(name, wanted: str):  # noqa: ANN001, ANN201
    """Whether a comma-separated selection takes a part: names listed, all if none is, less those with a minus before them; any case."""
    parts = [p.strip().upper() for p in wanted.split(",") if p.strip()]
    only, off = [p for p in parts if p[0] != "-"], [p[1:].strip() for p in parts if p[0] == "-"]
    taken = F.upper(name).isin(*only) if only else name.isNotNull()
    return taken & ~F.upper(name).isin(*off) if off else taken


@register(
    "paths_of_slots",
    """select event_id, 'gfs.' || strftime(c, '%Y%m%d') || '/' || strftime(c, '%H') || '/f' || lpad((date_diff('minute', c, ts) // 180 * 3)::varchar, 3, '0') || '/' || event_type || '.grib2' as path
    from (select *, time_bucket(interval '6 hours', ts - interval 5 hours, timestamp '2000-01-01') as c from events) where upper(event_type) in ('VIEW', 'ERROR', 'CLICK') and upper(event_type) <> 'CLICK'""",
)
def paths_of_slots(spark, d):
    """For each event of the selected parts the newest cycle that is five hours old and the path of its file at the event's lead time."""
    e = table(spark, d, "events").where(selected(F.col("event_type"), "view, Error,click,-CLICK"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    cycle = F.floor((seconds - 5 * 3600) / 21600) * 21600
    lead = F.floor((F.floor(seconds / 60) - cycle / 60) / 180) * 3
    c = F.timestamp_seconds(cycle)
    path = F.concat(F.lit("gfs."), F.date_format(c, "yyyyMMdd"), F.lit("/"), F.date_format(c, "HH"), F.lit("/f"), F.lpad(lead.cast("string"), 3, "0"), F.lit("/"), "event_type", F.lit(".grib2"))
    return e.select("event_id", path.alias("path"))


#: Days that a window of observations has at least.
MIN_DAYS = 4


@register(
    "observed_windows",
    f"""select o_orderkey, o_orderdate::date as upto, least(date_trunc('week', o_orderdate)::date, o_orderdate::date - {MIN_DAYS - 1})::date as first, date_trunc('week', o_orderdate)::date as monday,
      greatest(0, date_diff('day', o_orderdate::date - {MIN_DAYS - 1}, date_trunc('week', o_orderdate)::date))::integer as days_before, (o_orderdate::date + 6)::date as ahead, (o_orderdate::date - 1)::date as prev from orders""",
)
def observed_windows(spark, d):
    """From a run's day the window of its week, never of fewer than the last days, the days before its Monday, and the week ahead."""
    day = F.to_date("o_orderdate")
    monday, earliest = F.trunc(day, "week"), F.date_sub(day, MIN_DAYS - 1)
    before = F.greatest(F.datediff(monday, earliest), F.lit(0))
    return table(spark, d, "orders").select("o_orderkey", day.alias("upto"), F.least(monday, earliest).alias("first"), monday.alias("monday"), before.alias("days_before"), F.date_add(day, 6).alias("ahead"), F.date_sub(day, 1).alias("prev"))


@register(
    "reports_in_window",
    """with r as (select event_id, ts, value, (props ->> '$.k')::integer as k from events),
    h as (select event_id, ts, 'turbulence' as hazard, case when k % 3 = 0 then 'SEV' when k % 3 = 1 then 'MOD' end as severity from r union all select event_id, ts, 'icing', case when k > 60 then 'MOD' when k > 30 then 'LGT' end from r)
    select event_id, hazard, severity from h where severity is not null and ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-12'""",
)
def reports_in_window(spark, d):
    """Reports as JSON objects with a list of hazards, parsed, kept if they were sent in a window, a row for each hazard that has a severity."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    hazard = lambda name, severity: F.struct(F.lit(name).alias("hazard"), severity.alias("severity"))
    listed = F.array(hazard("turbulence", F.when(F.col("k") % 3 == 0, "SEV").when(F.col("k") % 3 == 1, "MOD")), hazard("icing", F.when(F.col("k") > 60, "MOD").when(F.col("k") > 30, "LGT")))
    report = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("sent"), listed.alias("hazards")))
    parsed = e.select(F.from_json(report, "event_id long, sent timestamp_ntz, hazards array<struct<hazard string, severity string>>").alias("r")).select("r.*")
    inside = parsed.where((F.col("sent") >= F.lit("2024-01-05").cast("timestamp_ntz")) & (F.col("sent") < F.lit("2024-01-12").cast("timestamp_ntz")))
    return inside.select("event_id", F.explode("hazards").alias("h")).select("event_id", "h.*").where("severity is not null")


@register(
    "archive_days",
    """select ts::date::varchar as day, count(*) filter (event_type <> 'signup') as reports, count(distinct user_id) filter (event_type <> 'signup') as stations, max(value) filter (event_type <> 'signup') as top from events group by 1""",
)
def archive_days(spark, d):
    """Events written as compressed JSON lines by day and read back as day files; the lines of signups are broken and left out."""
    from ..sources.steps import place
    from ..sources.tables import day_files

    e = table(spark, d, "events")
    line = F.to_json(F.struct("event_id", "user_id", "value"))
    path = place(spark, "archive")
    e.select(F.to_date("ts").cast("string").alias("day"), F.when(F.col("event_type") == "signup", F.substring(line, 1, 12)).otherwise(line).alias("value")).write.partitionBy("day").option("compression", "gzip").text(path)
    rows = day_files(spark, path, "event_id long, user_id long, value double, day string")
    return rows.groupBy("day").agg(F.count("*").alias("reports"), F.count_distinct("user_id").alias("stations"), F.max("value").alias("top"))
