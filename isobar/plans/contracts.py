"""The contract of a published document, as rows, over a document for each user of ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.contract import Rule, breaches
from .registry import register, table

#: The published document's contract.
RULES = (
    Rule("schema", "schema", "one of", choices=("isobar-1", "isobar-2")),
    Rule("generated is a time", "generated", "like", pattern=r"^\d{4}-\d\d-\d\dT\d\d:\d\d"),
    Rule("run has an id", "run.id", "there"),
    Rule("run has a place", "run.url", "like", pattern="^https://"),
    Rule("window begins with a day", "window.from", "like", pattern=r"^\d{4}-\d\d-\d\d$"),
    Rule("window ends with a day", "window.to", "like", pattern=r"^\d{4}-\d\d-\d\d$"),
    Rule("window ends after it begins", "window.to", "at least", peer="from"),
    Rule("window has a span", "window.days", "between", low=1, high=31),
    Rule("window is as long as its days", "window.days", "between", low=20),
    Rule("status is known", "status.ok", "there"),
    Rule("status has seconds", "status.seconds", "between", low=0, high=2_500),
    Rule("status has requests", "status.requests", "between", low=1),
    Rule("an error only where not ok", "status.error", "only if", peer="failed"),
    Rule("an error has a text", "status.error", "like", pattern="error", optional=True),
    Rule("totals are the days' sum", "total", "sum", peer=("$.days", "n")),
    Rule("errors are the days' sum", "errors", "sum", peer=("$.days", "errors")),
    Rule("errors are few", "errors", "between", high=8),
    Rule("errors are not more than all", "errors", "at most", peer="total"),
    Rule("there are days", "days", "count", low=1, high=31),
    Rule("days rise", "days", "rising", peer="date"),
    Rule("days come once", "days", "unique", peer="date"),
    Rule("peaks come once", "days", "unique", peer="peak"),
    Rule("a day is a date", "days[].date", "like", pattern=r"^\d{4}-\d\d-\d\d$"),
    Rule("a day begins in the window", "days[].date", "at least", peer="$.window.from"),
    Rule("a day ends in the window", "days[].date", "at most", peer="$.window.to"),
    Rule("a day has a kind", "days[].kind", "one of", choices=("analysis", "forecast")),
    Rule("a day is as the document", "days[].kind", "same", peer="$.kind"),
    Rule("a day has events", "days[].n", "between", low=1, high=4),
    Rule("a day's errors are few", "days[].errors", "at most", peer="n"),
    Rule("a day's peak is no outlier", "days[].peak", "between", low=0, high=250),
    Rule("a day's peak is above its mean", "days[].peak", "at least", peer="mean"),
    Rule("a day's first event is an hour", "days[].first", "between", low=0, high=23),
    Rule("a day's first event is early", "days[].first", "between", high=20),
    Rule("a day's last event follows", "days[].last", "at least", peer="first"),
    Rule("a valid time", "days[].valid", "like", pattern=r"^\d{4}-\d\d-\d\dT\d\d"),
    Rule("a note only on quiet days", "days[].note", "only if", peer="quiet"),
    Rule("a grid has its cells", "days[].grid", "cells", peer=("$.nlat", "$.nlon")),
    Rule("a cell is a count", "days[].grid[]", "between", low=0, high=1),
    Rule("a grid's total", "days[].cells", "at most", peer="n"),
    Rule("a grid has rows", "nlat", "between", low=1),
    Rule("a grid has columns", "nlon", "between", low=1, high=24),
    Rule("credit is given", "credit", "count", low=1),
    Rule("credit is text", "credit[]", "like", pattern=r"\w"),
    Rule("a disclaimer", "disclaimer", "like", pattern="NOT FOR OPERATIONAL USE"),
    Rule("no hubs", "hubs", "count", high=0),
)


def snapshots(spark, d):
    """A nested document for each user: a day's events as a grid of 4 x 6 hours, sums, a window from its first view to its last."""
    e = table(spark, d, "events").withColumn("date", F.date_format("ts", "yyyy-MM-dd")).withColumn("hour", F.hour("ts"))
    view = F.col("event_type") == "view"
    by_hour = e.groupBy("user_id", "date", "hour").agg(F.count("*").alias("c"), F.count_if(F.col("event_type") == "error").alias("x"), F.max("value").alias("peak"), F.sum("value").alias("sum"), F.max(view).alias("view"))
    day = by_hour.groupBy("user_id", "date").agg(
        F.sum("c").alias("n"), F.sum("x").alias("errors"), F.max("peak").alias("peak"), (F.sum("sum") / F.sum("c")).alias("mean"), F.min("hour").alias("first"), F.max("hour").alias("last"),
        F.map_from_entries(F.collect_list(F.struct("hour", "c"))).alias("hours"), F.max("view").alias("view"),
    )
    n, errors = F.col("n"), F.col("errors")
    grid = F.transform(F.sequence(F.lit(0), F.when(n == 5, 22).otherwise(23)), lambda h: F.coalesce(F.try_element_at("hours", h), F.lit(0)))
    one = F.struct(
        "date", F.when(errors > 1, "draft").when(n > 3, "forecast").otherwise("analysis").alias("kind"), "n", "errors", "peak", "mean", "first", "last", F.when(n > 1, F.concat("date", F.lit("T12"))).alias("valid"),
        (n == 1).alias("quiet"), F.when((n == 1) & (errors == 0), "one event").alias("note"), grid.alias("grid"), F.size("hours").alias("cells"),
    )
    g = day.groupBy("user_id").agg(F.array_sort(F.collect_list(one)).alias("days"), F.sum("n").alias("total"), F.sum("errors").alias("errors"), F.min(F.when(F.col("view"), F.col("date"))).alias("from"), F.max(F.when(F.col("view"), F.col("date"))).alias("to"), F.max("peak").alias("peak"))
    u = F.col("user_id")
    failed = F.col("errors") > 6
    return g.select(
        "user_id", F.when(u % 50 == 7, "isobar-0").otherwise("isobar-1").alias("schema"), F.when(u % 9 > 0, F.concat("to", F.lit("T06:00Z"))).otherwise(F.col("to")).alias("generated"),
        F.struct(u.alias("id"), F.concat(F.when(u % 11 == 0, "http://").otherwise("https://"), F.lit("example.org/"), u).alias("url")).alias("run"),
        F.struct("from", "to", (F.datediff("to", "from") + 1).alias("days")).alias("window"),
        F.struct((~failed).alias("ok"), failed.alias("failed"), (F.col("peak") * 10).alias("seconds"), F.col("total").alias("requests"), F.when(F.col("errors") > 7, "too many errors").alias("error")).alias("status"),
        F.lit("analysis").alias("kind"), "total", F.when(u % 17 == 0, F.col("errors") + 1).otherwise(F.col("errors")).alias("errors"), "days", F.lit(4).alias("nlat"), F.lit(6).alias("nlon"),
        F.when(u % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("made of events"), F.when(u % 5 == 0, " ").otherwise("public"))).alias("credit"),
        F.when(u % 19 > 0, "NOT FOR OPERATIONAL USE").alias("disclaimer"), F.when(u % 23 == 0, F.array(u)).otherwise(F.array().cast("array<bigint>")).alias("hubs"),
    )


def _sql() -> str:
    """Every rule as a condition on flat tables of documents, days and cells: the same contract without nesting."""

    def held(r: Rule) -> tuple[str, str, str]:
        """Table, path and condition of a rule."""
        at = "d" if "[]" not in r.path else "c" if r.path.endswith("grid[]") else "k" if r.path == "credit[]" else "y"
        name = r.path.replace("window.", "w_").replace("status.", "s_").replace("run.", "r_").replace("days[].grid[]", "cell").replace("credit[]", "credit").replace("days[].", "")
        there = {"y": "'$.days[' || i || '].' || '" + name + "'", "c": "'$.days[' || i || '].grid[' || h || ']'", "k": "'$.credit[' || h || ']'", "d": f"'$.{r.path}'"}[at]
        column = ("y_" if at == "y" else "") + name
        bounds = lambda v: " and ".join([f"{v} >= {r.low}"] * (r.low is not None) + [f"{v} <= {r.high}"] * (r.high is not None))
        peer = r.peer if isinstance(r.peer, tuple) else r.peer.replace("$.window.", "w_").replace("$.", "") if r.peer.startswith("$.") else f"y_{r.peer}" if at == "y" else f"w_{r.peer}" if r.path.startswith("window") else f"s_{r.peer}" if r.path.startswith("status") else r.peer
        condition = {
            "there": f"{column} is not null", "like": f"regexp_matches({column}, '{r.pattern}')", "one of": f"{column} in ({', '.join(map(repr, r.choices))})", "between": bounds(column), "count": bounds(f"n_{column}"),
            "at least": f"{column} >= {peer}", "at most": f"{column} <= {peer}", "same": f"{column} = {peer}", "cells": "n_grid = nlat * nlon", "rising": "true", "unique": f"n_{r.peer} = n_days", "sum": f"{column} = sum_{r.peer[-1] if r.peer else ''}",
            "only if": f"({column} is not null) = coalesce({peer}, false)",
        }[r.kind]
        return at, there, condition if not r.optional else f"({condition} or {column} is null)"

    parts = [f"select user_id, '{r.name.replace(chr(39), chr(39) * 2)}' as rule, {held(r)[1]} as path from {held(r)[0]} where not coalesce({held(r)[2]}, false)" for r in RULES]
    return f"""
with e as (select *, strftime(ts, '%Y-%m-%d') as date, hour(ts) as hour from events),
day as (select user_id, date, count(*) as n, count(*) filter (event_type = 'error') as errors, max(value) as peak, avg(value) as mean, min(hour) as first, max(hour) as last, count(distinct hour) as cells, bool_or(event_type = 'view') as seen from e group by all),
u as (select user_id, sum(n) as total, sum(errors) as all_errors, min(date) filter (seen) as w_from, max(date) filter (seen) as w_to, max(peak) as top, count(*) as n_days, count(distinct date) as n_date, count(distinct peak) as n_peak, sum(n) as sum_n, sum(errors) as sum_errors from day group by 1),
d as (
  select user_id, case when user_id % 50 = 7 then 'isobar-0' else 'isobar-1' end as schema, case when user_id % 9 > 0 then w_to || 'T06:00Z' else w_to end as generated, user_id as r_id,
    case when user_id % 11 = 0 then 'http://' else 'https://' end || 'example.org/' || user_id as r_url, w_from, w_to, date_diff('day', w_from::date, w_to::date) + 1 as w_days, all_errors <= 6 as s_ok, all_errors > 6 as s_failed, top * 10 as s_seconds, total as s_requests,
    case when all_errors > 7 then 'too many errors' end as s_error, 'analysis' as kind, total, case when user_id % 17 = 0 then all_errors + 1 else all_errors end as errors, n_days, n_date, n_peak, sum_n, sum_errors, 4 as nlat, 6 as nlon,
    case when user_id % 13 = 0 then 0 else 2 end as n_credit, case when user_id % 19 > 0 then 'NOT FOR OPERATIONAL USE' end as disclaimer, case when user_id % 23 = 0 then 1 else 0 end as n_hubs
  from u
),
y as (
  select d.*, row_number() over (partition by user_id order by g.date) - 1 as i, g.date as y_date, case when g.errors > 1 then 'draft' when g.n > 3 then 'forecast' else 'analysis' end as y_kind, g.n as y_n, g.errors as y_errors, g.peak as y_peak, g.mean as y_mean,
    g.first as y_first, g.last as y_last, case when g.n > 1 then g.date || 'T12' end as y_valid, g.n = 1 as y_quiet, case when g.n = 1 and g.errors = 0 then 'one event' end as y_note, case when g.n = 5 then 23 else 24 end as n_grid, g.cells as y_cells
  from d join day g using (user_id)
),
c as (select y.user_id, i, h, (select count(*) from e where e.user_id = y.user_id and e.date = y.y_date and e.hour = h) as cell from y, range(24) r(h) where h < n_grid),
k as (select user_id, h, case when h = 0 then 'made of events' when user_id % 5 = 0 then ' ' else 'public' end as credit from d, range(2) r(h) where h < n_credit)
{" union all ".join(parts)}"""


@register("contract_breaches", _sql())
def contract_breaches(spark, d):
    return breaches(snapshots(spark, d), ["user_id"], RULES).drop("value")


@register(
    "assembled_documents",
    """
with o as (select c_nationkey as k, count(*) as n, count(*) filter (o_orderstatus = 'F') as f from orders join customer on o_custkey = c_custkey group by 1),
s as (select s_nationkey as k, count(*) as n from supplier group by 1), c as (select c_nationkey as k, count(*) as n from customer group by 1),
p as (select n_nationkey, n_name, case when o.f > 230 then null else o.n end as orders, case when s.n >= 3 then s.n end as suppliers, c.n as customers from nation left join o on o.k = n_nationkey left join s on s.k = n_nationkey left join c on c.k = n_nationkey)
select n_nationkey, '{"schema":"isobar-1","nation":"' || n_name || '","parts":{"orders":' || coalesce('{"n":' || orders || '}', 'null') || ',"suppliers":' || coalesce('{"n":' || suppliers || '}', 'null') || ',"customers":' || coalesce('{"n":' || customers || '}', 'null')
  || '},"status":[' || concat_ws(',', case when orders is null then '{"part":"orders","ok":false,"error":"no part"}' else '{"part":"orders","ok":true,"error":null}' end, case when suppliers is null then '{"part":"suppliers","ok":false,"error":"no part"}' else '{"part":"suppliers","ok":true,"error":null}' end,
  case when customers is null then '{"part":"customers","ok":false,"error":"no part"}' else '{"part":"customers","ok":true,"error":null}' end) || '],"attribution":[' || concat_ws(',', '"public tables"', case when orders is not null then '"orders of this nation"' end, case when suppliers is not null then '"suppliers of this nation"' end) || ']}' as document
from p""",
)
def assembled_documents(spark, d):
    """One JSON document for each nation: its parts or null, a status for each, and credit for the parts that are there."""
    t = lambda name: table(spark, d, name)
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    s = t("supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    c = t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    p = t("nation").withColumn("k", F.col("n_nationkey")).join(o, "k", "left").join(s, "k", "left").join(c, "k", "left")
    held = {"orders": ~(F.col("f") > 230), "suppliers": F.col("suppliers") >= 3, "customers": F.lit(True)}
    n = {k: F.when(ok, F.col(k)) for k, ok in held.items()}
    parts = F.struct(*(F.when(v.isNotNull(), F.struct(v.alias("n"))).alias(k) for k, v in n.items()))
    status = F.array(*(F.struct(F.lit(k).alias("part"), v.isNotNull().alias("ok"), F.when(v.isNull(), "no part").alias("error")) for k, v in n.items()))
    credit = F.array_compact(F.array(F.lit("public tables"), *(F.when(n[k].isNotNull(), f"{k} of this nation") for k in ("orders", "suppliers"))))
    document = F.struct(F.lit("isobar-1").alias("schema"), F.col("n_name").alias("nation"), parts.alias("parts"), status.alias("status"), credit.alias("attribution"))
    return p.select("n_nationkey", F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))
