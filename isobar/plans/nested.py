"""Nested documents: their nodes, the rules on what must not be published, and the contract of a published document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nested import Rule, nodes, rule_hits
from .registry import register, table

#: Raw report texts, as their services write them.
REPORTS = r"\b[A-Z]{4} SIGMET\s+[A-Z0-9]{1,4}\s*\d{0,3}\s+VALID\s+\d{6}/\d{6}|\bCONVECTIVE SIGMET\s+\d{1,3}[ECW]\b|\bU?UA\s+/OV\b|\b(METAR|SPECI)\s+[A-Z]{4}\s+\d{6}Z\b"
#: What must not be in a published document; the last two have something to find in conversations.
RULES = (
    Rule("report text", kinds=("string",), pattern=REPORTS),
    Rule("code with position", members=(("code", "icao"), ("lat", "lon"))),
    Rule("hubs with content", kinds=("array", "object"), names=("hubs", "hubProb"), least=1),
    Rule("question", kinds=("string",), pattern=r"\?"),
    Rule("long text", kinds=("string",), pattern=r"(?s).{200}"),
)


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, json): a conversation as turns that hold their replies, as deep as it is long."""
    rows = table(spark, sf_dir, "conversations")
    user = F.array(F.struct(F.col("role").alias("code"), F.col("turn").alias("lat")))
    head = F.to_json(F.struct("role", "text", F.when(F.col("role") == "user", user).alias("at"), F.when(F.col("role") != "user", F.array("turn")).alias("hubs")))
    turn = F.struct((-F.col("turn")).alias("o"), F.substring(head, F.lit(1), F.length(head) - 1).alias("h"))
    fold = F.aggregate(F.array_sort(F.collect_list(turn)), F.lit("null"), lambda s, t: F.concat(t["h"], F.lit(',"reply":'), s, F.lit("}")))
    return rows.groupBy("conv_id").agg(fold.alias("json"))


_THREADS = """
with recursive heads as (
  select conv_id, turn, to_json(role) as r, '{"role":' || to_json(role) || ',"text":' || to_json(text) ||
    case when role = 'user' then ',"at":[{"code":' || to_json(role) || ',"lat":' || turn || '}]' else ',"hubs":[' || turn || ']' end as h
  from conversations
), threads as (
  select conv_id, string_agg(h, ',"reply":' order by turn) || ',"reply":null' || repeat('}', count(*)::integer) as json from heads group by conv_id
), nodes as (
  select conv_id, '$' as path, null::varchar as parent, null::varchar as name, json::json as v, 0 as depth from threads
  union all
  select n.conv_id, n.path || case when json_type(n.v) = 'ARRAY' then '[' || k.key || ']' else '.' || k.key end, n.path, case when json_type(n.v) = 'OBJECT' then k.key end, k.value, n.depth + 1
  from nodes n, json_each(n.v) k where json_type(n.v) in ('ARRAY', 'OBJECT')
), kinds as (
  select *, case json_type(v) when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'string' when 'NULL' then 'null' when 'BOOLEAN' then 'boolean' else 'number' end as kind,
    case json_type(v) when 'OBJECT' then len(json_keys(v)) when 'ARRAY' then json_array_length(v) end::bigint as size, case when json_type(v) not in ('OBJECT', 'ARRAY', 'NULL') then v ->> '$' end as value
  from nodes
)"""

_OWN = " union all ".join(
    f"select conv_id, '{r.name}' as rule, path, size, value from kinds where true"
    + (f" and kind in ({', '.join(map(repr, r.kinds))})" if r.kinds else "")
    + (f" and name in ({', '.join(map(repr, r.names))})" if r.names else "")
    + (f" and regexp_matches(value, '{r.pattern}')" if r.pattern else "")
    + (f" and size >= {r.least}" if r.least else "")
    for r in RULES
    if not r.members
)
_MEMBERS = " union all ".join(
    f"select conv_id, '{r.name}' as rule, path, size, value from kinds a where kind = 'array' and exists (select 1 from kinds b where b.conv_id = a.conv_id and b.parent = a.path and b.kind = 'object' and "
    + " and ".join(f"list_has_any(json_keys(b.v), {list(g)!r})" for g in r.members)
    + ")"
    for r in RULES
    if r.members
)


@register("nested_nodes", f"{_THREADS} select conv_id, path, parent, name, kind, size, value, depth from kinds")
def nested_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(threads(spark, sf_dir), ["conv_id"], "json").drop("fields")


@register("nested_rule_hits", f"{_THREADS} {_OWN} union all {_MEMBERS}")
def nested_rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_hits(nodes(threads(spark, sf_dir), ["conv_id"], "json"), ["conv_id"], RULES)
