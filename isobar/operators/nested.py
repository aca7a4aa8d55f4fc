"""JSON of any depth as a table of its nodes, and rules over that table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..sources.steps import place

#: Spark's type of a value, without what it holds, and what JSON calls it; every other type is a number.
_KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def _described(frontier: DataFrame, keys: list[str]) -> DataFrame:
    """A level's nodes; ``v`` is kept only where there is something below."""
    known = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    word = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    kind = F.when(F.col("v").isNull(), "invalid").otherwise(F.coalesce(known[word], F.lit("number")))
    level = frontier.withColumn("kind", kind)
    container, text = F.col("kind").isin("object", "array"), F.to_json("v")
    fields = F.when(F.col("kind") == "object", F.json_object_keys(text))
    level = level.withColumn("fields", fields).withColumn("size", F.when(F.col("kind") == "object", F.size("fields")).when(F.col("kind") == "array", F.json_array_length(text)))
    scalar = F.when(~container & (F.col("kind") != "invalid"), F.variant_get("v", "$", "string"))
    return level.select(*keys, "path", "parent", "name", "kind", F.col("size").cast("long").alias("size"), "fields", scalar.alias("value"), F.when(container & (F.col("size") > 0), F.col("v")).alias("v"))


def nodes(docs: DataFrame, keys: list[str], json: str) -> DataFrame:
    """One row for each node of each row's JSON: ``keys``, path, parent, name, kind, size, fields, value, depth.

    The walk goes level by level: a level's children are what ``variant_explode`` gives for its objects and arrays, so that
    depth is bounded by nothing but the driver's rounds, one for each level and none for each node. A level is a written
    table; the next one reads it in fresh splits, whatever a level's widest row. ``path`` is $.name[0].name; ``kind`` is
    object, array, string, number, boolean or null; ``size`` counts members, ``fields`` names an object's, ``value`` is a
    scalar as text. Text that isn't JSON, and null, give one node of kind ``invalid``. Repeated rows give repeated nodes;
    columns of other names are left out. An empty table has no nodes.
    """
    spark, base = docs.sparkSession, place(docs.sparkSession, "nodes")
    none = F.lit(None).cast("string")
    frontier = docs.select(*keys, F.lit("$").alias("path"), none.alias("parent"), none.alias("name"), F.try_parse_json(F.col(json)).alias("v"))
    schema, depth = None, 0
    while True:
        level = _described(frontier, keys)
        schema = schema or level.schema
        at = f"{base}/depth={depth}"
        level.write.parquet(at)
        inner = spark.read.schema(schema).parquet(at).where("v is not null")
        if not inner.limit(1).count():
            break
        below = inner.select(*keys, "path", "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
        frontier = below.select(*keys, F.concat("path", step).alias("path"), F.col("path").alias("parent"), F.col("key").alias("name"), F.col("value").alias("v"))
        depth += 1
    return spark.read.schema(StructType([*schema.fields, StructField("depth", IntegerType())])).parquet(base).drop("v")


@dataclass(frozen=True)
class Rule:
    """What a node must not be. Each condition that is given must hold; a rule on ``members`` asks about an array's objects."""

    name: str
    kinds: tuple[str, ...] = ()
    names: tuple[str, ...] = ()
    #: A pattern that the value holds, and members from which on the rule holds.
    pattern: str = ""
    least: int = 0
    #: Of each of these groups of fields some object in the array has one.
    members: tuple[tuple[str, ...], ...] = ()

    def holds(self) -> Column:
        found = F.lit(True)
        if self.kinds:
            found &= F.col("kind").isin(*self.kinds)
        if self.names:
            found &= F.coalesce(F.col("name").isin(*self.names), F.lit(False))
        if self.pattern:
            found &= F.coalesce(F.col("value").rlike(self.pattern), F.lit(False))
        if self.least:
            found &= F.coalesce(F.col("size") >= self.least, F.lit(False))
        return found


def rule_hits(walked: DataFrame, keys: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """(keys, rule, path, size, value) of every node of ``walked`` (of :func:`nodes`) that a rule names, each rule once a node.

    Rules on a node alone are decided where the node is read. A rule on an array's members is decided by its objects, whose
    parents are then distinct: an array of any number of members is one row after the first, local step.
    """
    own = [r for r in rules if not r.members]
    hit = F.filter(F.array(*(F.when(r.holds(), F.lit(r.name)) for r in own)), lambda x: x.isNotNull())
    columns = ["path", "size", "value"]
    out = walked.select(*keys, F.explode(hit).alias("rule"), *columns)
    for r in rules:
        if r.members:
            every = F.lit(True)
            for group in r.members:
                every &= F.arrays_overlap("fields", F.array(*map(F.lit, group)))
            inside = walked.where((F.col("kind") == "object") & F.col("name").isNull() & F.col("parent").isNotNull() & every)
            parents = inside.select(*keys, F.col("parent").alias("path")).distinct()
            out = out.unionByName(walked.join(parents, [*keys, "path"], "left_semi").select(*keys, F.lit(r.name).alias("rule"), *columns))
    return out
