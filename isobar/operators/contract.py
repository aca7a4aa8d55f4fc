"""The contract of a nested document as rows: a path, a kind of rule, bounds, a peer; one pass tells what is broken where."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """What the values at ``path`` have to be. In a path, ``[]`` stands for each element of an array.

    kinds: ``there``; ``like`` a ``pattern``; one of ``choices``; ``between`` low and high; ``count`` of elements between low and
    high; ``at least``, ``at most``, ``same`` as the ``peer``; ``cells``: as many elements as the product of the two peers;
    ``rising`` and ``unique`` by the field ``peer`` of an array's elements; ``sum``: the sum of the field ``peer[1]`` of the array
    ``peer[0]``; ``only if``: there exactly where the peer is true. A peer beginning with $ is sought from the document, else
    beside the value. A missing value or peer breaks every rule but ``only if``, unless the rule is ``optional``.
    """

    name: str
    path: str
    kind: str
    low: float | None = None
    high: float | None = None
    pattern: str = ""
    choices: tuple[str, ...] = ()
    peer: str | tuple[str, str] = ""
    optional: bool = False


def _within(value: Column, rule: Rule) -> Column:
    held = F.lit(True)
    if rule.low is not None:
        held &= value >= rule.low
    if rule.high is not None:
        held &= value <= rule.high
    return held


def _holds(rule: Rule, v: Column, peer: Callable[[str], Column]) -> Column:
    field = lambda name: lambda e: e[name]
    match rule.kind:
        case "there":
            return v.isNotNull()
        case "like":
            return v.rlike(rule.pattern)
        case "one of":
            return v.isin(*rule.choices)
        case "between":
            return _within(v, rule)
        case "count":
            return _within(F.size(v), rule)
        case "at least":
            return v >= peer(rule.peer)
        case "at most":
            return v <= peer(rule.peer)
        case "same":
            return v == peer(rule.peer)
        case "cells":
            return F.size(v) == peer(rule.peer[0]) * peer(rule.peer[1])
        case "rising":
            values = F.transform(v, field(rule.peer))
            # An ascending array without repeats is its own sorted distinct values.
            return values == F.array_sort(F.array_distinct(values))
        case "unique":
            return F.size(F.array_distinct(F.transform(v, field(rule.peer)))) == F.size(v)
        case "sum":
            return v == F.aggregate(F.transform(peer(rule.peer[0]), field(rule.peer[1])), F.lit(0).cast("long"), lambda s, x: s + x)
        case "only if":
            return v.isNotNull() == F.coalesce(peer(rule.peer), F.lit(False))
    raise ValueError(f"no such kind of rule: {rule.kind}")


def _sought(at: Column | None, path: str) -> Column:
    for name in path.split("."):
        at = F.col(f"`{name}`") if at is None else at[name]
    return at


def _broken(rule: Rule) -> Column:
    """An array of (rule, path, value), one element for each value of a row that breaks ``rule``."""

    def inside(at: Column | None, path: str, said: Column) -> Column:
        head, *rest = path.split("[].", 1)
        own = F.concat(said, F.lit(f".{head.removesuffix('[]')}"))
        if rest or head.endswith("[]"):
            elements = _sought(at, head.removesuffix("[]"))
            numbered = lambda i: F.concat(own, F.lit("["), i.cast("string"), F.lit("]"))
            if not rest:
                return F.transform(elements, lambda e, i: told(e, at, numbered(i)))
            return F.flatten(F.transform(elements, lambda e, i: inside(e, rest[0], numbered(i))))
        beside, _, _ = head.rpartition(".")
        return F.array(told(_sought(at, head), _sought(at, beside) if beside else at, own))

    def told(v: Column, beside: Column | None, where: Column) -> Column:
        peer = lambda p: _sought(None, p[2:]) if p.startswith("$.") else _sought(beside, p)
        held = F.coalesce(_holds(rule, v, peer), F.lit(False))
        if rule.optional:
            held = held | v.isNull()
        return F.when(~held, F.struct(F.lit(rule.name).alias("rule"), where.alias("path"), v.cast("string").alias("value")))

    return F.filter(F.coalesce(inside(None, rule.path, F.lit("$")), F.array().cast("array<struct<rule:string,path:string,value:string>>")), lambda x: x.isNotNull())


def breaches(documents: DataFrame, keys: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    """(keys, rule, path, value) of everything in ``documents`` that breaks a rule, in one pass and without a shuffle.

    A row is a document; rules reach into its structs and arrays. An array that is null or empty has no values for the rules on
    its elements; ask for it by a rule of its own. No rows: the contract holds.
    """
    found = F.flatten(F.array(*map(_broken, rules)))
    return documents.select(*keys, F.explode(found).alias("b")).select(*keys, "b.*")
