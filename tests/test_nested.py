"""The walk over nested JSON and its rules against a recursive plain version."""

import json
import random
import re

from isobar.operators.nested import Rule, nodes, rule_hits

RULES = (Rule("mail", kinds=("string",), pattern="[a-z]+@[a-z]+"), Rule("table", members=(("code", "icao"), ("lat", "lon"))), Rule("hubs", kinds=("array", "object"), names=("hubs",), least=2))


def kind_of(v):
    return "object" if isinstance(v, dict) else "array" if isinstance(v, list) else "string" if isinstance(v, str) else "boolean" if isinstance(v, bool) else "null" if v is None else "number"


def walk(v, path="$", parent=None, name=None, depth=0):
    kind = kind_of(v)
    yield path, parent, name, kind, len(v) if kind in ("object", "array") else None, depth, v
    for k, x in v.items() if kind == "object" else enumerate(v) if kind == "array" else ():
        yield from walk(x, f"{path}.{k}" if kind == "object" else f"{path}[{k}]", path, k if kind == "object" else None, depth + 1)


def anything(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice(["", "me@host", '{"x": 1}', "[", "é😀", 0, -3.5, True, None, {}, []])
    if rng.random() < 0.5:
        return [anything(rng, depth - 1) for _ in range(rng.randrange(5))]
    return {k: anything(rng, depth - 1) for k in rng.sample(["hubs", "code", "lat", "icao", "lon", "a b", "x"], rng.randrange(6))}


def test_nodes_and_hits_equal_a_plain_walk(spark):
    rng = random.Random(3)
    given = {k: anything(rng, 6) for k in range(60)} | {100: {"a": [[[[[[[[[{"hubs": {"a": 1, "b": 2}}]]]]]]]]]}, 101: [{"code": 1, "lat": 2}, {"code": 3, "lon": None}] * 500}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in given.items()] + [(200, "no json {"), (201, None), (202, "")], "id long, text string")
    walked = nodes(df, ["id"], "text")
    got = {(r.id, r.path, r.parent, r.name, r.kind, r.size, r.depth) for r in walked.collect()}
    want = {(k, *n[:6]) for k, v in given.items() for n in walk(v)} | {(k, "$", None, None, "invalid", None, 0) for k in (200, 201, 202)}
    assert got == want and walked.count() == len(want)
    values = {(r.id, r.path): r.value for r in walked.where("kind = 'string'").collect()}
    assert values == {(k, n[0]): n[6] for k, v in given.items() for n in walk(v) if n[3] == "string"}
    hits = {(k, "mail", n[0]) for k, v in given.items() for n in walk(v) if n[3] == "string" and re.search("[a-z]+@[a-z]+", n[6])}
    hits |= {(k, "hubs", n[0]) for k, v in given.items() for n in walk(v) if n[2] == "hubs" and (n[4] or 0) >= 2}
    hits |= {(k, "table", n[0]) for k, v in given.items() for n in walk(v) if n[3] == "array" and any(isinstance(x, dict) and ("code" in x or "icao" in x) and ("lat" in x or "lon" in x) for x in n[6])}
    found = rule_hits(walked, ["id"], RULES).collect()
    assert {(r.id, r.rule, r.path) for r in found} == hits and len(found) == len(hits)


def test_empty_table(spark):
    walked = nodes(spark.createDataFrame([], "id long, text string"), ["id"], "text")
    assert walked.collect() == [] and rule_hits(walked, ["id"], RULES).collect() == []
