"""Edge cases of views, layers, lines, profiles, bulletins, names and contracts, each with a defined result."""

import math
import random

from pyspark.sql import functions as F

from isobar.functions import profiles, view
from isobar.operators import bulletins as B
from isobar.operators import features, layers, names
from isobar.operators.contract import Rule, breaches
from isobar.plans.notices import FIELDS, GRAMMAR

POINTS = "array<struct<x:double,y:double>>"


def test_view_equals_trigonometry(spark):
    rng = random.Random(3)
    rows = [(k, rng.uniform(-89, 89), rng.uniform(-180, 180)) for k in range(400)] + [(900, None, 3.0), (901, 95.0, 0.0)]
    v, g = view.View(-60, 70, -70, 75, 5.0, under=10.0), view.Grid(-90, -180, 1.0, 180, 360)
    got = {r.i: r.seen for r in view.with_seen(spark.createDataFrame(rows, "i int, lat double, lon double"), "lat", "lon", v, g).collect()}

    def seen(lat, lon):
        if lat is None or not -90 <= lat < 90:
            return False
        lat, lon = math.floor(lat) + 0.5, math.floor(lon) + 0.5
        p, t = math.radians(lat), math.radians(lon - 10)
        dx, dy, dz = 6371 * math.cos(p) * math.cos(t) - 42164, 6371 * math.cos(p) * math.sin(t), 6371 * math.sin(p)
        x, y = math.degrees(math.atan2(dy, -dx)), math.degrees(math.atan2(dz, math.hypot(dx, dy)))
        return -60 <= lat <= 70 and -70 <= lon <= 75 and math.cos(p) * math.cos(t) > 6371 / 42164 and abs(y - x) / math.sqrt(2) <= 5

    assert got == {i: seen(a, b) for i, a, b in rows} and any(got.values())


def test_lines_wrap_leave_and_return(spark):
    line = [(170.0, 0.0, 0.0), (-170.0, 0.0, 10.0), (-150.0, 0.0, 30.0), (-150.0, 50.0, 80.0), (-175.0, 50.0, 105.0), (-175.0, 5.0, 150.0)]
    rows = [("a", k, *p) for k, p in enumerate(line)] + [("b", 0, 175.0, 5.0, 1.0), ("c", 0, None, 5.0, 1.0)]
    df = features.unwrapped(spark.createDataFrame(rows, "g string, k int, x double, y double, kt double"), ["g"], "k")
    assert [r.x for r in df.where("g = 'a'").orderBy("k").collect()] == [170, 190, 210, 210, 185, 185]
    got = {(r["copy"], r.part): [tuple(p) for p in r.points] for r in features.clipped_parts(df, ["g"], "k", (175.0, -10.0, 200.0, 20.0), ["kt"]).collect()}
    assert got == {(0, 1): [(175.0, 0.0, 2.5), (190.0, 0.0, 10.0), (200.0, 0.0, 20.0)], (0, 2): [(185.0, 20.0, 135.0), (185.0, 5.0, 150.0)]}
    west = features.clipped_parts(df, ["g"], "k", (-190.0, -10.0, -160.0, 1.0), ["kt"]).collect()
    assert [(r["copy"], r.part, len(r.points)) for r in west] == [(-360, 1, 3)]


def test_crossings_of_odd_profiles(spark):
    cases = [([10.0, 90.0, 120.0, 100.0, 20.0], 2), ([90.0, 95.0], 0), ([None, 10.0, None, 90.0, None, 10.0], 3), ([], 0), (None, 0), ([100.0, 10.0, 100.0, 10.0, 100.0], 2)]
    df = spark.createDataFrame([(k, v, c) for k, (v, c) in enumerate(cases)], "k int, v array<double>, core int")
    got = [(r.c.below, r.c.above) if r.c else None for r in df.select("k", profiles.crossings(F.array(*(F.lit(i * 10) for i in range(6))), F.col("v"), F.col("core") * 10, 80).alias("c")).orderBy("k").collect()]
    assert got[0] == (8.75, 32.5) and got[1] == (None, None) and got[2] == (27.5, 32.5) and got[3] == (None, None) and got[5] == (10 + 70 / 9, 20 + 20 / 9)


def test_points_near_polygons_equal_every_pair(spark):
    rng = random.Random(9)
    rings = {k: [(x := rng.uniform(-170, 170), y := rng.uniform(-70, 70)), (x + rng.uniform(1, 9), y), (x + rng.uniform(1, 9), y + rng.uniform(1, 5))] for k in range(25)}
    points = {k: (rng.uniform(-180, 180), rng.uniform(-75, 75)) for k in range(400)}
    p = spark.createDataFrame([(k, *v) for k, v in points.items()] + [(999, None, 1.0)], "p int, x double, y double")
    s = spark.createDataFrame([(k, [[{"x": a, "y": b} for a, b in r]]) for k, r in rings.items()] + [(99, [])], f"s int, rings array<{POINTS}>")
    every = p.where("x is not null").crossJoin(s.where("s < 99"))  # 10,000 pairs of a test
    near = F.array_min(F.transform(F.flatten(F.transform("rings", layers.Geo.edges)), lambda e: layers._km_to_edge(F.col("x"), F.col("y"), e)))
    want = {(r.p, r.s) for r in every.where((near <= 400) | layers.P.inside(F.col("x"), F.col("y"), F.col("rings"))).select("p", "s").collect()}
    assert {(r.p, r.s) for r in layers.points_near(p, s, 400.0, cell=7.0).collect()} == want and len(want) > 10


def test_bulletins_that_are_odd(spark):
    texts = [
        (1, "outlook", "no section here"), (2, "outlook", "Tropical Weather Outlook\r\nlost line\n1. A:\r\n body\n\n* note\n2. B:\n"), (3, "hazards", "SYNOPSIS:\nfirst\nsecond\n\nthird\nHAZARDS\n\n\none\nmore\n\ntwo\nDETAILED SUMMARY\nx\nHAZARDS\nagain"),
        (4, "unknown", "HAZARDS\nx"), (5, "hazards", None), (6, "hazards", ""), (None, "hazards", "HAZARDS\nx"),
    ]
    got = {(r.i, r.section, r.item): (r.head, r.text, r.notes) for r in B.items(spark.createDataFrame(texts, "i int, kind string, text string"), ["i"], GRAMMAR).collect()}
    assert got == {
        (2, "areas", 1): ("1. A:", "body", "* note"), (2, "areas", 2): ("2. B:", "", ""), (3, "synopsis", 1): ("first", "second", ""), (3, "synopsis", 2): ("third", "", ""),
        (3, "hazards", 1): ("one", "more", ""), (3, "hazards", 2): ("two", "", ""), (3, "hazards", 3): ("again", "", ""), (None, "hazards", 1): ("x", "", ""),
    }
    none = B.items(spark.createDataFrame([], "i int, kind string, text string"), ["i"], GRAMMAR)
    assert B.fields(none, ["i"], FIELDS).collect() == []


def test_items_are_rows_of_their_lines_and_take_no_groups(spark):
    grammar = (B.Section("a", "^ONE", "one", begins=r"^\d"), B.Section("a", "^TWO:?", "two", notes=r"^\*"), B.Section("b", "^ONE", "one", begins=r"^\s*$"))
    texts = [
        (1, "a", "ONE\n1 x\nw\nTWO: t\n* n\nONE\nback\n2\n"), (None, "a", "ONE\n1\n\n  more  words"), (2, "b", "ONE\n\nafter a blank\n\n"),
        (3, "a", "ONE\n1 y"), (3, "a", "ONE\n1 y"), (4, "a", "ONE\nnothing begins"), (5, None, "ONE\n1"), (6, "a", None),
    ]
    read = B.items(spark.createDataFrame(texts, "i int, kind string, text string"), ["i"], grammar)
    assert sorted(map(tuple, read.collect()), key=str) == sorted([
        (1, "a", "one", 1, "1 x", "w back", ""), (1, "a", "one", 2, "2", "", ""), (1, "a", "two", 1, "t", "", "* n"), (None, "a", "one", 1, "1", "more words", ""),
        (2, "b", "one", 2, None, "after a blank", ""), (3, "a", "one", 1, "1 y", "", ""), (3, "a", "one", 2, "1 y", "", ""),
    ], key=str)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    heads = plan(read.select("i", "section", "item", "head"))
    assert "Aggregate" not in plan(read) and "collect_list" in plan(read) and "collect_list" not in heads
    found = B.fields(read, ["i"], (B.Field("a", "one", "number", "head", r"^(\d)"), B.Field("a", "one", "letter", "head", r"\d( [xz])?"), B.Field("b", "one", "number", "head", r"(\d)")))
    assert "RLIKE(head" not in plan(found)
    assert sorted((r.i, r.item, r.field, r.value) for r in found.where("i < 3").collect()) == [(1, 1, "letter", "x"), (1, 1, "number", "1"), (1, 2, "letter", ""), (1, 2, "number", "2")]


def test_names_equal_brute_force(spark):
    rng = random.Random(5)
    known = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 5))) for _ in range(30)] + ["near at", "near", None, "", "choi-wan", "choi", "a b c d a b c d a"]
    texts = [(k, " ".join(rng.choice(["a", "b", "c", "d", "near", "at", "choi-wan,", "x."]) for _ in range(rng.randrange(40)))) for k in range(60)] + [(77, None), (78, "")]
    got = {(r.k, r.start, r.name) for r in names.mentions(spark.createDataFrame(texts, "k int, t string"), ["k"], "t", spark.createDataFrame([(n,) for n in known], "n string"), "n", ("NEAR", "AT")).collect()}
    listed = {n for n in known if n and 0 < len(n.split()) <= names.LONGEST and set(n.upper().split()) - {"NEAR", "AT"}}
    want = set()
    for k, t in texts:
        w = (t or "").upper().replace(",", "").replace(".", "").split()
        hits = {(i, i + len(n.split()), n) for n in listed for i in range(len(w)) if w[i : i + len(n.split())] == n.upper().split()}
        want |= {(k, a, n) for a, b, n in hits if not any((c, d) != (a, b) and c <= a and b <= d for c, d, _ in hits)}
    assert got == want and got
    assert names.mentions(spark.createDataFrame([], "k int, t string"), ["k"], "t", spark.createDataFrame([], "n string"), "n").collect() == []


def test_runs_of_words_are_compiled_and_end_with_the_text(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "red ring red"), (2, "ring"), (3, None), (4, "ring red ring red ring")], "k int, t string")
    listed = spark.createDataFrame([("RED RING",), ("RING RED RING",), ("RING",), ("RED",)], "n string")
    for few in (names.BROADCAST_NAMES, 0):
        monkeypatch.setattr(names, "BROADCAST_NAMES", few)
        got = names.mentions(texts, ["k"], "t", listed, "n")
        assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, got.collect())) == [(1, 0, 2, "RED RING"), (1, 2, 1, "RED"), (2, 0, 1, "RING"), (4, 0, 3, "RING RED RING"), (4, 2, 3, "RING RED RING")]


def test_words_are_found_once_and_joins_have_one_key(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "red ring red"), (1, "red ring"), (None, "o'neil-red ring red ring"), (3, "?"), (4, ""), (5, None), (6, "ring red")], "k int, t string")
    listed = spark.createDataFrame([("red  ring",), ("RED RING",), ("ring red ring red",), ("O'NEIL-RED RING",), ("blue",), (None,), ("ring",)], "n string")
    for few in (names.BROADCAST_NAMES, 0):
        monkeypatch.setattr(names, "BROADCAST_NAMES", few)
        got = names.mentions(texts, ["k"], "t", listed, "n")
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1 and plan.count("Join Inner") == 2 and "<=>" not in plan
        assert sorted(map(tuple, got.where("k > 1 or k is null").collect()), key=str) == [(6, 0, 1, "ring"), (None, 0, 2, "O'NEIL-RED RING"), (None, 2, 2, "RED RING")]
    again = names.mentions(texts, ["k"], "t", listed.where("false"), "n")
    assert again.collect() == []


def test_contract_tells_path_and_value(spark):
    df = spark.sql("select 1 as k, named_struct('a', array(named_struct('n', 1, 'm', 2), named_struct('n', 3, 'm', 2))) as o, array(1, 3, 2) as r union all select 2, null, null union all select 3, named_struct('a', array(named_struct('n', null, 'm', 5))), array()")
    rules = (Rule("less", "o.a[].n", "at most", peer="m"), Rule("there", "o.a", "there"), Rule("small", "r[]", "between", high=2), Rule("some", "r", "count", low=1), Rule("maybe", "o.a[].n", "between", high=0, optional=True))
    got = {(r.k, r.rule, r.path, r.value) for r in breaches(df, ["k"], rules).collect()}
    assert {g for g in got if g[1] in ("less", "small", "maybe")} == {(1, "less", "$.o.a[1].n", "3"), (3, "less", "$.o.a[0].n", None), (1, "small", "$.r[1]", "3"), (1, "maybe", "$.o.a[0].n", "1"), (1, "maybe", "$.o.a[1].n", "3")}
    assert {g[:3] for g in got if g[1] in ("there", "some")} == {(2, "there", "$.o.a"), (2, "some", "$.r"), (3, "some", "$.r")}
