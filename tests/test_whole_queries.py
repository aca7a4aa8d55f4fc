"""Queries over all rows or whole texts against brute force on small tables."""

import math
import random
import re
from datetime import datetime, timedelta

import duckdb

from isobar.operators import lookup as L
from isobar.plans import registry


def run(spark, d, name):
    return registry.queries()[name](spark, str(d)).collect()


def test_interval_join_counts_all(spark, tmp_path):
    day = datetime(1998, 1, 1)
    orders = [(k, 1, day + timedelta(days=k % 5)) for k in range(1, 40)]
    lines = [(k % 9, day + timedelta(days=k % 13, hours=5 * (k % 3))) for k in range(60)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = {}
    for key, t in lines:
        n = sum(a <= t < a + timedelta(days=k % 9) and (t.date() - a.date()).days < 3 for k, _, a in orders)
        if n:
            want[key] = want.get(key, 0) + n
    assert {r.l_orderkey: r.n for r in run(spark, tmp_path, "interval_join_counts")} == want


def test_interval_pairs_from_lists_of_bounded_size(spark):
    """Times of day, equal points and spans, one moment with many of both; a moment meets the spans once."""
    t0 = datetime(1998, 1, 1)
    rng = random.Random(6)
    points = [(k, k % 3, t0 + timedelta(hours=rng.randrange(120))) for k in range(60)] + [(k, 1, t0 + timedelta(hours=50)) for k in range(60, 90)] + [(5, 1, t0), (5, 1, t0), (90, 1, None), (91, None, t0)]
    spans = [(k, k % 3, a := t0 + timedelta(hours=rng.randrange(100)), a + timedelta(hours=rng.randrange(-3, 40))) for k in range(80)]
    spans += [(1000 + k, 1, t0 + timedelta(hours=48), t0 + timedelta(hours=51)) for k in range(40)] + [(1001, 1, t0 + timedelta(hours=48), t0 + timedelta(hours=51)), (2000, 1, None, t0), (2001, 1, t0, None)]
    p, s = spark.createDataFrame(points, "p long, k int, t timestamp_ntz"), spark.createDataFrame(spans, "v long, k int, a timestamp_ntz, b timestamp_ntz")
    want = sorted((i, v) for i, k, t in points for v, m, a, b in spans if None not in (k, t, a, b) and k == m and a <= t < b)
    found = L.interval_pairs(p, s, "t", "a", "b", "v", keys=["k"], at_once=7)
    assert sorted((r.p, r.v) for r in found.collect()) == want and len(want) > 1500
    assert sorted((r.p, r.v) for r in L.interval_join(p, s, "t", "a", "b", keys=["k"]).collect()) == want


def test_interval_join_by_key_meets_each_moment_once(spark, data):
    plan = registry.queries()["interval_join_by_key"](spark, data)._jdf.queryExecution().executedPlan().toString()
    _, lists = plan.split("Generate explode(_live")
    assert re.search(r"\w+Join", lists)[0] == "SortMergeJoin"  # small tables too: no list meets all points of its moment at once


def test_unmentioned_suppliers_all(spark, tmp_path):
    suppliers = [(k, f"Supplier#{k:09d}") for k in range(0, 200, 3)]
    orders = [(k, datetime(1998, 6 + k % 3, 15)) for k in range(300)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame(orders, "o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    texts = [f"Supplier#{k % 80:09d}" for k, t in orders if t >= datetime(1998, 7, 1)]
    want = {k for k, name in suppliers if not any(name in t for t in texts)}
    assert max(want) > 60
    assert {r.s_suppkey for r in run(spark, tmp_path, "unmentioned_suppliers")} == want


def test_texts_are_read_whole(spark, tmp_path):
    far = "x " * 50
    texts = {1: far + "action of the day", 2: far + "beau", 3: far, 4: "the " + far, 5: far + "\n\n  MIT \t License  \nlicence", 6: f" a  b\n\n{far}c", 7: far + "vie de chat"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kinds = {r.doc_id: r.kind for r in run(spark, tmp_path, "title_cascade")}
    assert kinds == {1: "closure", 2: "route", 3: "other", 4: "program", 5: "other", 6: "other", 7: "delay"}
    lines = {r.doc_id: r.line for r in run(spark, tmp_path, "identity_lines")}
    assert lines == {k: " ".join(t.split()) for k, t in texts.items()} | {5: "MIT License"}


def test_compare_models_adds_doubles_in_row_order(spark, tmp_path):
    """Ten times 0.1 is less than 1 in doubles, added one after the other, and the SQL rounds down; over several files too."""
    rng, day = random.Random(5), datetime(1998, 1, 1)
    rows = [(0, "F", 0.1, day)] * 10 + [(0, "O", 1.0, day)]
    rows += [(k, "FOP"[k % 3], rng.randrange(100, 40_000_000) / 100, day + timedelta(days=1 + k % 40)) for k in range(6000)]
    rows += [(7, "F", None, day), (8, "O", 1.0, None), (9, "F", 1.0, None), (10, "F", None, day + timedelta(days=90)), (11, "O", 5.0, day + timedelta(days=90))]
    spark.sparkContext.parallelize(rows, 5).toDF("o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute("set threads = 1")
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    got = sorted((tuple(r) for r in run(spark, tmp_path, "compare_models")), key=lambda r: r[0])
    assert got == sorted(con.execute(registry.oracle_sql()["compare_models"]).fetchall())
    sums = {}
    for _, status, price, t in rows:
        if t and price is not None:
            sums[t.date(), status] = sums.get((t.date(), status), 0.0) + price
    want = {d: math.floor(sums[d, "F"]) - math.floor(sums[d, "O"]) for d, status in sums if status == "F" and (d, "O") in sums}
    assert want[day.date()] == -1 and {r[0]: r[1] for r in got if r[1] is not None} == want
