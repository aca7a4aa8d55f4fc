"""Counters that take back, running totals and plans under limits, against plain versions."""

import datetime
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from isobar.operators.planning import budgeted, spread_rank
from isobar.operators.running import running
from isobar.plans.due import frames_of_events
from isobar.streaming import counters
from isobar.streaming.counters import closed_days, counts, empty_state, keep_counters, merged

FRAMES = "day date, hour int, version long, stray boolean, pixel long"
DAY = datetime.date(2024, 1, 1)


def some_frames(seed, n=400, days=5):
    rng = random.Random(seed)
    return [(DAY + datetime.timedelta(days=rng.randrange(days)), rng.randrange(4), rng.randrange(3), rng.random() < 0.02, rng.choice([None, *range(6)])) for _ in range(n)]


def recount(rows):
    top = defaultdict(lambda: -1)
    for d, h, v, _, _ in rows:
        top[d, h] = max(top[d, h], v)
    stray = {(d, h) for d, h, v, s, _ in rows if s and v == top[d, h]}
    lit = {(d, h, p) for d, h, v, _, p in rows if v == top[d, h] and (d, h) not in stray and p is not None}
    return Counter((d, p) for d, _, p in lit)


def result(state):
    return {(r.day, r.pixel): r.n for r in counts(state).collect()}


def test_any_order_and_repeats_of_batches_equal_a_recount(spark):
    for seed in range(3):
        rows = some_frames(seed)
        random.Random(seed).shuffle(rows)
        batches = [rows[k::5] for k in range(5)]
        batches += [batches[1], batches[0][:20], []]
        random.Random(seed + 9).shuffle(batches)
        state = empty_state(spark)
        for b in batches:
            state = merged(state, spark.createDataFrame(b, FRAMES))
        assert result(state) == recount(rows)


def test_one_stray_hour_takes_back_all_it_gave(spark):
    at = lambda *rows: spark.createDataFrame([(DAY, 3, *r) for r in rows], FRAMES)
    state = merged(empty_state(spark), at((1, False, 7), (1, False, 8)))
    assert result(state) == {(DAY, 7): 1, (DAY, 8): 1}
    state = merged(state, at((1, True, None)))
    assert result(state) == {}
    state = merged(state, at((1, False, 9)))
    assert result(state) == {}
    assert result(merged(state, at((2, False, 9)))) == {(DAY, 9): 1}


def test_final_days_keep_sums_only(spark):
    rows = some_frames(4)
    state = empty_state(spark)
    for k in range(2):
        state = merged(state, spark.createDataFrame(rows[k::2], FRAMES), keep_days=90)
    state = closed_days(state, 2)
    newest = max(r[0] for r in rows)
    final = {d for d, *_ in rows if d <= newest - datetime.timedelta(days=2)}
    assert {r.day for r in state.final.collect()} == final
    assert not final & {r.day for r in state.deltas.collect()} and not final & {r.day for r in state.heads.collect()}
    assert result(state) == recount(rows)
    late = merged(state, spark.createDataFrame([(min(final), 0, 99, False, 1)], FRAMES))
    assert result(late) == recount(rows)


def test_streamed_batches_over_rebases_equal_a_recount(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(counters, "REBASE", 2)
    frames = frames_of_events(spark, data)
    rows = [tuple(r) for r in frames.drop("arrived").collect()]
    for k in range(5):
        frames.where(F.pmod(F.xxhash64("pixel", "hour", "version"), F.lit(5)) == k).drop("arrived").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):
        assert keep_counters(source, str(tmp_path / "state"), str(tmp_path / "check"), 90).awaitTermination(120)
    assert {(r.day, r.pixel): r.n for r in counters.counters(spark, str(tmp_path / "state"), 5).collect()} == recount(rows)


def test_running_totals_with_one_key_of_most_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), k, rng.randrange(5)) for k in range(3_000)]
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(8)
    for keys in ([], ["g"]):
        for current in (True, False):
            got = {r.i: (r.t, r.m) for r in running(df, keys, [F.col("i").desc()], {"t": F.col("v")}, {"m": F.struct("v", "i")}, current=current).collect()}
            sums, most, want = defaultdict(int), {}, {}
            for g, i, v in sorted(rows, key=lambda r: -r[1]):
                k = g if keys else 0
                before = sums[k], most.get(k)
                sums[k], most[k] = sums[k] + v, max(most.get(k, (-1, -1)), (v, i))
                want[i] = (sums[k], most[k]) if current else before
            assert got == want


def test_plan_stays_within_limits_and_says_why(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaab"), k, rng.choice([None, None, "held"]), rng.choice([None, 0, 1, 5, 30])) for k in range(200)]
    got = {r.i: r for r in budgeted(spark.createDataFrame(rows, "host string, i long, state string, cost long"), "host", [F.col("i")], "cost", 300, 400).collect()}
    spent, total, want = Counter(), 0, {}
    for host, i, state, cost in rows:
        if state:
            want[i] = state
            continue
        spent[host] += cost or 0
        if spent[host] > 300:
            want[i] = "limit of its host"
        else:
            total += cost or 0
            want[i] = "chosen" if total <= 400 else "limit in all"
    assert {i: r.reason for i, r in got.items()} == want and set(want.values()) == {"held", "chosen", "limit in all", "limit of its host"}
    assert all(r.chosen == (r.reason == "chosen") for r in got.values())


def test_small_keys_take_one_shuffle_and_large_ones_ranges(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "hot", None, None, *"abcde"]), "ab"[k % 2], k, rng.choice([None, 0, 1, 7])) for k in range(2_000)]
    df = spark.createDataFrame(rows, "g string, h string, i long, v long").repartition(8)
    found = {}
    for many in (100_000, 150, 0):  # none, the hot and the null key, every key is large
        monkeypatch.setattr(f"{running.__module__}.MANY", many)
        for keys in (["g"], ["g", "h"]):
            for current in (True, False):
                got = running(df, keys, [F.col("i").desc()], {"t": F.col("v")}, {"m": F.col("v")}, current=current)
                plan = got._jdf.queryExecution().executedPlan().toString()
                if many == 100_000:
                    assert plan.count("Exchange") == 1 and "_part" not in plan
                else:
                    assert "_part" in plan
                sums, most, want = defaultdict(int), {}, {}
                for g, h, i, v in sorted(rows, key=lambda r: -r[2]):
                    k = (g, h)[: len(keys)]
                    before = sums[k], most.get(k)
                    sums[k], most[k] = sums[k] + (v or 0), max((x for x in (most.get(k), v) if x is not None), default=None)
                    want[i] = (sums[k], most[k]) if current else before
                assert {r.i: (r.t, r.m) for r in got.collect()} == want
                assert found.setdefault((*keys, current), got.schema.simpleString()) == got.schema.simpleString()


def test_plan_computes_its_slots_once(spark):
    rows = [("a", [None, None, "held"], 2), (None, [None, "held", None], 30), ("a", [None, None], None), ("a", [None, None], None)]
    slots = spark.createDataFrame(rows, "host string, s array<string>, cost long").select("host", F.posexplode("s").alias("i", "state"), "cost")
    got = budgeted(slots, "host", [F.col("i"), F.col("cost")], "cost", 31, 33)
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == ["host", "i", "cost", "host_total", "total", "reason", "chosen"]
    said = Counter((r.host, r.i, r.cost, r.host_total, r.total, r.reason, r.chosen) for r in got.collect())
    assert said == Counter([
        ("a", 0, 0, 0, 0, "chosen", True), ("a", 0, 0, 0, 0, "chosen", True), ("a", 0, 2, 2, 2, "chosen", True), (None, 0, 30, 30, 32, "chosen", True),
        ("a", 1, 0, 2, 32, "chosen", True), ("a", 1, 0, 2, 32, "chosen", True), ("a", 1, 2, 4, 34, "limit in all", False), (None, 2, 30, 60, None, "limit of its host", False),
        ("a", 2, 2, None, None, "held", False), (None, 1, 30, None, None, "held", False),
    ])


def test_slots_are_spread(spark):
    got = spark.range(8).select("id", spread_rank(F.col("id").cast("int"), 3).alias("r")).orderBy("r").collect()
    assert [r.id for r in got] == [0, 4, 2, 6, 1, 5, 3, 7]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "host string, i long, state string, cost long")
    assert budgeted(none, "host", [F.col("i")], "cost", 1, 1).collect() == []
    assert result(merged(empty_state(spark), spark.createDataFrame([], FRAMES), keep_days=1)) == {}
