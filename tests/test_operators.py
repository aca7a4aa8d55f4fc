"""Operators that SQL doesn't reach, against plain versions and by their properties."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.functions import geometry as Geo
from isobar.functions import scalars as S
from isobar.functions import simplification as Si
from isobar.functions import text as X
from isobar.operators import grids as G
from isobar.operators import ordered as O
from isobar.sources import aec, grib2, png, sinks
from isobar.sources import tables as T
from isobar.streaming import state


def fold(events):
    """Windows of one program, one event after another."""
    done, cur = [], None
    for t, cancel, a, b, day in sorted(events, key=lambda e: (e[0], e[1])):
        if cancel:
            if cur and (cur[1] is None or t < cur[1]):
                cur = [cur[0], None if cur[0] is None else max(cur[0], t), cur[2], True]
            if cur:
                done.append(cur)
            cur = None
            continue
        on = cur and (cur[2][-1] == day if cur[1] is None else t <= cur[1] or (a is not None and a <= cur[1] + 60))
        if on:
            timed = a is not None and cur[0] is not None
            cur = [min(cur[0], a) if timed else None, b if timed else None, cur[2] + ([] if day in cur[2] else [day]), False]
        else:
            if cur:
                done.append(cur)
            cur = [a, b, [day], False]
    return done + ([cur] if cur else [])


def test_program_windows(spark):
    rng = random.Random(5)
    rows, want = [], []
    for code in range(60):
        own, t = [], 0
        for _ in range(rng.randrange(1, 9)):
            t += rng.randrange(1, 4000)
            period = rng.random() < 0.8
            a = t + rng.randrange(-50, 500) if period else None
            own.append((t, rng.random() < 0.25, a, a + rng.randrange(60, 6000) if period else None, f"d{t // 5000}"))
        rows += [(code, *e) for e in own]
        want += [(code, w[0], w[1], tuple(w[2]), w[3]) for w in fold(own)]
    df = spark.createDataFrame(rows, "code int, t long, cancel boolean, p_start long, p_end long, day string")
    got = [(r.code, r.start, r.end, tuple(r.days), r.cancelled) for r in O.program_windows(df, ["code"]).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_merged_intervals_sum_is_at_most_the_parts(spark):
    rng = random.Random(1)
    rows = [(k % 5, a, a + rng.randrange(0, 30)) for k in range(200) for a in [rng.randrange(500)]]
    got = O.merged_intervals(spark.createDataFrame(rows, "k int, a int, b int"), ["k"], "a", "b").collect()
    for k in range(5):
        covered = {x for c, a, b in rows if c == k for x in range(a, b)}
        own = sorted((r.a, r.b) for r in got if r.k == k)
        assert sum(b - a for a, b in own) == len(covered)
        assert all(b < c for (_, b), (c, _) in zip(own, own[1:]))


def test_smooth_skips_missing_values(spark):
    v = np.arange(20.0).reshape(4, 5)
    v[1, 2] = np.nan
    row = [None if np.isnan(x) else float(x) for x in v.reshape(-1)]
    got = spark.createDataFrame([(row,)], "v array<double>").select(G.smooth(F.col("v"), 5, 4).alias("s")).first()["s"]
    for j in range(4):
        for i in range(5):
            total = weight = 0.0
            for dj in (-1, 0, 1):
                for di in (-1, 0, 1):
                    if 0 <= j + dj < 4 and 0 <= i + di < 5 and not np.isnan(v[j + dj, i + di]):
                        w = (1 if dj else 2) * (1 if di else 2)
                        total, weight = total + w * v[j + dj, i + di], weight + w
            assert got[5 * j + i] == pytest.approx(total / weight)


def test_run_length_round_trip(spark):
    rng = random.Random(2)
    rows = [([rng.randrange(3) for _ in range(rng.randrange(1, 40))],) for _ in range(50)]
    df = spark.createDataFrame(rows, "v array<int>").withColumn("c", X.run_length(F.col("v")))
    out = df.select("v", X.run_length_decoded(F.col("c")).alias("d"), X.run_length_count(F.col("c")).alias("n")).collect()
    assert all(r.v == r.d and r.n == len(r.v) for r in out)
    bad = spark.createDataFrame([("1*0",), ("a",), ("1,,2",), ("",)], "c string").select(X.run_length_count(F.col("c")).alias("n")).collect()
    assert [r.n for r in bad] == [-1] * 4


def test_half_up_and_wrap(spark):
    df = spark.createDataFrame([(-2.5,), (2.5,), (-0.5,), (1.49,)], "x double")
    assert [r[0] for r in df.select(S.half_up(F.col("x"))).collect()] == [-2, 3, 0, 1]
    lon = spark.createDataFrame([(-180,), (180,), (190,), (-190,), (540,)], "x int").select(S.wrap_180(F.col("x"))).collect()
    assert [r[0] for r in lon] == [180, 180, -170, 170, 180]


def test_rings(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    hole = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]
    rows = [(x, y, [[{"x": a, "y": b} for a, b in r] for r in (ring, hole)]) for x, y in ((5.0, 5.0), (2.0, 2.0), (11.0, 5.0), (5.0, 3.9))]
    df = spark.createDataFrame(rows, f"x double, y double, r array<{Geo.POINTS}>")
    assert [r[0] for r in df.select(Geo.in_rings(F.col("x"), F.col("y"), F.col("r"))).collect()] == [False, True, False, True]
    clipped = df.limit(1).select(Geo.clip_to_box(F.col("r")[0], 5.0, 5.0, 20.0, 8.0).alias("c")).first()["c"]
    assert {(p["x"], p["y"]) for p in clipped} == {(5.0, 5.0), (10.0, 5.0), (10.0, 8.0), (5.0, 8.0)}
    path = [(k / 10, 0.001 * math.sin(k)) for k in range(50)] + [(5.0, 3.0)]
    line = spark.createDataFrame([([{"x": a, "y": b} for a, b in path],)], f"p {Geo.POINTS}")
    assert len(line.select(Si.simplify(F.col("p"), 0.01).alias("s")).first()["s"]) == 3


@pytest.mark.parametrize("template", [0, 2, 3, 41, 42])
def test_grib2_round_trip(spark, tmp_path, template):
    v = np.round(np.cumsum(np.random.default_rng(0).normal(size=(9, 14)), 1) * 3, 1)
    v[2, 3] = np.nan
    (tmp_path / "a.grib2").write_bytes(grib2.encode(v, template=template) * 2)
    spark.dataSource.register(grib2.Grib2Source)
    one = spark.read.format("grib2").load(str(tmp_path)).orderBy("ordinal").collect()
    two = grib2.fields(spark.read.format("binaryFile").load(str(tmp_path))).orderBy("ordinal").collect()
    for rows in (one, two):
        assert [r["ordinal"] for r in rows] == [0, 1] and rows[0]["ni"] == 14 and rows[0]["surface_value"] == 25000.0
        got = np.array([np.nan if x is None else x for x in rows[1]["values"]]).reshape(v.shape)
        assert np.allclose(got, v, atol=0.051, equal_nan=True)


def test_damaged_files_fail():
    good = grib2.encode(np.arange(12.0).reshape(3, 4))
    for bad in (good[:-1], good[:-4] + b"7778", b"GRIX" + good[4:]):
        with pytest.raises(ValueError):
            list(grib2.messages(bad))
    image = png.encode_grey(np.arange(12).reshape(3, 4))
    with pytest.raises(ValueError):
        png.samples(image[:40] + bytes([image[40] ^ 1]) + image[41:])


def test_sectioned_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Time,F_Scale,x\n1130,2,a,b,TX,31.5,-97.1,text, more\n1230,UNK,a,b,TX,31.0,-97.0,t\nTime,Speed,x\n0005,60,a,b,OK,35,-97,t\n")
    lines = T.sectioned(T.numbered_lines(spark, str(tmp_path)), {"Time,F_Scale": "tornado", "Time,Speed": "wind"})
    got = T.storm_events(lines, F.lit("2026-05-01").cast("date")).orderBy("n").collect()
    assert [(r.section, str(r.t), r.magnitude) for r in got] == [("tornado", "2026-05-02 11:30:00", 2.0), ("tornado", "2026-05-01 12:30:00", None), ("wind", "2026-05-02 00:05:00", 60.0)]


def test_json_and_features(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"a": 1}\n{broken\n{"a": 2}\n')
    assert sorted(r.a for r in T.day_files(spark, str(tmp_path / "d.json"), "a long").collect()) == [1, 2]
    doc = '{"features": [{"geometry": {"type": "Polygon", "coordinates": [[[0,0],[1,0],[1,1]]]}, "properties": {"k": "v"}}]}'
    got = T.features(spark.createDataFrame([(doc,), (doc,)], "value string")).collect()
    assert len(got) == 1 and got[0].kind == "Polygon" and [(p.x, p.y) for p in got[0].rings[0]] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]


def test_incremental_equals_full(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).write.parquet(str(tmp_path / "in" / str(k)))
    source = str(tmp_path / "in" / "*")
    for _ in range(2):
        state.keep_hours(spark, source, str(tmp_path / "state"), str(tmp_path / "ck")).awaitTermination(120)
    got = {tuple(r) for r in state.hours(spark, str(tmp_path / "state")).collect()}
    from isobar.plans import registry

    assert got == {tuple(r) for r in registry.queries()["hours_per_cell"](spark, data).select("date", "cell", "hours").collect()}


def test_streaming_windows_equal_batch(spark, data, tmp_path):
    spark.read.parquet(f"{data}/events.parquet").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(state.EVENTS).parquet(str(tmp_path / "in"))
    got = state.run_to_end(state.counts_by_window(stream), "by_window", "complete").collect()
    want = state.counts_by_window(spark.read.parquet(f"{data}/events.parquet")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_given_up(spark):
    rows = [("a", 1, False), ("a", 2, False), ("a", 3, False), ("b", 1, False), ("b", 2, True), ("c", 1, False)]
    got = {r.key: (r.misses, r.state) for r in state.given_up(spark.createDataFrame(rows, "key string, at int, ok boolean")).collect()}
    assert got == {"a": (3, "given up"), "b": (0, "read"), "c": (1, "open")}


def test_publish_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    rules = {"positive": F.col("x") > 0}
    sinks.publish(spark.createDataFrame([(1,), (2,)], "x int"), path, rules, F.col("x"))
    with pytest.raises(ValueError, match="positive"):
        sinks.publish(spark.createDataFrame([(1,), (-2,), (None,)], "x int"), path, rules, F.col("x"))
    assert sorted(r.x for r in sinks.published(spark, path).collect()) == [1, 2]
    assert sorted(r.x for r in sinks.publish(spark.createDataFrame([(3,)], "x int"), path, rules, F.col("x")).collect()) == [3]
    assert sinks.drop_old(spark, path) == 1 and [r.x for r in sinks.published(spark, path).collect()] == [3]
    stamps = spark.range(1).select(sinks.stamp({"a": 1, "b": 2}).alias("p"), sinks.stamp({"b": 2, "a": 1}).alias("q"), sinks.stamp({"a": 1, "b": 3}).alias("r")).first()
    assert stamps.p == stamps.q != stamps.r


@pytest.mark.parametrize("flags", [0, aec.DIFFERENCES, aec.DIFFERENCES | aec.SIGNED, aec.DIFFERENCES | aec.PADDED, aec.SIGNED])
def test_entropy_code_round_trip(flags):
    rng = np.random.default_rng(flags)
    for bits in (3, 8, 12, 20):
        low = -(1 << (bits - 1)) if flags & aec.SIGNED else 0
        for spread in (0, 1, 1 << (bits - 1)):
            v = np.clip(np.cumsum(rng.integers(-spread, spread + 1, 333)), low, low + (1 << bits) - 1)
            data = aec.encode(v, bits, 16, 5, flags)
            assert (aec.decode(data, len(v), bits, 16, 5, flags) == v).all()
            with pytest.raises(ValueError):
                aec.decode(data[: len(data) // 2], len(v), bits, 16, 5, flags)


def test_runs_of_zero_blocks():
    """Option 0 with a unary 4 stands for the rest of the segment; a 1 for two blocks."""
    assert (aec.decode(bytes([0b00000001]), 16 * 3, 8, 16, 3, 0) == 0).all()
    assert (aec.decode(bytes([0b00000101, 0b00000000][:1]) + b"", 16 * 2, 8, 16, 2, 0) == 0).all()


def test_quoted_csv_and_placemarks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,place\n"x, ""y""","two\nlines"\nplain,1\n')
    assert sorted(map(tuple, T.quoted_csv(spark, str(tmp_path / "a.csv"), "name string, place string").collect())) == [("plain", "1"), ('x, "y"', "two\nlines")]
    ring = "<Polygon><outerBoundaryIs><LinearRing><coordinates>1.5,2,0 3,4,0\n 5,6.5,0</coordinates></LinearRing></outerBoundaryIs></Polygon>"
    (tmp_path / "a.kml").write_text(f"<kml><Document><Placemark><name>one</name><description>d</description>{ring}</Placemark><Placemark><name>none</name></Placemark></Document></kml>")
    got = {r.name: r for r in T.placemarks(spark, str(tmp_path / "a.kml")).collect()}
    assert [(p.x, p.y) for p in got["one"].ring] == [(1.5, 2.0), (3.0, 4.0), (5.0, 6.5)] and got["none"].ring is None
