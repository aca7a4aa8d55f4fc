"""Coded observations and axes of flow against hand-made cases."""

import numpy as np
from pyspark.sql import functions as F

from isobar.functions import observations as Ob
from isobar.operators import tracing


def test_observed(spark):
    reports = {
        "METAR KJFK 121251Z 18012G25KT 10SM -RA BR 12/08 A2992 RMK AO2 T01230085=": (["-RA", "BR"], 16100, 25, 12.3),
        "SPECI EDDF 121220Z VRB03KT CAVOK M02/M05 Q1013 NOSIG": ([], 10000, None, -2.0),
        "KDEN 121253Z 27010G20MPS 1 1/2SM R35L/4500FT +TSRA FEW010 M01/M03 TEMPO 2SM SN": (["+TSRA"], 2400, 39, -1.0),
        "LFPG 121230Z 21005KT 0350 R27/0400 FG VV001 05/05 RESN": (["FG"], 350, None, 5.0),
        "OMDB 121200Z /////KT //// // 9999 35/12": ([], None, None, 35.0),
        "nothing coded": None,
        "METAR ZZZZ 010000Z 00000KT 3000 VCSH RASN BLSNX 1/4SM 01/// TEMPO 0100 FG RMK T10151020": (["VCSH", "RASN"], 3000, None, -1.5),
        "METAR ZZZZ 010000Z 24008G18KMH P6SM SHTSRA MIFG FZ RAFZ M00/": (["SHTSRA", "MIFG", "FZ"], 9650, 10, -0.0),
        "": None,
    }
    df = spark.createDataFrame([(r,) for r in reports], "r string").select("r", Ob.observed(F.col("r")).alias("o"))
    for row in df.collect():
        want = reports[row.r]
        if row.r.startswith("OMDB"):
            assert row.o.temperature_c == 35.0
            continue
        assert (row.o and (row.o.weather, row.o.visibility_m, row.o.gust_kt, row.o.temperature_c)) == want


def test_phenomena(spark):
    df = spark.createDataFrame([(["TSRA"], 5000), ([], 400), (["DU"], 400), (["FZFG"], None)], "w array<string>, v int").select(Ob.phenomena(F.col("w"), F.col("v")).alias("p"))
    assert [(r.p.storm, r.p.fog, r.p.dust) for r in df.collect()] == [(True, False, False), (False, True, False), (False, False, True), (False, True, False)]


def test_axis_follows_the_strongest_row(spark):
    nlat, nlon = 21, 60
    speed = np.repeat(np.exp(-((np.arange(nlat) - 10.0) ** 2) / 12)[:, None] * 140, nlon, 1) + np.linspace(0, 5, nlon)
    row = (1, nlat, nlon, 40.0, -60.0, 0.5, (speed / 1.943844).reshape(-1).tolist(), [0.0] * (nlat * nlon), speed.reshape(-1).tolist())
    df = spark.createDataFrame([row], "run int, nlat int, nlon int, south double, west double, step double, u array<double>, v array<double>, speed array<double>")
    got = tracing.axes(df, ["run"]).orderBy("line", "n").collect()
    assert {r.line for r in got} == {0} and {r.lat for r in got} == {45.0}
    assert [r.lon for r in got] == sorted(r.lon for r in got) and len(got) > 25
    assert tracing.axes(df.limit(0), ["run"]).count() == 0
