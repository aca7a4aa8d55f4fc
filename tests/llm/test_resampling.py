"""Importance resampling against its SQL and a plain version."""

import hashlib
import math
import re
import zlib

import pytest

from isobar.llm import queries
from isobar.llm.resampling import importance_resample
from tests.oracle import connect, rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, order):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return w, [" ".join(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, order=1, buckets=10_000, least=20, percent=10, seed=2024):
    """(doc_id, n_features, weight, score) of every row, and the ids of those drawn in their order."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for table, counts in ((docs, s), (target, t)):
        for _, text in table:
            for f in features(text, order)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out, fit = [], []
    for i, text in docs:
        words, found = features(text, order)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score))
        if len(words) >= least:
            fit.append((-score, i is None, i or 0))
    return sorted(out, key=str), [(-a, None if n else i) for a, n, i in sorted(fit)][: percent * len(fit) // 100]


def check(df, target, **options):
    given = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want, drawn = plain(given, [(0, r.text) for r in target.select("text").collect()], **options)
    names = {"order": "max_order", "least": "least_words"}
    got = importance_resample(df, target, **{names.get(k, k): v for k, v in options.items()}).collect()
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=str) == want
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in ranked] == drawn


def test_query_equals_sql(spark, data):
    got = queries.queries()["op11_resampling"](spark, data)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert rows(got.toPandas()) == rows(connect(data).sql(queries.oracle_sql()["op11_resampling"]).df())


@pytest.mark.parametrize("order", [1, 3])
def test_odd_rows(spark, odd, docs, order):
    target = spark.createDataFrame([("word1 and word2 and",), (None,), ("",), ("É café ßtraße",)], "text string")
    check(odd, target, order=order, percent=50, least=3, buckets=100)


def test_features_of_several_words(spark, docs, data):
    check(docs.limit(150), spark.read.parquet(f"{data}/benchmark.parquet"), order=2, percent=30)


def test_repeated_rows_are_each_drawn(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(7, text)] * 40 + [(k, f"{text} x{k}") for k in range(60)] + [(None, text)] * 3, "doc_id long, text string")
    for order in (1, 2):
        check(df, df.limit(5), order=order, percent=60)


def test_empty_tables(spark, empty, docs):
    assert importance_resample(empty, docs).collect() == []
    check(docs.limit(30), empty, percent=50)
