"""The divergence audit against its SQL and exact plain versions; radix selection against sorting."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from isobar.llm import queries
from isobar.llm.divergence import divergence_audit, radix_select
from tests.oracle import connect, rows

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(docs, top=200, least_docs=3):
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept)) for t in kept} if kept else {}
        of, q = {s: p(c) for s, c in groups.items()}, p(sum(groups.values(), Counter()))
        f = lambda x, y: (x - y) ** 2 // y
        for s, c in groups.items():
            pairs = [(-sum(f(of[s][t], of[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(-f(of[s][t], q[t]), t.encode(), t) for t in kept if c[t] and of[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, r + 1) for r, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, r + 1) for r, (v, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def check(df, **options):
    want = plain([(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()], **options)
    got = divergence_audit(df, **options)
    assert [t for _, t in got.dtypes] == ["string"] * 4 + ["bigint", "int"]
    assert sorted(map(tuple, got.collect())) == want
    return want


def test_query_equals_sql(spark, data):
    got = queries.queries()["op13_divergence"](spark, data).toPandas()
    assert rows(got) == rows(connect(data).sql(queries.oracle_sql()["op13_divergence"]).df())


def test_odd_rows(spark, odd, empty):
    check(odd)
    assert divergence_audit(empty).collect() == []


def test_small_groups_ties_and_nulls(spark):
    rng = random.Random(5)
    words = [f"w{'é' * (k % 3)}{'x' * (k % 7)}{chr(97 + k % 26)}" for k in range(400)]
    docs = [(" ".join(rng.choice(words) for _ in range(rng.randrange(120))), rng.choice(["en", "de", None, "x"]), rng.choice(["a", "b", "", None, "é"])) for _ in range(150)]
    docs += [(None, "en", "only empty"), ("Alone", "zz", "one"), ("123", "yy", "p"), (None, "yy", "q"), (docs[0][0], *docs[0][1:])]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    want = check(df, top=20, least_docs=2)
    assert ("yy", "p", "pair", "q", 0, 1) in want


def test_radix_selection_equals_sorting(spark):
    rng = random.Random(2)
    given = [(rng.choice("ab"), rng.choice([0, 1, 7, 2**40, 2**62, 2**63 - 1]), rng.choice(["", "x", "xy", "xyz", "é", "longer" * 20]) + rng.choice(["", "1", "22"])) for _ in range(3_000)] + [("c", 5, "z")]
    df = spark.createDataFrame(given, "g string, v long, i string")
    for k, few in ((5, 5), (50, 60), (400, 401), (5_000, 6_000)):
        got = sorted((r.g, r["rank"], r.v, r.i) for r in radix_select(df, ["g"], "v", "i", k, few=few).collect())
        want = [(g, r + 1, v, i) for g in "abc" for r, (v, i) in enumerate(sorted(((v, i) for x, v, i in given if x == g), key=lambda t: (-t[0], t[1].encode()))[:k])]
        assert got == sorted(want)


def test_salted_joins_give_the_same(spark, docs, monkeypatch):
    from isobar.llm import shared

    few = docs.limit(120)
    want = sorted(map(tuple, divergence_audit(few).collect()))
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, divergence_audit(few).collect())) == want


def test_numbers_run_over_all_ranges(spark):
    from isobar.llm.shared import numbered

    df = spark.range(5_000).select((F.col("id") % 700).alias("v"), "id", F.lit(1).alias("part")).repartition(7)
    want = [i for _, i in sorted((k % 700, k) for k in range(5_000))]
    for upto in (None, 0, 321):
        got = sorted((r.n, r.id) for r in numbered(df, [F.col("v"), F.col("id")], "n", upto).collect() if r.n is not None)
        assert got == [(k + 1, i) for k, i in enumerate(want[: 5_000 if upto is None else upto])]
