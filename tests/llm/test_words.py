"""Operators on words: near-duplicates, rules, classifier, licences, fingerprints."""

import hashlib
import re
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from isobar.llm import fingerprints as fingerprints_module
from isobar.llm import minhash, weak
from isobar.llm.classifier import quality_classifier
from isobar.llm.fingerprints import canonical, collisions, digest, fingerprints, likeness, with_next
from isobar.llm.licences import TEMPLATES, licence_scan, licence_sql
from isobar.llm.minhash import near_duplicates
from isobar.llm.rules import quality_rules
from isobar.llm.vectext import chunks
from tests.oracle import rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(s):
    return s.translate({c: c + 32 for c in range(65, 91)})


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(lowered(t or ""))
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            s, t = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_components_equal_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    base = " ".join(f"w{k}" for k in range(60))
    for k in range(40):  # short and chained copies: each differs from the one before by one more word
        words = base.split()
        words[:k] = [f"x{j}" for j in range(k)]
        texts[10_000 + k] = " ".join(words)
        texts[11_000 + k] = " ".join(f"s{j}" for j in range(k % 9))
        texts[12_000 + k] = " ".join(f"t{j}" for j in range(6 + k % 3))
    want, sizes = brute_components(texts)
    got = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("rest", [0, 10_000])
def test_left_over_pairs_are_found_in_blocks(spark, monkeypatch, rest):
    """With a block of four rows most pairs of a bucket lie in different blocks; with no rest allowed, buckets are cut first."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "REST", rest)
    rng = np.random.default_rng(3)
    base = [f"b{k}" for k in range(300)]
    texts = {}
    for k in range(40):
        w = list(base)
        for j in rng.choice(300, size=int(rng.integers(0, 14)), replace=False):
            w[j] = f"e{k}x{j}"
        texts[k] = " ".join(w)
    want, _ = brute_components(texts)
    got = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_each_text_of_one_id_has_its_links(spark):
    """Ids 1 and 50 stand for several texts each; every text has a near copy under an id of its own."""
    base = {k: [f"t{k}x{j}" for j in range(60)] for k in range(8)}
    rows = [(1 if k < 4 else 50, " ".join(w)) for k, w in base.items()] + [(10 + k, " ".join([*w, "end"])) for k, w in base.items()]
    rows += [(90, " ".join(f"u{j}" for j in range(60)))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {1: 1, 90: 90, 50: 14} | {10 + k: 1 if k < 4 else 14 for k in range(8)}
    assert {(r.doc_id, r.component_id) for r in got} == set(want.items())
    assert len(got) == len(rows)


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    b = np.concatenate([a[:3600], rng.integers(0, 2**63, 400).astype(np.uint64)])
    picks = minhash._picks(280)
    r = minhash.registers(np.repeat([0, 1], 4000), np.concatenate([a, b]), 2, 280, picks)
    e = minhash.estimate((r[0] == r[1]).sum(), 280, np.array([4000]), np.array([4000]))[0]
    assert abs(e - 3600 / 4400) < 0.1


def test_near_duplicates_of_odd_rows(odd, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd).collect()}
    by = {i: (n, c, k) for i, n, c, k in got}
    assert by[1] == (0, 1, True) and by[2] == (0, 2, True) and by[3] == (0, 3, True) and by[4] == (1, 4, True) and by[5] == (1, 5, True)
    assert by[7][1] == 6 and not by[7][2] and by[6][1] == 6 and by[None][1:] == (None, True)
    assert near_duplicates(odd).count() == odd.count()
    assert near_duplicates(empty).count() == 0


def brute_counts(x):
    w = WORD.findall(x)
    tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in x.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", x)), dup, len(covered)


def test_rule_counts_equal_brute_force(docs, odd, empty):
    for df in (docs, odd):
        for r in quality_rules(df).select("text", "rules.*").collect():
            want = brute_counts(r.text or "")
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)
    assert quality_rules(empty).count() == 0
    assert set(quality_rules(odd).columns) == set(odd.columns)


def test_rules_and_classifier_agree_with_labels(spark, docs, data):
    """The posterior is no worse than "all rules must pass", and clean documents stay."""
    labels = spark.read.parquet(f"{data}/labels.parquet")
    got = quality_rules(docs).join(labels, "doc_id").select("text", "quality", "rules").collect()
    votes = np.concatenate([weak.votes_of(weak.metrics(t), weak.RULES) for t in chunks(pa.array([r.text for r in got]))])
    good = np.array([r.quality == 1 for r in got])
    posterior = np.array([r.rules.quality for r in got])
    assert ((posterior >= 0.5) == good).mean() >= ((votes != -1).all(1) == good).mean() - 1e-9
    long = np.array([not r.rules.base_failed for r in got])
    kept = np.array([r.rules.kept for r in got])
    assert kept[good & long].mean() >= 0.99 and kept[~good].mean() <= 0.05
    r = quality_classifier(docs).join(labels, "doc_id").select("quality", "classifier").collect()
    assert np.mean([x.classifier.kept for x in r if x.quality == 1]) >= 0.99
    assert np.mean([x.classifier.kept == (x.quality == 1) for x in r]) >= 0.95


def plain_em(votes, rounds=200):
    """One document at a time, probabilities in plain numbers: an independent form of the same model."""
    n, m = votes.shape
    good = [0.1 if -1 in row else 0.9 for row in votes.tolist()]
    for _ in range(rounds):
        chance = {}
        for j in range(m):
            for c in (True, False):
                up = sum((g if c else 1 - g) for g, row in zip(good, votes, strict=True) if row[j] == 1)
                down = sum((g if c else 1 - g) for g, row in zip(good, votes, strict=True) if row[j] == -1)
                chance[j, c] = (up + (2 if c else 0.5)) / (up + down + 2.5)
        prior = min(max((sum(good) + 1) / (n + 2), 0.01), 0.99)
        new = []
        for row in votes:
            both = {True: prior, False: 1 - prior}
            for j in range(m):
                for c in both:
                    both[c] *= 1 if row[j] == 0 else chance[j, c] if row[j] == 1 else 1 - chance[j, c]
            new.append(both[True] / (both[True] + both[False]))
        done = max(abs(a - b) for a, b in zip(good, new, strict=True)) < 1e-9
        good = new
        if done:
            break
    return np.array(good)


def test_vote_model_equals_a_plain_one():
    """Independent rules share nothing: with each weight undiscounted the posterior is that of the plain form."""
    rng = np.random.default_rng(5)
    truth = rng.random(400) < 0.7
    votes = np.stack([np.where(truth ^ (rng.random(400) < miss), 1, -1) * (rng.random(400) < 0.7) for miss in (0.05, 0.1, 0.2, 0.15)], 1)
    combos, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak.fit_votes(combos, counts)
    whole = weak.Model(model.prior, model.weights / model.share[:, None], model.agreement, model.share)
    assert np.allclose(whole.posterior(votes), plain_em(votes), atol=1e-6)


def test_abstention_says_nothing(spark):
    """A rule that abstains leaves the posterior as it is, and a document on which only good votes fall is kept."""
    rng = np.random.default_rng(6)
    truth = rng.random(5000) < 0.85
    votes = np.stack([np.where(truth ^ (rng.random(5000) < 0.03), 1, -1) * (rng.random(5000) < np.where(truth, 0.9, 0.5)) for _ in range(6)], 1)
    combos, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak.fit_votes(combos, counts)
    assert np.all(model.weights[:, 1] == 0)
    only_good = combos[(combos >= 0).all(1)]
    assert np.all(model.posterior(only_good) >= 0.5)
    codes = (combos.astype(np.int64) + 1) @ 3 ** np.arange(6)
    assert np.array_equal(weak.votes_in(codes, 6), combos)
    got = spark.createDataFrame([(int(c),) for c in codes], "code long").select(model.posterior_of(F.col("code"))).collect()
    assert np.allclose([r[0] for r in got], model.posterior(combos), atol=1e-12)


def test_repeated_rules_count_about_once():
    rng = np.random.default_rng(7)
    truth = rng.random(8000) < 0.8
    one = [np.where(truth ^ (rng.random(8000) < 0.1), 1, -1) for _ in range(3)]
    votes = np.stack([*one, one[0], one[0]], 1)
    combos, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak.fit_votes(combos, counts)
    assert np.all(model.share[[0, 3, 4]] < 0.5) and np.all(model.share[[1, 2]] > 0.6)


def test_columns_can_be_chosen(docs, empty):
    assert quality_rules(docs.limit(20), columns=["doc_id"]).columns == ["doc_id", "rules"]
    assert quality_classifier(docs.limit(20), columns=["doc_id"]).columns == ["doc_id", "classifier"]
    odd_names = docs.limit(20).withColumn("votes", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("rules", F.lit(3))
    assert quality_rules(odd_names).select("`a.b`", "votes", "rules.quality").count() == 20
    assert quality_classifier(odd_names).select("`a.b`", "votes", "rules", "classifier.kept").count() == 20


def test_classifier_of_odd_rows(odd, empty):
    got = quality_classifier(odd).select("doc_id", "classifier.*").collect()
    assert len(got) == odd.count() and all(0 <= r.probability <= 1 for r in got)
    assert len({r.probability for r in got if r.doc_id in (6, 7)}) == 1
    assert quality_classifier(empty).count() == 0


def test_vote_model_finds_the_accurate_rule():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    votes = np.zeros((20_000, 4), np.int8)
    for j, miss in enumerate((0.02, 0.1, 0.3, 0.45)):
        wrong = rng.random(20_000) < miss
        votes[:, j] = np.where(truth ^ wrong, 1, -1) * (rng.random(20_000) < 0.8)
    combos, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak.fit_votes(combos, counts)
    assert np.all(np.diff(model.agreement) < 0) and abs(model.prior - 0.8) < 0.05
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.93


def test_licences_equal_sql(docs, odd, empty):
    whole = docs.select("doc_id", "text").union(odd.where("doc_id is not null and doc_id <> 7").select(F.col("doc_id") + 100_000, "text"))
    con = duckdb.connect()
    documents = whole.toPandas()  # noqa: F841
    con.register("documents", documents)
    assert rows(licence_scan(whole).toPandas()) == rows(con.sql(licence_sql()).df())
    assert licence_scan(empty).count() == 0 and licence_scan(odd).count() == odd.count()
    r = licence_scan(odd).where("doc_id = 9").first()
    assert r.n_base == 4 and r.first_word == 1 and r.base_labels == "apache,cc-by,mit" and "cc-by-nc" in r.labels.split(",")


def form(t):
    nfc = lambda x: unicodedata.normalize("NFC", x)
    return re.sub(r"\s+", " ", nfc(nfc(t).casefold())).strip(" ")


def forms_of(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string")
    return [r.f for r in df.select("k", canonical(F.col("t")).alias("f")).orderBy("k").collect()]


def test_canonical_form(spark):
    texts = ["Ａ É é É", "ế ế é̂", "q̣̇ q̣̇", "Å Ω", "Straße  ΣΑΣ \t x ", "ẛ̣", "", " \n ", "привет Й й", "plain text", "ﬁ ſ ŉ ᾳ İ", "\u1100\u1161\u11a8 가", "a\u0327\u0301 \u00e1\u0327", "\u05e9\u05c1\u05bc", "\u0628\u0651\u064e \u0628\u064e\u0651"]
    assert forms_of(spark, texts) == [form(t) for t in texts]


def test_canonical_form_of_every_character(spark):
    """All assigned characters, each between letters, and random runs of marks, against the standard library's tables."""
    chars = [c for c in map(chr, range(1, 0x110000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    texts = ["".join("a" + c for c in chars[k : k + 64]) for k in range(0, len(chars), 64)]
    rng = np.random.default_rng(8)
    marks = [c for c in chars if unicodedata.combining(c)]
    letters = list("aeouşشش가각") + ["\u1100", "\u1161", "\u11a8", "ǖ", "Ω", "か"]
    for _ in range(1500):
        texts.append("".join(str(rng.choice(letters)) + "".join(rng.choice(marks, int(rng.integers(0, 4)))) for _ in range(4)))
    got = forms_of(spark, texts)
    wrong = [(t, g) for t, g in zip(texts, got, strict=True) if g != form(t)]
    assert not wrong, wrong[:3]
    some = texts[-300:]
    assert forms_of(spark, [unicodedata.normalize("NFD", t) for t in some]) == got[-300:]


def test_fingerprints(spark, odd, empty):
    rows_ = [(1, "Café  x"), (2, "café X"), (3, "cafe x"), (4, None), (5, "")]
    got = {r.doc_id: r.fingerprint for r in fingerprints(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert got[1] == got[2] != got[3] and got[4] == got[5]
    assert got[3][:16] == f"{xxhash.xxh64(b'cafe x', seed=42).intdigest():016x}"
    assert fingerprints(odd).count() == odd.count() and fingerprints(empty).count() == 0


def test_colliding_digests_are_told_apart(spark):
    forms = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", "b"), ("e", "a"), ("f", "z"), ("f", "z")], "digest string, form string")
    got = {tuple(r) for r in collisions(forms).collect()}
    assert got == {("d", "a", "-0"), ("d", "b", "-1")}
    assert collisions(forms.where("digest <> 'd'")) is None
    assert spark.range(1).select(digest(F.lit("x")).alias("d")).first().d == spark.range(1).select(digest(F.lit("x")).alias("d")).first().d


NOTICES = {
    1: "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    2: "Permission is hereby granted, free of charge, to every reader obtaining a copy of this program and attached documentation files (the \"Program\"), to deal in the Program without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    3: "any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    4: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    5: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    6: "free charge person copy software rights license public domain warranty",
    7: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
}


def test_licence_bodies(spark):
    """Whole bodies, a body with other words in places, one without its key phrase, and loose words."""
    frame = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in NOTICES.items()], "doc_id long, text string, _a int, _p int, words int")
    got = {r.doc_id: r for r in licence_scan(frame).collect()}
    assert {i: r.labels for i, r in got.items()} == {1: "mit", 2: "mit", 3: "", 4: "apache,apache-2.0", 5: "agpl", 6: "", 7: "bsd,bsd-3-clause"}
    assert got[1].score == 1.0 and 0.8 < got[2].score < 1.0 and got[3].score == 0.0 and got[1]._a == 1 and got[1].words == 3
    con = duckdb.connect()
    con.register("documents", frame.select("doc_id", "text").toPandas())
    assert rows(licence_scan(frame.select("doc_id", "text")).toPandas()) == rows(con.sql(licence_sql()).df())


def test_licences_of_random_words_equal_sql(spark):
    """Texts of template words only, in and out of order, so that alignments, gaps and repeats abound."""
    rng = np.random.default_rng(9)
    phrases = [t.phrase.replace(" .", "") for t in TEMPLATES]
    texts = []
    for k in range(250):
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            w = phrases[int(rng.integers(len(phrases)))].split()
            for _ in range(int(rng.integers(0, max(len(w) // 3, 1)))):
                w[int(rng.integers(len(w)))] = str(rng.choice(["copy", "the", "zz", "license"]))
            if rng.random() < 0.3:
                w.insert(int(rng.integers(len(w))), "inserted")
            parts.append(" ".join(w))
        texts.append((k, " ".join(parts)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    assert rows(licence_scan(frame).toPandas()) == rows(con.sql(licence_sql()).df())


def brute_likeness(rows_):
    """(doc_id, text) in ascending order of ids, all different."""
    rows_ = sorted((i, t or "") for i, t in rows_)
    out = {}
    for k, (i, t) in enumerate(rows_):
        after = rows_[(k + 1) % len(rows_)][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), float(form(edited) == form(t)), float(form(after) == form(t)), form(t), form(edited))
    return out


def same_likeness(spark, rows_):
    got = {r.doc_id: r for r in likeness(spark.createDataFrame(rows_, "doc_id long, text string").withColumn("form", F.lit(1)).withColumn("h", F.lit(2))).collect()}
    want = brute_likeness(rows_)
    assert {i: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for i, r in got.items()} == {i: w[:4] for i, w in want.items()}
    mark = {}
    for i, r in got.items():
        assert mark.setdefault(want[i][4], r.fingerprint) == r.fingerprint
    assert len(set(mark.values())) == len(mark)
    assert all(r.edited_fingerprint == r.fingerprint for i, r in got.items() if want[i][4] == want[i][5])


def test_likeness_equals_brute_force(spark, docs, empty, odd):
    extremes = [(-9_000_000_000_000_000_000, "Café one"), (9_000_000_000_000_000_000, "x"), (9_000_000_000_000_000_001, None)]
    rows_ = [(r.doc_id, r.text) for r in docs.limit(400).collect()] + [(10_000_000 + k, f"Ä  copy {k // 3}") for k in range(90)] + extremes + [(20_000_000, ""), (20_000_001, "abc"), (20_000_002, "ABC")]
    same_likeness(spark, rows_)
    assert likeness(empty).count() == 0 and likeness(odd).count() == odd.count()


def test_likeness_with_colliding_digests(spark, monkeypatch):
    """Every text gets one of two digests, so that bytes alone tell them apart."""
    monkeypatch.setattr(fingerprints_module, "digest", lambda f: F.concat(F.lit("d"), F.pmod(F.length(f), F.lit(2)).cast("string")))
    same_likeness(spark, [(k, f"text number {k % 7}" + "x" * (k % 3)) for k in range(40)])


def test_likeness_of_repeated_rows(spark):
    """Rows of one id with one text follow one another; only the last of them sees another text."""
    rows_ = [(1, "aaaaaaaa")] * 5 + [(2, "bbbbbbbb"), (None, "cccccccc"), (None, "cccccccc")]
    got = sorted((r.doc_id or 0, r.near_next, r.edited_sha256) for r in likeness(spark.createDataFrame(rows_, "doc_id long, text string")).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(0, 1.0, sha("cccccccc")), (0, 0.0, sha("ccccccaa")), (2, 0.0, sha("bbbbbbcc")), (1, 0.0, sha("aaaaaabb"))] + [(1, 1.0, sha("aaaaaaaa"))] * 4
    assert got == sorted(want)


def test_fingerprints_leave_other_columns(spark):
    got = fingerprints(spark.createDataFrame([("keepme", "Hello", 1)], "form string, text string, `a.b` int").withColumn("mark", F.lit(5))).first()
    assert got.form == "keepme" and got["a.b"] == 1 and got.mark == 5


def test_next_text(spark, docs, empty):
    rows_ = [(k * k * 37 % 5003, f"t{k}") for k in range(3000)]
    rows_ = list({i: (i, t) for i, t in rows_}.values())
    got = {r.doc_id: r.next_text for r in with_next(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    ordered = sorted(rows_)
    assert got == {i: ordered[(k + 1) % len(ordered)][1] for k, (i, _) in enumerate(ordered)}
    assert with_next(spark.createDataFrame([(5, "only")], "doc_id long, text string")).first().next_text == "only"
    assert with_next(empty).count() == 0
