"""Every stage of the pipeline, and the whole of it, against plain versions."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from isobar.llm import weak
from isobar.llm.classifier import HASH_BITS, TRAIN_ROWS
from isobar.llm.vectext import mix
from tests.llm.test_tokens import best_fit, library_ids
from tests.llm.test_words import WORD, brute_counts, lowered


def brute_kept(texts):
    """Ids that are the smallest of their group over links at 0.8 between sets of five-word runs."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(lowered(t))
        sets[i] = {hash(tuple(w[k : k + 5])) for k in range(len(w) - 4)} or {tuple(w)}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = {i: x if g == y else g for i, g in group.items()}
    return {i for i, g in group.items() if i == g}


def staged(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return corpus_pipeline.dedup_stage(spark, frame, "")


def row(i, text):
    return (i, text, "en", "s", len(text))


def test_near_duplicates_stage_equals_brute_force(spark):
    """Blocks appended, put in front or cut out, so that planted pairs lie on both sides of 0.8, most of them in 0.80 to 0.85."""
    texts = {}
    for k, extra in enumerate((150, 180, 200, 220, 235, 245, 260, 300)):
        words = [f"w{k}x{j}" for j in range(1000)]
        texts[10 * k] = " ".join(words)
        texts[10 * k + 1] = " ".join(words + [f"e{k}x{j}" for j in range(extra)])
        other = [f"v{k}x{j}" for j in range(1000)]
        texts[10 * k + 2] = " ".join([f"f{k}x{j}" for j in range(extra)] + other)
        texts[10 * k + 3] = " ".join(other)
        third = [f"u{k}x{j}" for j in range(1000)]
        texts[10 * k + 4] = " ".join(third)
        texts[10 * k + 5] = " ".join(third[: 500 - extra // 2] + third[500 + extra // 4 :])
    want = brute_kept(texts)
    assert 0 < len(texts) - len(want) < 24
    got = staged(spark, [row(i, t) for i, t in texts.items()])
    assert {r.doc_id for r in got.collect()} == want


def test_one_of_repeated_rows_stays(spark):
    text = " ".join(f"w{j}" for j in range(50))
    other = " ".join(f"v{j}" for j in range(50))
    rows = [row(5, text), row(5, text), row(6, text), row(7, other), row(7, other), row(7, other + " one more"), row(8, ""), row(None, text)]
    got = sorted((r.doc_id or 0, r.text) for r in staged(spark, rows).collect())
    assert got == sorted([(0, text), (5, text), (7, other), (7, other + " one more"), (8, "")])


SYMBOLS, MARKS = set("#*$%&|<>"), set("!?#*$%&|<>=_~^@+\\/{}[]")


def plain_votes(text):
    """The rules' votes from counts made character by character and word by word."""
    w = WORD.findall(text)
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute_counts(text)
    letter = lambda c: "a" <= c <= "z" or "A" <= c <= "Z" or ord(c) >= 128
    counts = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
        "n_lines": sum(bool(WORD.search(x)) for x in text.split("\n")), "n_upper": sum("A" <= c <= "Z" for c in text), "n_letters": sum(map(letter, text)),
        "n_marks": sum(c in MARKS for c in text), "n_kinds": len(set(w)), "n_doubled": sum(a == b for a, b in zip(w[:-1], w[1:], strict=True)),
        "n_plain_words": sum(letter(x[0]) and (letter(x[-1]) or x[-1] in ",.") for x in w),
    }
    out = []
    for r in weak.RULES:
        x = counts[r.above] / max(counts[r.below], 1)
        up = r.bad > r.good
        good, bad = (x <= r.good, x >= r.bad) if up else (x >= r.good, x <= r.bad)
        out.append(0 if n_words < r.least else 1 if good else -1 if bad else 0)
    return out


def posteriors(texts):
    votes = np.array([plain_votes(t) for t in texts], np.int8).reshape(len(texts), len(weak.RULES))
    combos, counts = np.unique(votes, axis=0, return_counts=True)
    return weak.fit_votes(combos, counts).posterior(votes)


def rules_keep(texts):
    """Of {id: text} the ids that the rules keep."""
    keep = set()
    for (i, t), p in zip(texts.items(), posteriors(texts.values()), strict=True):
        n, *_, repeats = brute_counts(t)
        if n >= 50 and 100 * repeats <= 50 * n and p >= 0.5:
            keep.add(i)
    return keep


def scorer_keeps(texts):
    """Of {id: text}, no more than the training rows, the ids that a dense logistic regression keeps."""
    assert len(texts) <= TRAIN_ROWS
    x = np.zeros((len(texts), 1 << HASH_BITS))
    for k, t in enumerate(texts.values()):
        raw = b" " + t.encode() + b" "
        runs = Counter(raw[j : j + 3] for j in range(len(raw) - 2))
        keys = mix(np.array([int.from_bytes(r, "big") for r in runs], np.uint64)) >> np.uint64(64 - HASH_BITS)
        np.add.at(x[k], keys.astype(np.int64), list(runs.values()))
    x /= x.sum(1, keepdims=True)
    target = posteriors(texts.values())
    sure, scaled = np.abs(2 * target - 1) / len(target), x * 100
    weights, bias = np.zeros(x.shape[1]), np.log((target.sum() + 1) / ((1 - target).sum() + 1))
    squares, bias_squares = np.full(x.shape[1], 1e-6), 1e-6
    for _ in range(150):
        miss = (1 / (1 + np.exp(-np.clip(scaled @ weights + bias, -30, 30))) - target) * sure
        g = scaled.T @ miss + 1e-5 * weights
        squares, bias_squares = squares + g * g, bias_squares + miss.sum() ** 2
        weights, bias = weights - 0.1 * g / np.sqrt(squares), bias - 0.1 * miss.sum() / np.sqrt(bias_squares)
    score = scaled @ weights + bias
    assert np.abs(score).min() > 1e-3  # none so near the limit that rounding decides
    return {i for i, v in zip(texts, score, strict=True) if v >= 0}


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_rules_stage_equals_plain_rules(spark, docs, texts):
    got = corpus_pipeline.rules_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == rules_keep(texts)


def test_classifier_stage_equals_dense_regression(spark, docs, texts):
    """On all documents, where bad ones are many."""
    got = corpus_pipeline.classifier_stage(spark, docs, "")
    assert got.columns == docs.columns
    want = scorer_keeps(texts)
    assert {r.doc_id for r in got.collect()} == want and len(want) < len(texts)


def test_whole_pipeline_equals_plain_stages(spark, data, texts):
    left = texts
    for keep in (rules_keep, scorer_keeps, brute_kept):
        ids = keep(left)
        left = {i: t for i, t in left.items() if i in ids}
    got = corpus_pipeline.run(spark, data).collect()
    ids = library_ids("word_bpe_49k.json", 1)
    want = {}
    for i, t in left.items():
        tokens = ids(t)
        for p, s in enumerate(range(0, len(tokens), 4096)):
            want[i, p] = min(4096, len(tokens) - s)
    assert {(r.doc_id, r.piece): r.length for r in got} == want and len(got) == len(want)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(held) <= best_fit(list(want.values()), 4096)
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
