"""Votes of overlapping rules on text quality, and the latent class that explains them.

Each rule votes 1 (good), -1 (bad) or 0 (abstains, which says nothing of either class). A two-class model with its own
vote probabilities for each rule and class is fitted by expectation-maximisation over how often each combination of votes
occurs: the combinations are bounded by 3 ** rules whatever the number of documents, so only their counts go to the
driver. Rules that agree beyond what the classes explain then share their weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectext import _SPACE, Texts, chunks, span_hashes, windows, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?#*$%&|<>=_~^@+\\/{}[]")] = True
_END = np.zeros(256, bool)
_END[list(b".!?:;\"')")] = True
_FIRST_BYTE = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeats(group: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each (group, hash) occurs more than once."""
    order = np.lexsort((h, group))
    g, x = group[order], h[order]
    same = np.zeros(len(x) + 1, bool)
    same[1:-1] = (g[1:] == g[:-1]) & (x[1:] == x[:-1])
    out = np.zeros(len(x), bool)
    out[order] = same[1:] | same[:-1]
    return out


def metrics(t: Texts) -> dict[str, np.ndarray]:
    """Counts of each text, as int64 arrays; an empty text has zeros throughout."""
    n, data = len(t), t.data
    w = words(t)
    hashes = span_hashes(data, w.start, w.end)
    h, of, at = windows(w, hashes, 3)
    covered = np.zeros(len(hashes) + 1, bool)
    twice = at[_repeats(of, h)]
    for k in range(3):
        covered[twice + k] = True
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([t.offsets[:-1], breaks, breaks + 1, t.offsets[1:]]))
    edges = edges[edges <= len(data)]
    start, end = edges[:-1], edges[1:]
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_SPACE[data], out=inside[1:])
    lines = inside[end] > inside[start]
    start, end = start[lines], end[lines]
    line_of = np.searchsorted(t.offsets, start, "right") - 1
    line_hash = span_hashes(data, start, end)
    order = np.lexsort((line_hash, line_of))
    again = (line_hash[order][1:] == line_hash[order][:-1]) & (line_of[order][1:] == line_of[order][:-1])
    dup_lines = np.bincount(line_of[order][1:][again], minlength=n)
    word_order = np.lexsort((hashes, w.text))
    kinds = np.ones(len(hashes), bool)
    kinds[1:] = (hashes[word_order][1:] != hashes[word_order][:-1]) | (w.text[word_order][1:] != w.text[word_order][:-1])
    follows = (hashes[1:] == hashes[:-1]) & (w.text[1:] == w.text[:-1])
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": _per_text(_FIRST_BYTE[data] & ~_SPACE[data], t.offsets),
        "n_symbols": _per_text(_SYMBOL[data], t.offsets),
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": np.bincount(w.text[covered[:-1]], minlength=n).astype(np.int64),
        "n_lines": np.bincount(line_of, minlength=n).astype(np.int64),
        "n_upper": _per_text(_UPPER[data], t.offsets),
        "n_letters": _per_text(_LETTER[data] & _FIRST_BYTE[data], t.offsets),
        "n_marks": _per_text(_MARK[data], t.offsets),
        "n_kinds": np.bincount(w.text[word_order][kinds], minlength=n).astype(np.int64),
        "n_doubled": np.bincount(w.text[1:][follows], minlength=n).astype(np.int64),
        "n_plain_words": np.bincount(w.text[_LETTER[data[w.start]] & (_LETTER[data[w.end - 1]] | (data[w.end - 1] == 44) | (data[w.end - 1] == 46))] if len(w.start) else np.zeros(0, int), minlength=n).astype(np.int64),
    }


@dataclass(frozen=True)
class Rule:
    """Bad beyond ``bad``, good up to ``good``, abstaining between and where ``least`` words are not reached."""

    name: str
    above: str
    below: str
    good: float
    bad: float
    least: int = 1

    def votes(self, m: dict[str, np.ndarray]) -> np.ndarray:
        x = m[self.above] / np.maximum(m[self.below], 1)
        up = self.bad > self.good
        v = np.where((x <= self.good) if up else (x >= self.good), 1, np.where((x >= self.bad) if up else (x <= self.bad), -1, 0))
        return np.where(m["n_words"] >= self.least, v, 0)


#: Shares and their limits; the gap between "good" and "bad" is where a rule abstains.
RULES = (
    Rule("symbols", "n_symbols", "word_chars", 0.02, 0.08),
    Rule("marks", "n_marks", "n_words", 0.10, 0.40),
    Rule("repeats", "n_repeat_words", "n_words", 0.15, 0.40, 30),
    Rule("doubled words", "n_doubled", "n_words", 0.03, 0.15, 10),
    Rule("repeated lines", "n_dup_lines", "n_lines", 0.10, 0.40, 30),
    Rule("capitals", "n_upper", "n_letters", 0.20, 0.50),
    Rule("variety", "n_kinds", "n_words", 0.35, 0.12, 50),
    Rule("plain words", "n_plain_words", "n_words", 0.90, 0.60),
)


def votes_of(m: dict[str, np.ndarray], rules: tuple[Rule, ...]) -> np.ndarray:
    return np.stack([r.votes(m) for r in rules], 1).astype(np.int8)


def vote_codes(m: dict[str, np.ndarray], rules: tuple[Rule, ...]) -> np.ndarray:
    """The votes of a text as one number: base 3, the first rule's digit last, digits 0 (bad), 1 (abstains), 2 (good)."""
    return (votes_of(m, rules).astype(np.int64) + 1) @ 3 ** np.arange(len(rules))


def votes_in(codes: np.ndarray, n_rules: int) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(n_rules) % 3 - 1).astype(np.int8).reshape(-1, n_rules)


@dataclass(frozen=True)
class Model:
    """The share of good documents, and log P(vote | good) - log P(vote | bad) by rule for votes -1, 0 (always zero) and 1.

    ``agreement`` is each rule's share of votes that agree with the posterior, ``share`` what correlation left of its weight.
    """

    prior: float
    weights: np.ndarray
    agreement: np.ndarray
    share: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        x = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j in range(votes.shape[1]):
            x += self.weights[j, votes[:, j].astype(np.int64) + 1]
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    def posterior_of(self, code: Column) -> Column:
        """The same from a column of vote codes."""
        x = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for j, (bad, _, good) in enumerate(self.weights.tolist()):
            digit = F.pmod(F.floor(code / F.lit(3**j)), F.lit(3))
            x = x + F.when(digit == 0, F.lit(bad)).when(digit == 2, F.lit(good)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(x, F.lit(40.0)), F.lit(-40.0))))


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Model:
    """Expectation-maximisation over the occurring combinations of votes.

    It starts from "bad if any rule says so"; only documents on which a rule votes say anything about it. Pseudo-votes (two
    right ones and half a wrong one for each rule and class) keep probabilities off 0 and 1. After the last round each
    rule's weight is divided by one plus the sum of its positive within-class correlations with the other rules: rules
    that repeat one another count about once. Without any document the model is even-handed.
    """
    m = votes.shape[1]
    if not len(votes):
        return Model(0.5, np.zeros((m, 3)), np.full(m, 0.5), np.ones(m))
    counts = counts.astype(np.float64)
    up, down = (votes == 1).astype(np.float64), (votes == -1).astype(np.float64)
    cast = up + down
    good = np.where((votes == -1).any(1), 0.1, 0.9)
    for _ in range(rounds):
        on_good, on_bad = counts * good, counts * (1 - good)
        p, q = (on_good @ up + 2) / (on_good @ cast + 2.5), (on_bad @ up + 0.5) / (on_bad @ cast + 2.5)
        prior = float(np.clip((on_good.sum() + 1) / (counts.sum() + 2), 0.01, 0.99))
        weights = np.stack([np.log((1 - p) / (1 - q)), np.zeros(m), np.log(p / q)], 1)
        new = Model(prior, weights, p, np.ones(m)).posterior(votes)
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    covariance = np.zeros((m, m))
    for weight, mean in ((counts * good, p), (counts * (1 - good), q)):
        x = (up - mean) * cast
        covariance += (x * weight[:, None]).T @ x
    spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    with_others = np.clip(covariance / np.outer(spread, spread), 0, 1)
    np.fill_diagonal(with_others, 1)
    share = 1 / with_others.sum(1)
    agree = (counts * good) @ up + (counts * (1 - good)) @ down
    return Model(prior, weights * share[:, None], agree / np.maximum(counts @ cast, 1), share)


def code_counts(voted: DataFrame, code: Column, n_rules: int) -> tuple[np.ndarray, np.ndarray]:
    """Every occurring combination of votes over all rows of ``voted``, and its count."""
    found = sorted((r["code"], r["n"]) for r in voted.groupBy(code.alias("code")).agg(F.count("*").alias("n")).collect())
    return votes_in(np.array([c for c, _ in found], np.int64), n_rules), np.array([n for _, n in found], np.int64)


def appended(docs: DataFrame, text: str, into: str, fields: T.StructType, work, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all, by default) with the struct column ``into`` that ``work(Texts) -> {field: array}`` gives.

    A column of that name is replaced.
    """
    names = [c for c in (docs.columns if columns is None else columns) if c != into]
    # Python steps don't take names with dots, so that columns go by number inside.
    source = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)), *([] if text in names else [F.col(f"`{text}`").alias("text")]))
    back, at = [f"c{k}" for k in range(len(names))], (names.index(text) if text in names else len(names))
    kinds = pa.struct([(f.name, {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[f.dataType.simpleString().replace("bigint", "long")]) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.column(at)):
                got = work(part)
                made = pa.StructArray.from_arrays([pa.array(got[f.name]).cast(f.type) for f in kinds], fields=list(kinds))
                yield pa.RecordBatch.from_arrays([*(c.slice(part.first_row, len(part)) for c in batch.columns[: len(back)]), made], names=[*back, "made"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields[: len(back)], T.StructField("made", fields)])).toDF(*names, into)
