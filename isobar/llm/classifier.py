"""Quality classifier: labels from disagreeing labellers, then a hashed linear scorer of bytes trained on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import small_batches, written
from .vectext import Texts, chunks, mix
from .weak import RULES, Rule, appended, code_counts, fit_votes, metrics, vote_codes, votes_in

#: Rows that the scorer is trained on at most: those with the least hash of their id. The label model sees all rows.
TRAIN_ROWS = 3000
#: Values that a step of the training takes at a time.
TRAIN_VALUES = 200_000
HASH_BITS = 15
#: Column of the votes between the two passes.
_VOTED = "isobar_votes_of_the_labellers"


def _grams(part: Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the three bytes from each place on, and the place's text; runs never cross texts. A space stands on both sides."""
    lengths = np.diff(part.offsets)
    padded = np.full(len(part.data) + 2 * len(part), 32, np.uint8)
    of = np.repeat(np.arange(len(part)), lengths)
    padded[np.arange(len(part.data)) + 2 * of + 1] = part.data
    x = padded.astype(np.uint64)
    h = mix(x[:-2] << np.uint64(16) | x[1:-1] << np.uint64(8) | x[2:]) >> np.uint64(64 - bits) if len(x) > 2 else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(part)), lengths + 2)
    same = owner[2:] == owner[:-2]
    return h[same].astype(np.int64), owner[:-2][same]


def _examples(sample: DataFrame, bits: int) -> DataFrame:
    """Votes and hashed runs of each text of (text, votes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.column(0)):
                h, of = _grams(part, bits)
                key, n = np.unique((of << bits) | h, return_counts=True)
                cuts = np.searchsorted(key >> bits, np.arange(len(part) + 1))
                slot = (key & ((1 << bits) - 1)).astype(np.uint32)
                parts = [(slot[a:b].tobytes(), n[a:b].astype(np.float32).tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(part.first_row, len(part)), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())], names=["votes", "slots", "n"])

    return sample.mapInArrow(run, "votes long, slots binary, n binary")


def _train(slots: list[np.ndarray], n: list[np.ndarray], target: np.ndarray, size: int, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Logistic regression on relative frequencies, by full gradients with per-weight steps.

    Rows are taken in parts of about TRAIN_VALUES values, so that the driver holds the values once and little beside them.
    A row counts by how sure its label is (0 at 0.5); classes keep their own shares, so that a table with hardly any bad
    text isn't made to lose good ones.
    """
    weights, bias = np.zeros(size), 0.0
    if not len(target):
        return weights, bias
    bias = float(np.log((target.sum() + 1) / ((1 - target).sum() + 1)))
    begins = np.concatenate([[0], np.cumsum([len(s) for s in slots])])
    cuts = np.unique(np.searchsorted(begins, np.arange(0, begins[-1] + TRAIN_VALUES, TRAIN_VALUES)).clip(0, len(slots)))
    cuts = np.unique(np.concatenate([[0], cuts, [len(slots)]]))
    slot, value = np.concatenate(slots), np.concatenate([x / max(x.sum(), 1) for x in n]) * 100
    importance = np.abs(2 * target - 1)
    squares, bias_squares = np.full(size, 1e-6), 1e-6
    for _ in range(rounds):
        g, bias_g = 1e-5 * weights, 0.0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = slice(begins[a], begins[b])
            row = np.repeat(np.arange(b - a), np.diff(begins[a : b + 1]))
            score = np.bincount(row, value[at] * weights[slot[at]], b - a) + bias
            miss = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target[a:b]) * importance[a:b] / len(target)
            g += np.bincount(slot[at].astype(np.int64), value[at] * miss[row], size)
            bias_g += miss.sum()
        squares += g * g
        bias_squares += bias_g**2
        weights -= 0.1 * g / np.sqrt(squares)
        bias -= 0.1 * bias_g / np.sqrt(bias_squares)
    return weights * 100, bias


def quality_classifier(docs: DataFrame, *, id: str = "doc_id", text: str = "text", into: str = "classifier", rules: tuple[Rule, ...] = RULES, train_rows: int = TRAIN_ROWS, bits: int = HASH_BITS, least: float = 0.5, columns: list[str] | None = None, reread: bool = False) -> DataFrame:  # noqa: A002
    """``docs`` with a struct column: the scorer's ``probability`` of good text, the label model's own, and ``kept``.

    One pass votes and is written; the label model is fitted to all documents' votes. The ``train_rows`` documents with the
    least hash of their id (ties by the hash of their text; a bound on what the driver holds) train the scorer on posterior
    labels. Scores depend on the text alone: equal texts get equal scores. ``kept``: probability of ``least`` or more. An
    empty or null text has one blank run only; the labellers have little against it. ``columns`` of ``docs`` are returned
    (all, by default); a column named ``into`` is replaced. An empty table stays empty.

    With ``reread`` votes are written without the texts, which are read again, and ``weak_probability`` is left out: for a
    ``docs`` that is a table and reads the same each time. Probabilities and verdicts are the same.
    """
    small_batches(docs.sparkSession)
    names = [c for c in (docs.columns if columns is None else columns) if c != into]
    carried = [id] if reread else list(dict.fromkeys([*names, id, text]))
    cast = lambda df, columns: appended(df, text, into, T.StructType([T.StructField("votes", T.LongType())]), lambda part: {"votes": vote_codes(metrics(part), rules)}, columns)
    voted = written(cast(docs, carried), "votes")
    code = F.col(f"`{into}`")["votes"]
    model = fit_votes(*code_counts(voted, code, len(rules)))
    # The hashes alone say which rows they are, so that no other texts move.
    number = F.xxhash64(F.col(f"`{id}`").cast("string"))
    top = voted.select(number.alias("h")).orderBy("h").limit(train_rows).agg(F.max("h").alias("top")).first()["top"]
    near = (number <= F.lit(top)) if top is not None else F.lit(False)
    few = cast(docs.where(near), list(dict.fromkeys([id, text]))) if reread else voted.where(near)
    chosen = few.select(F.col(f"`{text}`").cast("string").alias("text"), code.alias("votes"), number.alias("h"))
    rows = _examples(chosen.orderBy("h", F.xxhash64("text")).limit(train_rows).select("text", "votes"), bits).collect()
    votes = votes_in(np.array([r["votes"] for r in rows], np.int64), len(rules))
    weights, bias = _train([np.frombuffer(r["slots"], np.uint32) for r in rows], [np.frombuffer(r["n"], np.float32) for r in rows], model.posterior(votes), 1 << bits)
    weights = weights.astype(np.float32)

    def work(part: Texts) -> dict[str, np.ndarray]:
        h, of = _grams(part, bits)
        n = np.bincount(of, minlength=len(part))
        score = np.bincount(of, weights[h], len(part)) / np.maximum(n, 1) + bias
        return {"probability": 1 / (1 + np.exp(-np.clip(score, -30, 30)))}

    p, fields = F.col(f"`{into}`")["probability"], T.StructType([T.StructField("probability", T.DoubleType())])
    if reread:
        scored = appended(docs, text, into, fields, work, names)
        return scored.withColumn(into, F.struct(p.alias("probability"), (p >= least).alias("kept")))
    scored = appended(voted.withColumn(_VOTED, code), text, into, fields, work, [*names, _VOTED])
    made = F.struct(p.alias("probability"), model.posterior_of(F.col(_VOTED)).alias("weak_probability"), (p >= least).alias("kept"))
    return scored.select(*(F.col(f"`{c}`") for c in names), made.alias(into))
