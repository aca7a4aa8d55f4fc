"""Quality rules under weak supervision: rules vote or abstain, and a posterior decides instead of all-must-pass."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import small_batches, written
from .vectext import Texts
from .weak import RULES, Rule, appended, code_counts, fit_votes, metrics, vote_codes

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FIELDS = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS] + [T.StructField("base_failed", T.BooleanType()), T.StructField("votes", T.LongType())])


def quality_rules(docs: DataFrame, *, text: str = "text", into: str = "rules", rules: tuple[Rule, ...] = RULES, least: float = 0.5, columns: list[str] | None = None, reread: bool = False) -> DataFrame:
    """``docs`` with a struct column: base counts, base_failed, the posterior ``quality`` and ``kept``.

    ``base_failed``: under 50 words, or over half of the words in 3-word runs that occur twice or more. ``kept``: not
    base_failed, and the posterior is ``least`` or more. One pass over the texts counts and votes and is written; the vote
    model is fitted to the counts of all documents' combinations of votes, and the written votes are scored by column
    functions. ``columns`` of ``docs`` are returned (all, by default), so that texts needn't be written where they aren't
    wanted. Null texts count as empty, and an empty text fails the base. Other columns, ids included, pass through
    untouched, so repeated rows and ids get equal verdicts; a column named ``into`` is replaced. An empty table stays empty.

    With ``reread`` the votes alone are written and texts are read and counted a second time: for a ``docs`` that is a table and
    reads the same each time, of which texts would else be written once more.
    """
    small_batches(docs.sparkSession)

    def work(part: Texts) -> dict[str, np.ndarray]:
        m = metrics(part)
        return m | {"base_failed": (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"]), "votes": vote_codes(m, rules)}

    got = F.col(f"`{into}`")
    voted = appended(docs, text, into, _FIELDS, work, columns)
    if reread:
        only = T.StructType([T.StructField("votes", T.LongType())])
        counted = written(appended(docs, text, into, only, lambda part: {"votes": vote_codes(metrics(part), rules)}, []), "votes")
    else:
        counted = voted = written(voted, "votes")
    model = fit_votes(*code_counts(counted, got["votes"], len(rules)))
    quality = model.posterior_of(got["votes"])
    made = [*(got[c].alias(c) for c in (*_COUNTS, "base_failed")), quality.alias("quality"), (~got["base_failed"] & (quality >= least)).alias("kept")]
    return voted.withColumn(into, F.struct(*made))
