"""Divergence of sources from each other and from their language, and the terms that mark a source.

Counts are sparse: a term that a source lacks has the source's baseline probability. The divergence of two sources is the
baseline's for all terms, corrected for the terms of one (from a histogram of its counts) and for those of both (term by
term). The terms that mark a source are its greatest values, found by radix selection: histograms over the leading digits
of a sort key (the value's bits, then the term's UTF-8 bytes) narrow each group down until few rows are left to sort.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import beside, written

#: Terms, of which A-Z are lower-cased then. In UTF-8 they are runs of letters and of bytes beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = bytes(b | 32 if chr(b) in UPPER else b if b > 127 or chr(b) in LOWER else 32 for b in range(256))
#: Terms that a task holds before it hands on its sums.
HELD = 300_000
#: Documents of a language that a term needs, the unit of probabilities, and terms listed for a source.
LEAST_DOCS, UNIT, TOP = 3, 1_000_000_000, 200
#: Hex digits of a sort key that one histogram covers, and rows of a group that may be left to sort.
DIGITS, FEW = 4, 2_000
_GROUP = ["lang", "source"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a task's texts, handed on whenever HELD terms have come together."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in held.items():
            terms = pa.array([None, *n], pa.binary()).cast(pa.string())
            k = len(terms)
            yield pa.record_batch([pa.array([lang] * k), pa.array([source] * k), terms, pa.array([0, *n.values()], pa.int64()), pa.array([0, *(df[t] for t in n)], pa.int64())], names=["lang", "source", "term", "n", "df"])

    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for text, lang, source in zip(texts, batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True):
            n, df = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            terms = text.translate(_SPLIT).split()
            n.update(terms)
            df.update(set(terms))
            size += len(n)
            if size >= HELD:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term; a null term for each group keeps those without terms.

    Sums start where the texts are read, so that a group of a third of all rows sends each term a few times a task.
    """
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
    given = docs.select(name(text), name(lang), name(source)).toDF("text", "lang", "source")
    rows = given.mapInArrow(_counted, "lang string, source string, term string, n long, df long")
    return rows.groupBy(*_GROUP, "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _kept(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, total, first) of the kept terms; ``first`` marks one row of each of a language's terms."""
    own = Window.partitionBy("lang", "term")
    rows = counts.where("term is not null").withColumn("df", F.sum("df").over(own)).withColumn("total", F.sum("n").over(own))
    return rows.withColumn("first", F.row_number().over(own.orderBy("source")) == 1).where(F.col("df") >= least_docs).drop("df")


def _p(count: Column, total: Column, terms: Column, unit: int) -> Column:
    """1 + floor(unit (count + 1) / (total + terms)), exact for counts of any size; null without kept terms."""
    dividend = (count + 1).cast("decimal(19,0)") * F.lit(unit).cast("decimal(10,0)")
    return F.call_function("div", dividend, F.when(terms > 0, total + terms).cast("decimal(19,0)")).cast("long") + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def radix_select(rows: DataFrame, group: list[str], value: str, item: str, k: int, *, few: int = FEW) -> DataFrame:
    """The ``k`` rows of each group with the greatest ``value`` (a long of at least 0; on ties the smaller UTF-8 ``item``), with ``rank``.

    Each round counts the rows by the next digits of their sort key, for all groups at once; the digits where the k-th row
    lies narrow the group's prefix. It ends when no group has more than ``few`` rows at its prefix: those and the ones before
    are sorted. A histogram has about 16^DIGITS digits at most, so no task ever holds a group's rows. Repeated
    rows count as often as they occur; ranks of full ties are arbitrary among them.
    """
    greatest = rows.agg(F.max(value).alias("m")).first().m
    width = len(f"{max(greatest or 0, 1):X}")
    # An item's end sorts before any byte that could follow.
    key = F.concat(F.lpad(F.hex(F.lit(min(16**width, 2**63) - 1) - F.col(value)), width, "0"), F.hex(F.col(item).cast("binary")), F.lit("!"))
    keyed = rows.withColumn("key", key)
    state: DataFrame | None = None
    at = 0
    while True:
        digit = F.substring("key", at + 1, DIGITS).alias("digit")
        if state is None:
            counted = keyed.groupBy(*group, digit).agg(F.count("*").alias("m"))
            counted = counted.withColumn("prefix", F.lit("")).withColumn("need", F.lit(k).cast("long"))
        else:
            asked = state.where(~F.col("done"))
            counted = beside(keyed, asked.select(*group, "prefix", "need"), group, "inner").where(F.col("key").startswith(F.col("prefix")))
            counted = counted.groupBy(*group, "prefix", "need", digit).agg(F.count("*").alias("m"))
        order = Window.partitionBy(*group).orderBy("digit")
        upto = counted.withColumn("upto", F.sum("m").over(order)).withColumn("rest", F.sum("m").over(Window.partitionBy(*group)))
        # The digits at which the k-th row lies; a group of fewer rows ends with its last digits.
        here = upto.where((F.col("upto") >= F.least("need", "rest")) & (F.col("upto") - F.col("m") < F.least("need", "rest")))
        # At the end of a key all its rows are equal: there is nothing left to narrow.
        done = (F.col("m") <= few) | F.col("digit").endswith("!")
        new = here.select(*group, F.concat("prefix", "digit").alias("prefix"), (F.col("need") - (F.col("upto") - F.col("m"))).alias("need"), done.alias("done"))
        state = written(new if state is None else new.unionByName(state.where("done")), "radix")
        if not state.where(~F.col("done")).limit(1).count():
            break
        at += DIGITS
    near = beside(keyed, state.select(*group, "prefix"), group, "inner").where((F.col("key") < F.col("prefix")) | F.col("key").startswith(F.col("prefix")))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("key"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select(*rows.columns, "rank")


def _pairs(kept: DataFrame, groups: DataFrame, unit: int) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language: the sum over all kept terms, made from those they hold.

    ``groups`` (lang, source, n, terms, p0) has the baseline p0. Terms of one source alone change the baseline's f by amounts
    that depend on their count only, so each distinct count is worked on once; terms of both are corrected term by term.
    """
    mine, other = groups.select("lang", "source", "n", "terms", "p0"), groups.select("lang", F.col("source").alias("item"), F.col("n").alias("n_b"), F.col("p0").alias("p0_b"))
    two = mine.join(other, "lang").where(F.col("source") != F.col("item"))
    base = two.select("lang", "source", "item", (F.col("terms") * F.coalesce(_f(F.col("p0"), F.col("p0_b")), F.lit(0))).alias("v"))
    levels = kept.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    of_a = levels.join(two, ["lang", "source"]).select("lang", "source", "item", (F.col("m") * (_f(F.col("p"), F.col("p0_b")) - _f(F.col("p0"), F.col("p0_b")))).alias("v"))
    of_b = levels.withColumnRenamed("source", "item").join(two, ["lang", "item"]).select("lang", "source", "item", (F.col("m") * (_f(F.col("p0"), F.col("p")) - _f(F.col("p0"), F.col("p0_b")))).alias("v"))
    a, b = (kept.select("lang", "term", F.col("source").alias(f"s_{x}"), F.col("p").alias(f"p_{x}"), F.col("p0").alias(f"z_{x}")) for x in "ab")
    both = a.join(b, ["lang", "term"]).where("s_a < s_b")
    more = lambda x, y: F.sum(_f(F.col(f"p_{x}"), F.col(f"p_{y}")) - _f(F.col(f"p_{x}"), F.col(f"z_{y}")) - _f(F.col(f"z_{x}"), F.col(f"p_{y}")) + _f(F.col(f"z_{x}"), F.col(f"z_{y}")))
    held = both.groupBy("lang", "s_a", "s_b").agg(more("a", "b").alias("ab"), more("b", "a").alias("ba"))
    of_both = held.select("lang", F.explode(F.array(F.struct(F.col("s_a").alias("source"), F.col("s_b").alias("item"), F.col("ab").alias("v")), F.struct(F.col("s_b").alias("source"), F.col("s_a").alias("item"), F.col("ba").alias("v")))).alias("x")).select("lang", "x.*")
    parts = [x.groupBy("lang", "source", "item").agg(F.sum("v").alias("v")) for x in (base, of_a, of_b)]
    out = parts[0]
    for more_of in (*parts[1:], of_both):
        out = out.unionByName(more_of)
    return out.groupBy("lang", "source", "item").agg(F.sum("v").alias("value"))


def divergence_audit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, unit: int = UNIT, top: int = TOP
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of the parts ``pair`` and ``term``, whatever the columns of ``docs`` are called.

    A language keeps the V terms that at least ``least_docs`` of its documents (rows, repeated ones included) hold. Each
    (lang, source) and each language gives a kept term p = 1 + floor(unit (count + 1) / (N + V)), N being its count of all
    kept terms, and f = floor((p - q)^2 / q). ``pair``: f summed over all kept terms for every other source of the language, q
    being that source's p; 0 if V is 0. ``term``: f of the kept terms that the source holds more often than its language, q
    being the language's p; the ``top`` greatest. Ranks go by value, the greatest first, then by the item's UTF-8 bytes.

    Nulls in text, lang and source are empty strings; a source without terms is a group as others are, and a language of
    one source has no pairs. All numbers are exact. An empty table gives an empty result. Other columns are left out.
    """
    counts = written(term_counts(docs, text=text, lang=lang, source=source), "terms")
    kept = written(_kept(counts, least_docs), "kept")
    by_lang = kept.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("n_lang"))
    held = kept.groupBy(*_GROUP).agg(F.sum("n").alias("n_group"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = counts.where("term is null").select(*_GROUP).join(held, _GROUP, "left").join(by_lang, "lang", "left").select(*_GROUP, zero("n_group"), zero("terms"), zero("n_lang"))
    groups = written(groups.withColumn("p0", _p(F.lit(0), F.col("n_group"), F.col("terms"), unit)), "groups")
    full = beside(kept, groups, _GROUP).withColumn("p", _p(F.col("n"), F.col("n_group"), F.col("terms"), unit))
    full = written(full.withColumn("q", _p(F.col("total"), F.col("n_lang"), F.col("terms"), unit)).select(*_GROUP, "term", "p", "p0", "q"), "probabilities")
    pairs = _pairs(full, groups.withColumnRenamed("n_group", "n"), unit)
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.col("value").desc(), "item")))
    marks = full.where("p > q").select(*_GROUP, F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    terms = radix_select(marks, _GROUP, "value", "item", top)
    out = lambda df, part: df.select(*_GROUP, F.lit(part).alias("part"), "item", "value", "rank")
    return out(ranked, "pair").unionByName(out(terms, "term"))


def divergence_sql(least_docs: int = LEAST_DOCS, unit: int = UNIT, top: int = TOP) -> str:
    """``divergence_audit`` of ``documents`` in DuckDB SQL, with every kept term for every source."""
    return f"""
with d as (select row_number() over () as r, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
w as (select r, lang, source, translate(unnest(regexp_extract_all(text, '{TERM}')), '{UPPER}', '{LOWER}') as term from d),
kept as (select lang, term, count(*)::hugeint as total from w group by all having count(distinct r) >= {least_docs}),
size as (select lang, count(*)::hugeint as v, sum(total)::hugeint as n from kept group by lang),
g as (select distinct lang, source from d),
held as (select lang, source, term, count(*)::hugeint as n from w semi join kept using (lang, term) group by all),
total as (select lang, source, sum(n)::hugeint as n from held group by all),
dense as (
  select lang, g.source, k.term, coalesce(h.n, 0) as n, 1 + ({unit} * (coalesce(h.n, 0) + 1)) // (coalesce(t.n, 0) + s.v) as p, 1 + ({unit} * (k.total + 1)) // (s.n + s.v) as q
  from g join kept k using (lang) join size s using (lang) left join total t using (lang, source) left join held h using (lang, source, term)
),
pair as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
pairs as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source left join pair p on p.lang = a.lang and p.source = a.source and p.item = b.source),
marks as (select lang, source, term as item, ((p - q) * (p - q)) // q as value from dense where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all select * from (select lang, source, 'term' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from marks) where rank <= {top}
)
select lang, source, part, item, value::bigint as value, rank::integer as rank from ranked"""
