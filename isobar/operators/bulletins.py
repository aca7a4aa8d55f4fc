"""Bulletins read line by line by grammars: what opens a section, what begins an item, what goes on.

A grammar is rows, not code: every kind of text is read in the same pass over its lines, and a new kind adds rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Section:
    """Lines from one that ``opens`` it to one that opens another; without a name they belong to nothing.

    An item begins with a line that ``begins`` it or, without that, with the first line of each paragraph. Lines that are
    ``notes`` are kept apart from an item's text. What stands behind an opening pattern in its line is the section's first line.
    """

    kind: str
    opens: str
    name: str = ""
    begins: str = ""
    notes: str = ""


@dataclass(frozen=True)
class Field:
    """A field of a section's items: the group ``group`` of a pattern in the item's ``part`` (head, text or notes)."""

    kind: str
    section: str
    name: str
    part: str
    pattern: str
    group: int = 1


def _first(cases: Iterable[tuple[Column, Column]]) -> Column:
    return F.coalesce(*(F.when(condition, value) for condition, value in cases), F.lit(None).cast("string"))


def _tidy(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def items(bulletins: DataFrame, keys: list[str], grammar: tuple[Section, ...], *, kind: str = "kind", text: str = "text") -> DataFrame:
    """(keys, kind, section, item, head, text, notes) of every item that a section of its bulletin's kind has, from 1.

    ``head`` is the line that begins the item, ``text`` the lines after it and ``notes`` its notes, white space as one blank.
    Sections and items are running values over a bulletin's lines; a section that is opened again goes on counting. Lines
    before the first section or item, bulletins of no known kind, null and empty texts give nothing.
    """
    lines = bulletins.select(*keys, F.col(kind).alias("kind"), F.posexplode(F.split(F.regexp_replace(text, "\r", ""), "\n")).alias("n", "line"))
    of = lambda s: F.col("kind") == s.kind
    opened = _first((of(s) & F.col("line").rlike(s.opens), F.lit(s.name)) for s in grammar)
    behind = _first((of(s) & F.col("line").rlike(s.opens), F.regexp_replace("line", s.opens, "")) for s in grammar)
    w = Window.partitionBy(*keys).orderBy("n")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = lines.withColumn("opened", opened).withColumn("line", F.coalesce(behind, F.col("line"))).withColumn("section", F.last("opened", ignorenulls=True).over(upto))
    blank = ~F.col("line").rlike(r"\S")
    before = F.lag(blank | (F.col("opened").isNotNull() & blank), 1, True).over(w)
    named = F.col("section") != ""
    begins = F.lit(False)
    notes = F.lit(False)
    for s in grammar:
        if s.name:
            here = of(s) & (F.col("section") == s.name)
            begins |= here & (F.col("line").rlike(s.begins) if s.begins else ~blank & (before | F.col("opened").isNotNull()))
            notes |= here & F.col("line").rlike(s.notes) if s.notes else F.lit(False)
    told = marked.withColumn("begins", begins).withColumn("note", notes).where(named)
    # A section's begun items are counted in the order that the lines already have; an item's row is its first line that isn't blank.
    count = lambda name: F.sum((F.col("begins") & (F.col("section") == name)).cast("int")).over(upto)
    item = F.coalesce(F.lit(None).cast("long"), *(F.when(F.col("section") == name, count(name)) for name in dict.fromkeys(s.name for s in grammar if s.name)))
    numbered = told.withColumn("item", item).where(F.col("item") > 0).where(F.col("line").rlike(r"\S"))
    earlier = F.lag("item").over(Window.partitionBy(*keys, "kind", "section").orderBy("n"))
    whole = Window.partitionBy(*keys, "kind", "section", "item").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Lists that no later step reads are dropped by the optimizer, and their sort with them.
    those = lambda cond: F.collect_list(F.when(cond, F.struct("n", "line"))).over(whole)
    listed = numbered.withColumn("earlier", earlier).withColumn("text", those(~F.col("begins") & ~F.col("note"))).withColumn("notes", those(F.col("note")))
    joined = lambda c: _tidy(F.array_join(F.transform(F.sort_array(c), lambda x: x["line"]), " ")).alias(c)
    head = _tidy(F.when(F.col("begins"), F.col("line"))).alias("head")
    first = listed.where(F.col("earlier").isNull() | (F.col("earlier") < F.col("item")))
    return first.select(*keys, "kind", "section", F.col("item").cast("int").alias("item"), head, joined("text"), joined("notes"))


def fields(read: DataFrame, keys: list[str], patterns: tuple[Field, ...]) -> DataFrame:
    """(keys, kind, section, item, field, value) of every field that a pattern finds in the items of :func:`items`."""
    # A pattern's first match says both whether there is a field and what it holds: null where there is none.
    match = lambda f: F.get(F.regexp_extract_all(f.part, F.lit(f.pattern), F.lit(f.group)), F.lit(0))
    value = lambda f: F.when((F.col("kind") == f.kind) & (F.col("section") == f.section), F.trim(match(f)))
    found = read.select(*keys, "kind", "section", "item", *(value(f).alias(f"_{i}") for i, f in enumerate(patterns)))
    every = F.array(*(F.struct(F.lit(f.name).alias("field"), F.col(f"_{i}").alias("value")) for i, f in enumerate(patterns)))
    return found.select(*keys, "kind", "section", "item", F.explode(every).alias("f")).select(*keys, "kind", "section", "item", "f.*").where("value is not null")


def within_budget(read: DataFrame, keys: list[str], text: Column, budget: int, joiner: int = 3) -> DataFrame:
    """The first items whose texts, joined by ``joiner`` characters, stay within ``budget``; the first that doesn't fit ends them."""
    w = Window.partitionBy(*keys).orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length(text) + joiner).over(w), F.lit(0))
    return read.withColumn("_before", before).where(F.col("_before") + F.length(text) <= budget).drop("_before")
