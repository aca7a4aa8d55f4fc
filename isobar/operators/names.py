"""Names of a long list found in texts, the longest at each place, by runs of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.steps import step

#: A word of a name or text, in upper case.
WORD = "[A-Z0-9]+(?:['-][A-Z0-9]+)*"
#: Names of a list up to which they are broadcast, and words of the longest name.
BROADCAST_NAMES, LONGEST = 100_000, 8


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.upper(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def name_list(names: DataFrame, name: str, generic: tuple[str, ...] = ()) -> DataFrame:
    """(words, name) of every distinct name with 1 to LONGEST words that aren't all generic; of equal words the smallest name."""
    split = names.select(words(F.col(name)).alias("words"), F.col(name).cast("string").alias("name"))
    own = F.filter("words", lambda w: ~w.isin(*generic)) if generic else F.col("words")
    return split.where((F.size("words").between(1, LONGEST)) & (F.size(own) > 0)).groupBy("words").agg(F.min("name").alias("name"))


def mentions(texts: DataFrame, keys: list[str], text: str, names: DataFrame, name: str, generic: tuple[str, ...] = ()) -> DataFrame:
    """(keys, start, length, name) of every name in a text, places and lengths in words; none that lies within a longer one.

    A text's words meet the list twice, each time as an equi-join on one column: by its hash a word finds the lengths of the
    names that it begins, then each run of so many words is looked up. The work grows with the words that begin names, not with
    the number of names. Names of generic words only are no names; null texts and names give nothing.
    """
    known = step(name_list(names, name, generic), "names")
    listed = known.agg(F.count("*").alias("n"), F.max(F.size("words")).alias("longest")).first()
    small = F.broadcast if listed.n <= BROADCAST_NAMES else (lambda df: df)
    places = range(listed.longest or 1)
    split = texts.select(*keys, words(F.col(text)).alias("_w"))
    # A plain explode has Spark first filter texts by their number of words, which finds all words twice; the join drops empty texts.
    at = split.select(*keys, "_w", F.posexplode_outer("_w").alias("start", "_0"))
    at = at.select(*keys, "start", "_0", *(F.get("_w", F.col("start") + i).alias(f"_{i}") for i in places[1:]))
    begin = known.select(F.xxhash64(F.get("words", F.lit(0))).alias("_h"), F.size("words").alias("length")).distinct()
    begun = at.withColumn("_h", F.xxhash64("_0")).join(small(begin), "_h")
    # Words hold no blanks, so that equal runs are equal strings; beyond a text's end there are none.
    within = F.coalesce(*(F.when(F.col("length") == i + 1, F.col(f"_{i}").isNotNull()) for i in places))
    run = F.concat_ws(" ", *(F.when(F.col("length") > i, F.col(f"_{i}")) for i in places))
    said = known.select(F.array_join("words", " ").alias("_run"), "name")
    found = begun.where(within).withColumn("_run", run).join(small(said), "_run").select(*keys, "start", "length", "name")
    # Of equal starts the longest comes first, so that whatever ends no later than one before lies within it.
    before = F.max(F.col("start") + F.col("length")).over(Window.partitionBy(*keys).orderBy("start", F.desc("length")).rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("_end", before).where(F.col("_end").isNull() | (F.col("start") + F.col("length") > F.col("_end"))).drop("_end")
