"""Canonical exact digests of whole texts, in DataFrame functions only.

A text's canonical form is normalised (NFC), case-folded in full and has runs of white space as one blank. Its digest is
128 bits of xxhash. Where several rows share a digest, their canonical bytes are compared; texts that differ in spite of
one digest get suffixes, so that equal fingerprints mean equal canonical texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import free_name, written

#: Digests of more than one row up to which they are broadcast for the comparison; beyond, a shuffled join does it.
BROADCAST_ROWS = 100_000
#: White space beyond ASCII is rare, so that one cheap search tells most texts from the rest.
_WIDE = r"[\x{85}\x{A0}\x{1680}-\x{3000}]"
_WHITE = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _nfc(text: Column) -> Column:
    """Unicode normalisation form C, by the Unicode library that Spark ships with."""
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))


def _case_folded(text: Column) -> Column:
    """Full case folding, by the same library."""
    return F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), text, F.lit(True))


def canonical(text: Column) -> Column:
    """NFC, full case folding, NFC again, runs of white space as one blank, trimmed; null as empty.

    Below U+0300 every text is in NFC already, and ASCII texts are only lower-cased. Spark takes the two calls for
    non-deterministic, so an aggregate function takes this from a column of an earlier select.
    """
    given = F.coalesce(text.cast("string"), F.lit(""))
    folded = F.when(given.rlike(r"[\x{300}-\x{10FFFF}]"), _nfc(_case_folded(_nfc(given)))).when(given.rlike(r"[\x{80}-\x{2FF}]"), _nfc(_case_folded(given))).otherwise(F.lower(given))
    # A lone blank is already folded and isn't matched.
    narrow = F.regexp_replace(folded, r"[\t-\r\x1C-\x1F][\s\x1C-\x1F]*| [\s\x1C-\x1F]+", " ")
    return F.trim(F.when(given.rlike(_WIDE), F.regexp_replace(folded, _WHITE, " ")).otherwise(narrow))


def digest(form: Column) -> Column:
    """32 hex digits: two 64-bit hashes of a canonical form."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(form)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second half"), form)), 16, "0")))


def collisions(forms: DataFrame) -> DataFrame | None:
    """(digest, form, suffix) where rows of ``forms`` (digest, form) share a digest and differ; None if none do.

    Digests are counted first. Only rows whose digest recurs bring their bytes, and of those each task sends the least and
    greatest for a digest: a digest that a third of all rows share costs no more than others.
    """
    twice = written(forms.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "twice")
    few = twice.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return _differing(forms.join(F.broadcast(twice) if few else twice, "digest", "left_semi"))


def _differing(members: DataFrame) -> DataFrame | None:
    differ = written(members.groupBy("digest").agg(F.min("form").alias("lo"), F.max("form").alias("hi")).where("lo <> hi").select("digest"), "differ")
    if not differ.limit(1).count():
        return None
    own = members.join(differ, "digest", "left_semi").select("digest", "form").distinct()
    order = Window.partitionBy("digest").orderBy("form")
    return own.select("digest", "form", F.concat(F.lit("-"), F.row_number().over(order) - 1).alias("suffix"))


def fingerprints(docs: DataFrame, *, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with its fingerprint, a string; equal ones mean equal canonical texts. A column of that name is replaced.

    Null and empty texts and texts of white space have the empty form. Repeated rows share their fingerprint. Other columns
    pass through, whatever their names. An empty table stays empty.
    """
    form, mark, added = (free_name(docs, n) for n in ("form", "mark", "suffix"))
    rows = docs.withColumn(form, canonical(F.col(f"`{text}`"))).withColumn(mark, digest(F.col(form)))
    clash = collisions(rows.select(F.col(mark).alias("digest"), F.col(form).alias("form")))
    name = F.col(mark)
    if clash is not None:
        rows = rows.join(clash.select(F.col("digest").alias(mark), F.col("form").alias(form), F.col("suffix").alias(added)), [mark, form], "left")
        name = F.concat(mark, F.coalesce(added, F.lit("")))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns if c != into), name.alias(into))


#: Key of a row in the order of ids: null ids first, then ids, rows of one id by a hash of their text.
_KEY = ["has_id", "id", "h"]


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:  # noqa: A002
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    number = F.col(f"`{id}`").cast("long")
    return docs.select(number.isNotNull().alias("has_id"), F.coalesce(number, F.lit(0)).alias("id"), F.xxhash64(whole).alias("h"), whole.alias("text"))


def _followed(keys: DataFrame) -> DataFrame:
    """Distinct ``keys`` (the key and other columns) with ``next``, the struct of the following row's columns; after the last the first.

    Spark cuts the keys into ranges by sampling, whatever their values; inside a range the next row is near, and the last row
    of a range takes the first of the next range. Only one row of each range is ordered by a single task.
    """
    ranged = written(keys.repartitionByRange(*_KEY).withColumn("part", F.spark_partition_id()), "ranged")
    row = F.struct(*keys.columns)
    led = ranged.withColumn("after", F.lead(row).over(Window.partitionBy("part").orderBy(*_KEY)))
    heads = ranged.groupBy("part").agg(F.min(row).alias("head"))
    everything = Window.orderBy("part")
    first = F.min("head").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(everything), first).alias("head"))
    return led.join(heads, "part").withColumn("next", F.coalesce("after", "head")).drop("part", "after", "head")


def _with_following(rows: DataFrame, keys: DataFrame, of_next: Callable[[Column, Column], Column]) -> DataFrame:
    """``rows`` (key, text) with ``next_text``, the struct ``next`` and ``of`` (their own key's columns).

    ``of_next(text, struct of the row's own key)`` is made where the next row's text lies, so that no more of it moves.
    """
    several = keys.where("n > 1").limit(1).count() > 0
    if several:
        rows = rows.groupBy(*_KEY).agg(F.min("text").alias("text"))
    asked = _followed(keys).select(*(F.col("next")[c].alias(c) for c in _KEY), F.struct(*keys.columns).alias("of"), "next")
    found = rows.join(asked, _KEY).select(*(F.col("of")[c].alias(c) for c in _KEY), of_next(F.col("text"), F.col("of")).alias("next_text"), "of", "next")
    out = rows.join(found, _KEY)
    if several:
        # Rows of one id with one text follow one another; the last of them has another row's text after it.
        out = out.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("of.n"))))
        again = F.col("k") < F.col("of.n")
        out = out.withColumn("next_text", F.when(again, of_next(F.col("text"), F.col("of"))).otherwise(F.col("next_text"))).withColumn("next", F.when(again, F.col("of")).otherwise(F.col("next"))).drop("k")
    return out


def with_next(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: A002
    """``docs`` (id, text) with ``next_text``: the text of the row with the next id, after the last the first.

    Rows with one id follow one another by a hash of their text; null ids come first. A single row is its own next. Other
    columns are left out; null texts are empty ones. Ids may lie anywhere in 64 bits.
    """
    rows = _keyed(docs, id, text)
    keys = written(rows.groupBy(*_KEY).agg(F.count("*").alias("n")), "keys")
    out = _with_following(rows, keys, lambda t, _: t)
    return out.select(F.when(F.col("has_id"), F.col("id")).alias(id), F.col("text").alias(text), "next_text")


def likeness(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: A002
    """Per row: ``id``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter of code points (rounded down) replaced by as many first ones of the next row (as
    ``with_next`` orders them). An exact digest's likeness is 1 for equal canonical texts and 0 otherwise. Each text's form
    is made once, and the edited text's once; bytes are compared only where digests agree.
    """
    rows = _keyed(docs, id, text)
    made = rows.withColumn("form", canonical(F.col("text"))).select(*_KEY, F.char_length("text").alias("n_chars"), digest(F.col("form")).alias("digest"))
    keys = written(made.groupBy(*_KEY, "n_chars", "digest").agg(F.count("*").alias("n")), "keys")
    # Only texts whose digest recurs are compared: they are found by their hash, and made canonical again.
    recurring = keys.groupBy("digest").agg(F.sum("n").alias("m")).where("m > 1").select("digest")
    hashes = written(keys.join(recurring, "digest", "left_semi").select("h").distinct(), "recurring")
    few = hashes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    members = rows.join(F.broadcast(hashes) if few else hashes, "h", "left_semi").select(*_KEY, canonical(F.col("text")).alias("form")).withColumn("digest", digest(F.col("form")))
    clash = _differing(members)
    marked = keys.withColumn("fingerprint", F.col("digest"))
    if clash is not None:
        suffixes = members.join(clash, ["digest", "form"]).select(*_KEY, "suffix").distinct()
        marked = written(keys.join(suffixes, _KEY, "left").withColumn("fingerprint", F.concat("digest", F.coalesce("suffix", F.lit("")))).drop("suffix"), "marked")
    cut = lambda of: F.floor(of["n_chars"] / 4).cast("int")
    out = _with_following(rows, marked, lambda t, of: F.substring(t, F.lit(1), cut(of)))
    out = out.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("of.n_chars") - cut(F.col("of"))), F.col("next_text")))
    out = out.withColumn("form", canonical(F.col("edited"))).withColumn("mark", digest(F.col("form"))).withColumn("alike", F.col("mark") == F.col("of.digest"))
    out = out.withColumn("alike", F.when(F.col("alike"), canonical(F.col("text")) == F.col("form")).otherwise(F.lit(False)))
    return out.select(
        F.when(F.col("has_id"), F.col("id")).alias(id),
        F.col("of.n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("of.fingerprint").alias("fingerprint"),
        F.when(F.col("alike"), F.col("of.fingerprint")).otherwise(F.col("mark")).alias("edited_fingerprint"),
        F.col("alike").cast("double").alias("near_edited"),
        (F.col("of.fingerprint") == F.col("next.fingerprint")).cast("double").alias("near_next"),
    )
