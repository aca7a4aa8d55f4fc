"""Column expressions over text: clipping, entities, cases, cascades of patterns, key: value lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bound


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clipped(text: Column, most: int) -> Column:
    """White space collapsed; over ``most`` characters it ends with a whole word and an ellipsis."""
    t = collapsed(F.coalesce(text, F.lit("")))
    return F.when(F.char_length(t) > most, F.concat(F.regexp_replace(F.substring(t, 1, most - 1), r"\s+\S*$", ""), F.lit("…"))).otherwise(t)


def plain(text: Column) -> Column:
    """The six common character references decoded."""
    for old, new in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"')):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def first_kind(text: Column, cascade: list[tuple[str, str]], default: str) -> Column:
    """The name of the first pattern found."""
    out = None
    for pattern, name in cascade:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return F.lit(default) if out is None else out.otherwise(default)


#: Kinds of titles in order, as (pattern, kind, [(pattern of a variant, the variant's kind)]).
TITLE_KINDS = [
    ("VOLCANIC ACTIVITY BULLETIN", "volcanic", []),
    ("OPERATIONS PLAN", "opsPlan", []),
    (r"GROUND STOP|\bGS CNX\b", "gs", [("CANCEL|CNX", "gsCancel")]),
    (r"GROUND DELAY PROGRAM|\bGDP\b", "gdp", [("PROPOSED", "gdpProposed"), ("CNX|CANCEL", "gdpCancel")]),
    (r"AIRSPACE FLOW PROGRAM|\bAFP\b", "afp", [("CNX|CANCEL", "afpCancel")]),
    (r"\bCTOP\b", "ctop", []),
    ("(OCEANIC|ATLANTIC) ROUTE CLOSURE", "oceanic", []),
    ("NATOTS", "nat", []),
    (r"\bSWAP", "swap", []),
    (r"ROUTE|_RQD|_RMD|PLAYBOOK|\bFCA\b|CDRS|CAPPING|TUNNEL", "route", []),
    ("ARRIVAL DELAYS|DEPARTURE DELAYS|SCHEDULING DELAYS|DIVERSION RECOVERY", "delayInfo", []),
]


def title_kind(title: Column) -> Column:
    """The kind of a title, "other" where none fits or the title is null."""
    upper = F.upper(F.coalesce(title, F.lit("")))
    out = F.lit("other")
    for pattern, kind, variants in reversed(TITLE_KINDS):
        out = F.when(upper.rlike(pattern), first_kind(upper, variants, kind)).otherwise(out)
    return out


def field(text: Column, key: str) -> Column:
    """The rest of the first line that begins with ``key:``; null without one."""
    found = F.regexp_extract(text, rf"(?m)^{key}:[ \t]*(.*)$", 1)
    return F.when(found != "", F.trim(found))


def title_case(text: Column) -> Column:
    """Capitals after a blank, hyphen, bracket, slash or quote, and at the start; the rest in lower case."""
    letters = F.split(F.lower(text), "")
    marked = F.transform(letters, lambda c, i: F.when((i == 0) | F.get(letters, i - 1).rlike(r"[\s\-(/\"']"), F.upper(c)).otherwise(c))
    return F.array_join(marked, "")


def run_length(values: Column) -> Column:
    """``v*n`` for runs and ``v`` for single values, joined by commas. The time grows with the number of values."""

    def runs(v: Column, ends: Column) -> Column:
        one = lambda e, k: F.struct(F.get(v, e).alias("v"), (e - F.coalesce(F.get(ends, k - 1), F.lit(-1))).alias("n"))
        return F.transform(F.transform(ends, one), lambda r: F.when(r["n"] > 1, F.concat(r["v"].cast("string"), F.lit("*"), r["n"].cast("string"))).otherwise(r["v"].cast("string")))

    def code(v: Column) -> Column:
        ends = F.filter(F.transform(v, lambda x, i: F.when(F.coalesce(F.get(v, i + 1) != x, F.lit(True)), i)), lambda i: i.isNotNull())
        return F.array_join(bound(ends, lambda e: runs(v, e)), ",")

    return bound(values, code)


def run_length_count(text: Column) -> Column:
    """How many values a run-length text stands for; -1 where it is malformed."""
    parts = F.transform(F.split(text, ","), lambda p: F.when(p.contains("*"), F.substring_index(p, "*", -1).cast("long")).otherwise(F.lit(1).cast("long")))
    return F.when(text.rlike(r"^\d+(\*[1-9]\d*)?(,\d+(\*[1-9]\d*)?)*$"), F.aggregate(parts, F.lit(0).cast("long"), lambda a, b: a + b)).otherwise(F.lit(-1).cast("long"))


def run_length_decoded(text: Column) -> Column:
    parts = F.split(text, ",")
    one = lambda p: F.array_repeat(F.substring_index(p, "*", 1).cast("int"), F.when(p.contains("*"), F.substring_index(p, "*", -1).cast("int")).otherwise(1))
    return F.flatten(F.transform(parts, one))


#: Words of five letters in such sentences that are no points.
_NO_POINTS = ("NOTAM", "TRACK", "ROUTE", "FLOWS", "POINT", "AREAS", "LEVEL")


def unavailable_points(text: Column) -> Column:
    """Five-letter points that a sentence calls unavailable or closed, alone or in a list, each once and in order; null as none."""
    said = r"\b((?:[A-Z]{5}\s*(?:&|AND|,)\s*)*[A-Z]{5})(?:\s+INTERSECTION)?\s+(?:IS|ARE)\s+(?:UNAVAILABLE|NOT AVAILABLE|CLOSED)"
    lists = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(said), F.lit(1))
    points = F.flatten(F.transform(lists, lambda x: F.regexp_extract_all(x, F.lit(r"\b([A-Z]{5})\b"), F.lit(1))))
    return F.array_distinct(F.filter(points, lambda w: ~w.isin(*_NO_POINTS)))


def centre_of(element: Column) -> Column:
    """The centre that a control element names behind its last slash (three letters with a Z first, or CZ and one more); else null."""
    return F.nullif(F.regexp_extract(F.coalesce(element, F.lit("")), "/(Z[A-Z]{2}|CZ[A-Z])$", 1), F.lit(""))


def places_of(element: Column) -> Column:
    """The codes of three or four characters before the slash, without the words between them."""
    before = F.regexp_extract(F.coalesce(element, F.lit("")), "^(.+)/(?:Z[A-Z]{2}|CZ[A-Z])$", 1)
    return F.filter(F.regexp_extract_all(before, F.lit(r"\b([A-Z0-9]{3,4})\b"), F.lit(1)), lambda w: ~w.isin("DCC", "AND", "SATS", "ALL"))


def counted(n: Column, one: str, many: str) -> Column:
    """``1 day``, ``2 days``, ``no days``."""
    return F.when(n == 1, f"1 {one}").when(n == 0, f"no {many}").otherwise(F.concat(n.cast("string"), F.lit(f" {many}")))
