"""Licence scan by a positional index of rare words, in DataFrame functions only.

A template is words at fixed distances: a name, a notice's body, or a key phrase that a body must hold. One pass over the
texts keeps where words of any template stand, and how many documents hold each word gives its inverse document frequency.

A template of n words that needs m of them in place can't be matched without one of its n - m + 1 rarest words: those are
its postings in the index of rare words. Each file looks up the rare words that it holds; only the templates found there
are candidates. Each hit of a candidate's word is set off against the word's places in the template: hits of one template
at one offset are one alignment, and their number is the matched share. A body counts if all its key phrases stand in
place within its extent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import bound
from .shared import free_name, written

#: What separates words, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words so common that bodies and key phrases leave their places open.
COMMON = set("a an and any are as at be by for from if in is it its may nor not of on or that the their this to was will with you your".split())
#: Share of a body's words that must stand in place, and words by which a key phrase may stand outside its body's extent.
SHARE, SLACK = 0.6, 8


@dataclass(frozen=True)
class Template:
    """``words`` holds the phrase; a dot stands for any one word. ``keys`` makes it a body, which is matched in part."""

    label: str
    phrase: str
    base: bool = False
    keys: tuple[str, ...] = ()

    @property
    def places(self) -> list[tuple[str, int]]:
        return [(w, i) for i, w in enumerate(self.phrase.split()) if w != "." and not (self.keys and w in COMMON)]

    @property
    def need(self) -> int:
        n = len(self.places)
        return -int(-n * SHARE // 1) if self.keys else n


#: Base phrases first, then names, then bodies of published licences and notices with their key phrases.
TEMPLATES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-nc-sa", "cc by nc sa"),
    Template("cc-by-nc-nd", "cc by nc nd"),
    Template("cc-by-4.0", "cc by 4 0"),
    Template("cc0", "cc0 1 0"),
    Template("mpl-2.0", "mozilla public license version 2 0"),
    Template("epl", "eclipse public license"),
    Template("bsd", "bsd license"),
    Template("bsd-2-clause", "bsd 2 clause"),
    Template("bsd-3-clause", "bsd 3 clause"),
    Template("isc", "isc license"),
    Template("boost", "boost software license"),
    Template("all-rights-reserved", "all rights reserved"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        keys=("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice "
        "and this permission notice appear in all copies",
        keys=("with or without fee",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        keys=("redistribution and use in source and binary forms", "following conditions"),
    ),
    Template(
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
        keys=("endorse or promote products", "prior written permission"),
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        keys=("apache license version 2 0", "except in compliance"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        keys=("gnu general public license", "free software foundation"),
    ),
    Template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        keys=("gnu lesser general public license", "free software foundation"),
    ),
    Template(
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
        keys=("gnu affero general public license", "free software foundation"),
    ),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", keys=("mozilla public license", "can obtain one")),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", keys=("unencumbered software", "public domain")),
    Template("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", keys=("person or organization obtaining",)),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", keys=("express or implied warranty", "held liable")),
    Template("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law", keys=("dedicated the work", "public domain")),
)


@dataclass(frozen=True)
class _Sought:
    """One template as the scan uses it; a key phrase has no label."""

    label: str
    places: tuple[tuple[str, int], ...]
    need: int
    length: int
    base: bool
    keys: tuple[int, ...]


def _sought(templates: tuple[Template, ...]) -> list[_Sought]:
    """Templates in their order, then every key phrase of bodies once."""
    phrases = list(dict.fromkeys(k for t in templates for k in t.keys))
    number = {k: len(templates) + j for j, k in enumerate(phrases)}
    out = [_Sought(t.label, tuple(t.places), t.need, len(t.phrase.split()), t.base, tuple(number[k] for k in t.keys)) for t in templates]
    for k in phrases:
        places = tuple((w, i) for i, w in enumerate(k.split()) if w not in COMMON)
        out.append(_Sought("", places, len(places), len(k.split()), False, ()))
    n_base = sum(t.base for t in out)
    if not all(t.base for t in out[:n_base]):
        raise ValueError("base templates come first")
    return out


def _array(values: list) -> Column:  # noqa: ANN401
    return F.array(*map(F.lit, values))


def word_hits(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words and ``hits``: (w, p) of every template word and its place among all words."""
    vocabulary = sorted({w for t in _sought(templates) for w, _ in t.places})
    lowered = F.translate(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), _UPPER, _LOWER)
    words = free_name(docs, "words")
    split = docs.withColumn(words, F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1)))
    hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("w"), i.alias("p")))), lambda h: h.isNotNull())
    return split.select(*(F.col(f"`{c}`") for c in docs.columns if c not in (text, "n_words", "hits")), F.size(words).cast("long").alias("n_words"), hits.alias("hits"))


def rare_words(hits: DataFrame, templates: tuple[Template, ...]) -> dict[str, list[int]]:
    """For each word the templates that have it among their words of highest inverse document frequency, over all documents.

    A template needing m of n words has its n - m + 1 rarest there, the first ones on ties. The counts that reach the
    driver are one for each template word.
    """
    counted = hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    found = {r["w"]: r["n"] for r in counted}
    out: dict[str, list[int]] = {}
    for k, t in enumerate(_sought(templates)):
        for w, _ in sorted(t.places, key=lambda x: (found.get(x[0], 0), x[1]))[: len(t.places) - t.need + 1]:
            if k not in out.setdefault(w, []):
                out[w].append(k)
    return out


def licence_scan(docs: DataFrame, *, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``docs`` without its text, with n_words, n_base, first_word, last_word, base_labels, labels and score.

    Words are runs of a-z, 0-9 and characters beyond ASCII, after A-Z are lower-cased. ``n_base`` counts the places where
    a base phrase stands, ``first_word`` and ``last_word`` are the least and greatest of their first words (from 0; null
    without one). ``labels`` also has the labels of names and of bodies of which SHARE of the words stand in place and all
    key phrases within the body's extent (give or take SLACK words). Labels are distinct, sorted and joined by commas; none
    gives an empty string. ``score`` is 0.5 for a name and 0.5 + 0.5 * the matched share for a body, the greatest of them,
    0 without a label. Null texts count as empty. Each row is worked on by itself: repeated rows and ids get equal results.
    Columns named as the new ones are replaced, others pass through. A text of n hits costs n log n.
    """
    sought = _sought(templates)
    hits = written(word_hits(docs, templates, text), "licence-words")
    rare = rare_words(hits, templates)
    postings: dict[str, list[Column]] = {}
    for k, t in enumerate(sought):
        for w, p in t.places:
            postings.setdefault(w, []).append(F.struct(F.lit(k).alias("t"), F.lit(p).alias("p")))
    index = F.create_map(*[x for w, ps in postings.items() for x in (F.lit(w), F.array(*ps))])
    wanted = F.create_map(*[x for w, ts in rare.items() for x in (F.lit(w), _array(ts))])
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    kept = [F.col(f"`{c}`") for c in hits.columns if c not in ("hits", *new)]
    own_rare = F.filter(F.array_distinct(F.transform("hits", lambda h: h["w"])), lambda w: w.isin(list(rare)))
    candidates = F.array_distinct(F.flatten(F.transform(own_rare, lambda w: wanted[w])))
    offset = lambda h, q: F.struct(q["t"].alias("t"), (h["p"] - q["p"]).alias("o"))
    aligned = bound(candidates, lambda c: F.when(F.size(c) > 0, F.flatten(F.transform("hits", lambda h: F.transform(F.filter(index[h["w"]], lambda q: F.array_contains(c, q["t"])), lambda q: offset(h, q))))))
    sizes, needs = _array([len(t.places) for t in sought]), _array([t.need for t in sought])

    def in_place(a: Column) -> Column:
        """An alignment occurs once for each of its words, so that equal neighbours count the words in place."""
        first = lambda x, k: (F.get(a, k + F.get(needs, x["t"]) - 1) == x) & F.coalesce(F.get(a, k - 1) != x, F.lit(True))
        many = lambda x, k: F.size(F.filter(F.slice(a, k + 1, F.get(sizes, x["t"])), lambda y: y == x))
        return F.filter(F.transform(a, lambda x, k: F.when(first(x, k), F.struct(x["t"].alias("t"), x["o"].alias("o"), many(x, k).alias("n")))), lambda x: x.isNotNull())

    none = F.array().cast("array<struct<t:int,o:int,n:int>>")
    place = free_name(hits, "places")
    placed = hits.select(*kept, "n_words", F.coalesce(bound(F.array_sort(aligned), in_place), none).alias(place))
    names, with_keys = [t.label for t in sought], [k for k, t in enumerate(sought) if t.keys]
    phrases = sorted({k for t in sought for k in t.keys})
    n_base = sum(t.base for t in sought)
    least, bases, named, bodies = F.col(place), *(free_name(hits, n) for n in ("base", "own", "bodies"))
    base = F.filter(least, lambda x: x["t"] < n_base)
    own = F.array_distinct(F.transform(F.filter(least, lambda x: x["t"].isin([k for k, t in enumerate(sought) if t.label and not t.keys])), lambda x: x["t"]))
    placed = placed.select(*kept, "n_words", base.alias(bases), own.alias(named), _verified(least, sought, with_keys, phrases).alias(bodies))
    label = lambda a: F.array_sort(F.array_distinct(F.transform(a, lambda t: F.get(_array(names), t))))
    found = F.filter(F.transform(bodies, lambda n, i: F.when(n > 0, F.get(_array(with_keys), i))), lambda t: t.isNotNull())
    starts = F.transform(bases, lambda x: x["o"].cast("long"))
    body_sizes = _array([len(sought[k].places) for k in with_keys])
    worth = F.transform(bodies, lambda n, i: F.when(n > 0, 0.5 + 0.5 * n / F.get(body_sizes, i)))
    return placed.select(
        *kept,
        "n_words",
        F.size(bases).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(label(F.transform(bases, lambda x: x["t"])), ",").alias("base_labels"),
        F.array_join(label(F.concat(named, found)), ",").alias("labels"),
        F.greatest(F.when(F.size(named) > 0, 0.5).otherwise(0.0), F.coalesce(F.array_max(worth), F.lit(0.0))).alias("score"),
    )


def _verified(placements: Column, sought: list[_Sought], bodies: list[int], phrases: list[int]) -> Column:
    """For each body the most words in place of an alignment that has all its key phrases within its extent; 0 without one.

    One pass over alignments from the last place to the first. It holds for each key phrase the place nearest behind, so that an
    alignment looks at as many places as it has keys, however many notices a text has.
    """
    if not bodies:
        return F.array().cast("array<int>")
    behind = {t: i for i, t in enumerate(phrases)}
    of_key, of_body = _array([behind.get(t, -1) for t in range(len(sought))]), _array([bodies.index(t) if t in bodies else -1 for t in range(len(sought))])
    needed = F.array(*(_array([behind[k] for k in sought[t].keys]).cast("array<int>") for t in bodies))
    reach = _array([sought[t].length + 2 * SLACK for t in bodies])
    event = lambda x, at, key: F.struct(at.alias("at"), F.lit(key).alias("key"), x["t"].alias("t"), x["n"].alias("n"))
    keys = F.transform(F.filter(placements, lambda x: x["t"].isin(phrases)), lambda x: event(x, x["o"], 1))
    own = F.transform(F.filter(placements, lambda x: x["t"].isin(bodies)), lambda x: event(x, x["o"] - SLACK, 0))
    start = F.struct(F.array_repeat(F.lit(None).cast("int"), len(phrases)).alias("last"), F.array_repeat(F.lit(0), len(bodies)).alias("best"))

    def step(s: Column, e: Column) -> Column:
        slot, body = F.get(of_key, e["t"]), F.get(of_body, e["t"])
        there = F.forall(F.get(needed, body), lambda k: F.coalesce(F.get(s["last"], k) <= e["at"] + F.get(reach, body), F.lit(False)))
        seen = F.struct(F.transform(s["last"], lambda v, i: F.when(i == slot, e["at"]).otherwise(v)).alias("last"), s["best"].alias("best"))
        counted = F.struct(s["last"].alias("last"), F.transform(s["best"], lambda v, i: F.when(i == body, F.greatest(v, e["n"])).otherwise(v)).alias("best"))
        return F.when(e["key"] == 1, seen).when(there, counted).otherwise(s)

    # Without a body's alignment there is nothing to verify, which is the usual text.
    events = F.when(F.size(own) > 0, F.sort_array(F.concat(keys, own), asc=False)).otherwise(F.slice(keys, 1, 0))
    return F.aggregate(events, start, step, lambda s: s["best"])


def licence_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The scan of ``documents`` in DuckDB SQL: every alignment of every template, without a choice of candidates."""
    sought = _sought(templates)
    posts = ", ".join(f"({k}, '{w}', {p})" for k, t in enumerate(sought) for w, p in t.places)
    kinds = ", ".join(f"({k}, '{t.label}', {str(t.base).lower()}, {t.need}, {len(t.places)}, {t.length}, {len(t.keys)})" for k, t in enumerate(sought))
    keys = ", ".join(f"({k}, {x})" for k, t in enumerate(sought) for x in t.keys) or "(-1, -1)"
    return f"""
with post(t, word, p) as (values {posts}), kind(t, label, base, need, size, length, n_keys) as (values {kinds}), key(t, k) as (values {keys}),
words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') as w from documents
), hits as (select doc_id, unnest(w) as word, unnest(range(len(w))) as i from words
), aligned as (select doc_id, t, i - p as o, count(*) as n from hits join post using (word) group by all
), placed as (select a.*, label, base, size, length, n_keys from aligned a join kind using (t) where n >= need
), verified as (
  select f.doc_id, f.t, f.o from placed f join key on key.t = f.t join placed g on g.doc_id = f.doc_id and g.t = key.k and g.o between f.o - {SLACK} and f.o + f.length + {SLACK}
  group by f.doc_id, f.t, f.o, f.n_keys having count(distinct key.k) = f.n_keys
), found as (select * from placed where label <> '' and n_keys = 0 union all select p.* from placed p join verified using (doc_id, t, o) where label <> ''
), named as (
  select doc_id, count(*) filter (base) as n_base, min(o) filter (base) as first_word, max(o) filter (base) as last_word,
    string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) as labels,
    max(case when n_keys > 0 then 0.5::double + 0.5::double * n / size else 0.5::double end) as score
  from found group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels,
  coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from words d left join named using (doc_id)"""
