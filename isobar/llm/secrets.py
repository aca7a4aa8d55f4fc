"""Secret scan with ownership frequencies over the whole corpus, in DataFrame functions only.

Patterns find candidates. A candidate's value is hashed, and its hash is counted by the distinct owners and repositories
that hold it: a value that many owners hold is a published example or a vendored file, one that few hold is a credential of
its own. Base spans stay whatever the counts say; spans of the method's own kinds are added where they look live.

Where a pattern's matches stand comes from their lengths and those of the text between them, as a running sum in a window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import beside, written


@dataclass(frozen=True)
class Kind:
    """Matches of ``pattern`` whose group ``group`` has ``least`` code points or more; the group is the secret itself."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    #: 0: base, stays in any case; 1: a published format; 2: anything that looks random. A span hides those of higher tiers that it overlaps.
    tier: int = 1
    #: Code points that a value must have of each of a-z, A-Z and 0-9, and distinct ones in all.
    mixed: int = 0
    distinct: int = 1


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
#: Base kinds in their order, then formats of keys as their issuers publish them, then mixed runs. Of a run without
#: gaps the longest match is the leftmost one, so that the least lengths of access and hex can stand in their patterns.
KINDS = (
    Kind("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, 0),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20, 0),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24, 0),
    Kind("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----[A-Za-z0-9+/=\s]{64,}-----END [A-Z ]{0,24}PRIVATE KEY-----", distinct=16),
    Kind("vendor", r"gh[opsru]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|AIza[A-Za-z0-9_-]{35}|[rs]k_live_[A-Za-z0-9]{24,}", distinct=10),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", distinct=16),
    Kind("login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:([^\s/:@]{6,128})@", 1, distinct=5),
    Kind("opaque", r"[A-Za-z0-9+/=_-]{32,}", tier=2, mixed=3, distinct=16),
)
#: One search that every text with a candidate passes.
_HINT = rf"""({_NAMES})["']?\x20*[:=]|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}|-----BEGIN |gh[opsru]_|xox[abprs]-|AIza|[rs]k_live_|eyJ|://[^\s/:@]{{1,64}}:|[A-Za-z0-9+/=_-]{{32}}"""
#: Owners or repositories from which on a value counts as copied.
OWNERS, REPOSITORIES = 3, 12
#: Hashes of a row: its id, owner, repository and text.
_KEY = ["a", "b"]


def _looks_random(kind: Kind, value: Column) -> Column:
    of = lambda chars: F.char_length(F.regexp_replace(value, f"[^{chars}]", "")) >= kind.mixed
    different = F.size(F.array_distinct(F.regexp_extract_all(value, F.lit(r"(?s)(.)"), F.lit(1)))) >= kind.distinct
    return different & of("a-z") & of("A-Z") & of("0-9") if kind.mixed else different


def _read(docs: DataFrame, id: str, text: str, owner: str, repository: tuple[str, ...], hint: str) -> DataFrame:  # noqa: A002
    """(id, owner, repository, text), written: the text and where it belongs only where a candidate may be, else null."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), name(owner).alias("owner"), F.to_json(F.array(*map(name, repository))).alias("repository"), whole.alias("text"))
    return written(rows.withColumn("text", F.when(F.col("text").rlike(hint), F.col("text"))).select("id", *(F.when(F.col("text").isNotNull(), F.col(c)).alias(c) for c in ("owner", "repository", "text"))), "secret-texts")


def candidates(rows: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(a, b, owner, repository, kind, start, end, value) of the matches that are long enough; ``kind`` is a place in ``kinds``.

    Matches are leftmost and don't overlap within a kind; those too short are dropped after they were found. Places are code
    points from 0, the end exclusive, and are those of the whole match.
    """
    text = F.col("text")
    found = [
        F.when(
            text.rlike(k.pattern),
            F.struct(
                F.lit(n).alias("kind"),
                F.transform(F.split(text, k.pattern, -1), F.char_length).alias("gaps"),
                F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias("hits"),
                F.regexp_extract_all(text, F.lit(k.pattern), F.lit(k.group)).alias("values"),
            ),
        )
        for n, k in enumerate(kinds)
    ]
    own = [*_KEY, "owner", "repository"]
    by_kind = rows.select(*own, F.explode(F.filter(F.array(*found), lambda f: f.isNotNull())).alias("f"))
    each = F.transform("f.hits", lambda h, i: F.struct(i.alias("i"), F.get("f.gaps", i).alias("gap"), F.char_length(h).alias("n"), F.get("f.values", i).alias("value")))
    places = by_kind.select(*own, F.col("f.kind").alias("kind"), F.explode(each).alias("m")).select(*own, "kind", "m.*")
    upto = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy(*_KEY, "kind").orderBy("i"))
    least = F.get(F.array(*(F.lit(k.least) for k in kinds)), F.col("kind"))
    return places.withColumn("end", upto.cast("long")).where(F.char_length("value") >= least).select(*own, "kind", (F.col("end") - F.col("n")).alias("start"), "end", "value")


def ownership(spans: DataFrame) -> DataFrame:
    """(value_a, value_b, owners, repositories) of every candidate's hash over the corpus.

    Distinct owners and repositories of a hash come first, so that a value in a third of all rows is shuffled once for each.
    """
    homes = spans.select("value_a", "value_b", "owner", "repository").distinct()
    return homes.groupBy("value_a", "value_b").agg(F.count_distinct("owner").alias("owners"), F.count("*").alias("repositories"))


def secret_scan(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", owner: str = "source", repository: tuple[str, ...] = ("source", "lang"),  # noqa: A002
    kinds: tuple[Kind, ...] = KINDS, owners: int = OWNERS, repositories: int = REPOSITORIES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, whatever the id's column is called.

    ``spans`` lists kind:start:end by start, then in the order of kinds, joined by commas: the base kinds' spans, and of the
    others those that look random, that no base span overlaps and whose value fewer than ``owners`` owners and fewer than
    ``repositories`` repositories hold. Of all candidates that base spans don't hide, ``n_live`` counts those held by so few
    and ``n_copied`` the rest. base_sha256 is the hex digest of the base spans' list, the empty string's without any.

    Null and empty texts have no spans. Nulls in owner or repository are one owner and one repository of their own. Repeated
    rows have equal results and count once for the frequencies, as do repeated values. Ids that are null or stand for several
    texts keep their rows apart. Other columns are left out, whatever their names; an empty table gives an empty result. A
    text of n matches costs n log n; texts without a candidate are read once.
    """
    read = _read(docs, id, text, owner, repository, _HINT if kinds is KINDS else "|".join(k.pattern for k in kinds))
    own = ["id", "owner", "repository", "text"]
    some = read.where("text is not null").groupBy(*own).agg(F.count("*").alias("copies"))
    rows = written(some.select("*", F.xxhash64(*own).alias("a"), F.xxhash64(F.lit("second half"), *own).alias("b")), "secret-rows")
    of = lambda values: F.get(F.array(*map(F.lit, values)), F.col("kind"))
    random = F.get(F.array(*(_looks_random(k, F.col("value")) if k.tier else F.lit(True) for k in kinds)), F.col("kind"))
    hashed = candidates(rows, kinds).where(random).select("*", F.xxhash64("value").alias("value_a"), F.xxhash64(F.lit("second half"), "value").alias("value_b"), of([k.tier for k in kinds]).alias("tier"))
    order = Window.partitionBy(*_KEY).orderBy("start", "kind")
    hidden = F.lit(False)
    for tier in range(max(k.tier for k in kinds)):
        before = F.max(F.when(F.col("tier") <= tier, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        after = F.min(F.when(F.col("tier") <= tier, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
        hidden = hidden | ((F.col("tier") > tier) & (F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))))
    spans = written(hashed.withColumn("hidden", hidden).where("not hidden").drop("value", "hidden"), "secret-spans")
    often = ownership(spans).where((F.col("owners") >= owners) | (F.col("repositories") >= repositories))
    copied = written(often.select("value_a", "value_b", F.lit(True).alias("copied")), "copied")
    judged = beside(spans, copied, ["value_a", "value_b"]).withColumn("copied", F.coalesce("copied", F.lit(False)))
    span = F.struct("start", "kind", F.concat_ws(":", of([k.name for k in kinds]), F.col("start"), F.col("end")).alias("s"))
    listed = lambda cond: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(cond, span))), lambda x: x["s"]), ",")
    by_row = judged.groupBy(*_KEY).agg(
        *(F.count_if(F.col("kind") == n).alias(f"n_{k.name}") for n, k in enumerate(kinds) if not k.tier),
        F.sha2(listed(F.col("tier") == 0).cast("binary"), 256).alias("base_sha256"),
        listed((F.col("tier") == 0) | ~F.col("copied")).alias("spans"),
        F.count_if(~F.col("copied")).alias("n_live"),
        F.count_if(F.col("copied")).alias("n_copied"),
    )
    counts = [f"n_{k.name}" for k in kinds if not k.tier]
    none = {c: F.lit(0).cast("long") for c in (*counts, "n_live", "n_copied")} | {"base_sha256": F.sha2(F.lit("").cast("binary"), 256), "spans": F.lit("")}
    new = [*counts, "base_sha256", "spans", "n_live", "n_copied"]
    searched = rows.select(*_KEY, "id", "copies").join(by_row, _KEY, "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    found = searched.select(F.col("id").alias("doc_id"), *(F.coalesce(F.col(c), none[c]).alias(c) for c in new))
    return found.unionByName(read.where("text is null").select(F.col("id").alias("doc_id"), *(none[c].alias(c) for c in new)))


def secret_sql(kinds: tuple[Kind, ...] = KINDS, owners: int = OWNERS, repositories: int = REPOSITORIES) -> str:
    """``secret_scan`` of ``documents`` in DuckDB SQL; every pattern searches every text, and overlaps are a join."""
    quoted = lambda s: s.replace("'", "''")
    few = lambda chars, k: f"length(regexp_replace(value, '[^{chars}]', '', 'g')) >= {k.mixed}"
    random = lambda k: " and ".join([f"len(list_distinct(regexp_extract_all(value, '(?s).'))) >= {k.distinct}"] + ([few(c, k) for c in ("a-z", "A-Z", "0-9")] if k.mixed else []))
    found = " union all ".join(
        f"""select doc_id, owner, repository, {n} as kind, {k.tier} as tier, '{k.name}' as name, value, stop - n as start, stop from (
          select *, sum(gap + n) over (partition by doc_id order by i) as stop from (
            select doc_id, owner, repository, unnest(range(len(hits))) as i, unnest(list_transform(hits, lambda h: length(h))) as n,
              unnest(list_transform(gaps[:len(hits)], lambda g: length(g))) as gap, unnest(vals) as value
            from (select doc_id, owner, repository, regexp_extract_all(text, '{quoted(k.pattern)}') as hits, regexp_extract_all(text, '{quoted(k.pattern)}', {k.group}) as vals,
              string_split_regex(text, '{quoted(k.pattern)}') as gaps from d where regexp_matches(text, '{quoted(k.pattern)}'))))
        where length(value) >= {k.least}{f" and {random(k)}" if k.tier else ""}"""
        for n, k in enumerate(kinds)
    )
    counts = ", ".join(f"coalesce(count(*) filter (kind = {n}), 0) as n_{k.name}" for n, k in enumerate(kinds) if not k.tier)
    names = [f"n_{k.name}" for k in kinds if not k.tier]
    return f"""
with d as (select doc_id, coalesce(text, '') as text, coalesce(source, '') as owner, [coalesce(source, ''), coalesce(lang, '')] as repository from documents),
found as ({found}),
shown as (select * from found f where not exists (select 1 from found g where g.doc_id = f.doc_id and g.tier < f.tier and g.start < f.stop and g.stop > f.start)),
copied as (select value from shown group by value having count(distinct owner) >= {owners} or count(distinct (owner, repository)) >= {repositories}),
judged as (select *, value in (select value from copied) as copied, name || ':' || start || ':' || stop as s from shown),
listed as (
  select doc_id, {counts}, string_agg(s, ',' order by start, kind) filter (tier = 0) as base, string_agg(s, ',' order by start, kind) filter (tier = 0 or not copied) as spans,
    count(*) filter (not copied) as n_live, count(*) filter (copied) as n_copied
  from judged group by doc_id
)
select d.doc_id, {", ".join(f"coalesce({c}, 0)::bigint as {c}" for c in (*names, "n_live", "n_copied"))}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join listed using (doc_id)"""
