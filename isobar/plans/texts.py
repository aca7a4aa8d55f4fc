"""Queries over documents, pages, conversations and names as bulletins, lists, messages and a privacy corpus."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from .registry import register, table

#: Ordered patterns; the first that is found names the kind.
_CASCADE = [("ION.*THE", "closure"), ("^TH", "program"), ("^(ER|EN)", "stop"), ("EAU|OU", "route"), ("(^|[^A-Z])DE([^A-Z]|$)", "delay")]


@register("title_cascade", "with t as (select doc_id, upper(text) as t from documents) select doc_id, case " + " ".join(f"when regexp_matches(t, '{p}') then '{k}'" for p, k in _CASCADE) + " else 'other' end as kind from t")
@register("title_cascade_whole")
def title_cascade(spark, d):
    """The cascade over whole texts."""
    return table(spark, d, "documents").select("doc_id", X.first_kind(F.upper("text"), _CASCADE, "other").alias("kind"))


_TITLES = [
    "VOLCANIC ACTIVITY BULLETIN", "OPERATIONS PLAN", "CDM GROUND STOP", "GS", "GROUND DELAY PROGRAM", "CDM GDP", "AIRSPACE FLOW PROGRAM", "AFP", "CTOP", "OCEANIC ROUTE CLOSURE", "ATLANTIC ROUTE CLOSURE_RQD",
    "NATOTS", "SWAP IMPLEMENTATION", "ROUTE_RMD", "FCA", "TUNNEL", "SCHEDULING DELAYS", "DIVERSION RECOVERY", "HOTLINE", "agdpx",
]
_ENDINGS = ["", " CNX", " cancelled", " PROPOSED", " - PLAYBOOK", " CNX PROPOSED"]


def _title_sql() -> str:
    # RE2's word boundary is the ASCII one, as all of these titles are.
    whens = []
    for pattern, kind, variants in X.TITLE_KINDS:
        inner = "".join(f"when regexp_matches(t, '{p}') then '{k}' " for p, k in variants)
        whens.append(f"when regexp_matches(t, '{pattern}') then " + (f"case {inner}else '{kind}' end" if inner else f"'{kind}'"))
    titles, endings = ", ".join(f"'{x}'" for x in _TITLES), ", ".join(f"'{x}'" for x in _ENDINGS)
    return f"with o as (select o_orderkey, upper([{titles}][o_custkey % {len(_TITLES)} + 1] || [{endings}][o_orderkey % {len(_ENDINGS)} + 1]) as t from orders) select o_orderkey, case {' '.join(whens)} else 'other' end as kind from o"


@register("title_kinds", _title_sql())
def title_kinds(spark, d):
    """Titles made of a subject and an ending; cancelled and proposed ones are kinds of their own."""
    pick = lambda values, k: F.get(F.array(*map(F.lit, values)), (F.col(k) % len(values)).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", X.title_kind(F.concat(pick(_TITLES, "o_custkey"), pick(_ENDINGS, "o_orderkey"))).alias("kind"))


@register("clipped_text", r"""with t as (select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) as t from documents) select doc_id, case when length(t) > 80 then regexp_replace(substr(t, 1, 79), '\s+\S*$', '') || '…' else t end as short from t""")
def clipped_text(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clipped(F.col("text"), 80).alias("short"))


@register(
    "private_terms",
    r"""with h as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) as t from documents), p as (select doc_id, unnest(regexp_extract_all(text, '(/home/|/Users/|C:\\Users\\)[A-Za-z0-9._-]+')) as t from documents)
    select doc_id, 'email' as rule, t as term from h union all select doc_id, 'local path', t from p""",
)
def private_terms(spark, d):
    t = table(spark, d, "documents")
    of = lambda rule, pattern: t.select("doc_id", F.lit(rule).alias("rule"), F.explode(F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))).alias("term"))
    return of("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}").unionByName(of("local path", r"(?:/home/|/Users/|C:\\Users\\)[A-Za-z0-9._-]+"))


_TERMS = ["idiot", "moron", "clown", "worthless", "pathetic", "stupid"]


@register(
    "listed_terms_escalated",
    f"""with h as (select doc_id, w.term, len(regexp_extract_all(lower(text), '\\b' || w.term || '\\b')) as n from documents, (select unnest({_TERMS!r}) as term) w)
    select doc_id, term, n, (count(*) over (partition by doc_id)) >= 3 as fatal from h where n > 0""",
)
def listed_terms_escalated(spark, d):
    """Three different terms of a list in one file make each of its hits fatal."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\b(" + "|".join(_TERMS) + r")\b"), F.lit(1))
    hits = table(spark, d, "documents").select("doc_id", F.explode(words).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("n"))
    return hits.withColumn("fatal", F.count("*").over(Window.partitionBy("doc_id")) >= 3)


@register("link_rows", r"""select page_id, i::integer as i, m[i + 1] as link, regexp_extract(m[i + 1], '>([^<]*)</a>', 1) as label from (select page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') as m, unnest(range(len(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')))) as i from pages)""")
def link_rows(spark, d):
    m = F.regexp_extract_all("html", F.lit('(<a href="[^"]*">[^<]*</a>)'), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.posexplode(m).alias("i", "link")).withColumn("label", F.regexp_extract("link", ">([^<]*)</a>", 1))


@register("page_titles", "select page_id, replace(replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&quot;', '\"') as title from pages")
def page_titles(spark, d):
    return table(spark, d, "pages").select("page_id", X.plain(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@register("page_body_text", r"select page_id, length(trim(regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)>[^<]*(</p>[^<]*)?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) as n from pages")
def page_body_text(spark, d):
    bare = F.regexp_replace(F.regexp_replace("html", "<(script|style)>[^<]*(</p>[^<]*)?</(script|style)>", " "), "<[^>]*>", " ")
    return table(spark, d, "pages").select("page_id", F.char_length(X.collapsed(bare)).cast("long").alias("n"))


@register("page_hosts", "select regexp_extract(url, '^https?://([^/]+)/', 1) as host, count(*) as n, min(page_id) as first_page from pages group by 1")
def page_hosts(spark, d):
    return table(spark, d, "pages").groupBy(F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("host")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))


@register("ordered_messages", "select conv_id, count(*) as parts, md5(string_agg(text, '|' order by turn)) as digest from conversations group by conv_id")
def ordered_messages(spark, d):
    parts = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("parts"), F.md5(F.array_join(F.transform(parts, lambda p: p["text"]), "|")).alias("digest"))


@register("first_and_last_turn", "select conv_id, arg_min(role, turn) as first_role, arg_max(role, turn) as last_role, sum(length(text))::bigint as n from conversations group by conv_id")
def first_and_last_turn(spark, d):
    g = table(spark, d, "conversations").groupBy("conv_id")
    return g.agg(F.min(F.struct("turn", "role"))["role"].alias("first_role"), F.max(F.struct("turn", "role"))["role"].alias("last_role"), F.sum(F.char_length("text")).alias("n"))


@register("turns_within_budget", "select conv_id, turn from (select conv_id, turn, sum(length(text)) over (partition by conv_id order by turn rows unbounded preceding) as s from conversations) where s <= 1500")
def turns_within_budget(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, d, "conversations").withColumn("s", F.sum(F.char_length("text")).over(w)).where("s <= 1500").select("conv_id", "turn")


@register(
    "identity_lines",
    r"""with t as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda l: trim(regexp_replace(l, '[ \t\n\x0B\f\r]+', ' ', 'g'))), lambda l: l <> '') as lines from documents)
    select doc_id, coalesce(list_filter(lines, lambda l: regexp_matches(l, '(?i)licen[sc]e'))[1], array_to_string(lines, ' ')) as line from t""",
)
@register("identity_lines_whole")
def identity_lines(spark, d):
    """The first licence line, else the whole text; white space is one blank and empty lines don't count."""
    lines = F.filter(F.transform(F.split("text", "\n"), X.collapsed), lambda l: l != "")
    found = F.get(F.filter(lines, lambda l: l.rlike("(?i)licen[sc]e")), F.lit(0))
    return table(spark, d, "documents").select("doc_id", F.coalesce(found, F.array_join(lines, " ")).alias("line"))


@register("title_case", """select p_partkey, array_to_string(list_transform(string_split(lower(p_name || '-' || p_brand || '/' || p_type), ''), lambda c, i: case when i = 1 or regexp_matches(string_split(lower(p_name || '-' || p_brand || '/' || p_type), '')[i - 1], '[\\s\\-(/"'']') then upper(c) else c end), '') as name from part""")
def title_case(spark, d):
    return table(spark, d, "part").select("p_partkey", X.title_case(F.concat("p_name", F.lit("-"), "p_brand", F.lit("/"), "p_type")).alias("name"))


@register("unmentioned_suppliers", "select s_suppkey from supplier s where not exists (select 1 from orders o where o.o_orderdate >= timestamp '1998-07-01' and contains('Supplier#' || lpad((o.o_custkey % 80)::varchar, 9, '0'), s.s_name))")
@register("unmentioned_suppliers_all")
def unmentioned_suppliers(spark, d):
    """Names that no recent text holds: names are looked up by their tokens, not compared with every text."""
    texts = table(spark, d, "orders").where("o_orderdate >= timestamp_ntz '1998-07-01'").select(F.concat(F.lit("Supplier#"), F.lpad((F.col("o_custkey") % 80).cast("string"), 9, "0")).alias("t"))
    tokens = texts.select(F.explode(F.regexp_extract_all("t", F.lit(r"(\w+#\d+)"), F.lit(1))).alias("s_name")).distinct()
    return table(spark, d, "supplier").join(tokens, "s_name", "left_anti").select("s_suppkey")


@register("coded_words", r"""select doc_id, len(list_filter(string_split(text, ' '), lambda w: regexp_matches(w, '^[A-Z]{2,}'))) as capitals, len(list_filter(string_split(text, ' '), lambda w: regexp_matches(w, '^[+-]?(TS|RA|DE|LA)$'))) as codes from documents""")
def coded_words(spark, d):
    words = F.split("text", " ")
    n = lambda p: F.size(F.filter(words, lambda w: w.rlike(p))).cast("long")
    return table(spark, d, "documents").select("doc_id", n("^[A-Z]{2,}").alias("capitals"), n("^[+-]?(TS|RA|DE|LA)$").alias("codes"))


@register(
    "key_value_fields",
    r"""with t as (select o_orderkey, 'ELEMENT: ' || o_orderpriority || chr(10) || case when o_orderkey % 3 = 0 then 'REASON:  ' || o_orderstatus || ' ' || chr(10) else '' end || 'CAUSE: ' || (o_custkey % 7) as t from orders)
    select o_orderkey, trim(regexp_extract(t, 'ELEMENT: ([^\n]*)', 1)) as element, coalesce(case when regexp_matches(t, 'REASON:') then trim(regexp_extract(t, 'REASON:[ \t]*([^\n]*)', 1)) end, 'cause ' || regexp_extract(t, 'CAUSE: ([^\n]*)', 1)) as reason from t""",
)
def key_value_fields(spark, d):
    reason = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("REASON:  "), "o_orderstatus", F.lit(" \n"))).otherwise("")
    t = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("ELEMENT: "), "o_orderpriority", F.lit("\n"), reason, F.lit("CAUSE: "), (F.col("o_custkey") % 7).cast("string")).alias("t"))
    return t.select("o_orderkey", X.field(F.col("t"), "ELEMENT").alias("element"), F.coalesce(X.field(F.col("t"), "REASON"), F.concat(F.lit("cause "), X.field(F.col("t"), "CAUSE"))).alias("reason"))


@register("duplicate_texts", "select doc_id, min(doc_id) over (partition by sha256(text)) as first_id from documents")
def duplicate_texts(spark, d):
    """The first row of each text by digest; counts are combined before the shuffle, so a copy of any frequency is one row a task."""
    t = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    firsts = t.groupBy("h").agg(F.min("doc_id").alias("first_id"))
    return t.join(firsts, "h").select("doc_id", "first_id")


@register("labels_by_language", "select lang, count(*) as n, count(*) filter (quality = 1) as good, count(*) filter (toxic = 1) as toxic from documents join labels using (doc_id) group by lang")
def labels_by_language(spark, d):
    j = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return j.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"))
