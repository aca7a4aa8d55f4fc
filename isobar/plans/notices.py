"""Queries over ``documents`` as bulletins of three kinds, read by one table of grammars."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..operators import bulletins as B
from ..operators import names as Names
from .registry import register, table

#: How the services write their bulletins.
GRAMMAR = (
    B.Section("outlook", "^Tropical Weather Outlook$", "areas", begins=r"^\d+\. .*:$", notes=r"^\*"),
    B.Section("hazards", r"^SYNOPSIS:\s*", "synopsis"),
    B.Section("hazards", "^HAZARDS$", "hazards"),
    B.Section("hazards", "^DETAILED SUMMARY$"),
    B.Section("discussion", "^Extended Forecast Discussion$", "headlines", begins=r"^\.\.\..+\.\.\.$"),
    B.Section("discussion", r"^(?=(?:6-10|8-14) DAY OUTLOOK FOR )", "periods", begins="DAY OUTLOOK FOR "),
)
FIELDS = (
    B.Field("outlook", "areas", "title", "head", r"^\d+\. (.*):$"),
    B.Field("outlook", "areas", "chance 48 h", "notes", r"(?i)Formation chance through 48 hours\.*\s*\w+\.*\s*(\d+|near 0) percent"),
    B.Field("outlook", "areas", "category 48 h", "notes", r"(?i)Formation chance through 48 hours\.*\s*(\w+)"),
    B.Field("outlook", "areas", "chance 7 d", "notes", r"(?i)Formation chance through 7 days\.*\s*\w+\.*\s*(\d+|near 0) percent"),
    B.Field("discussion", "headlines", "headline", "head", r"^\.\.\.(.+)\.\.\.$"),
    B.Field("discussion", "periods", "period", "head", r"^(\d+-\d+) DAY"),
    B.Field("discussion", "periods", "dates", "head", r"FOR ([A-Z]{3} \d{1,2}\s*-\s*(?:[A-Z]{3} )?\d{1,2} \d{4})"),
    B.Field("discussion", "periods", "confidence", "text", r"PERIOD: ([^,]+(?:, \d out of 5)?)"),
)

_LINES = r"""select doc_id, list_filter(list_transform(string_split(replace(coalesce(text, ''), chr(13), ' '), chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: regexp_matches(x, '[A-Za-z]')) as l,
  ['outlook', 'hazards', 'discussion'][doc_id % 3 + 1] as kind from documents"""
_ROWS = f"with d as ({_LINES}), r as (select doc_id, kind, unnest(l) as line, unnest(range(1, len(l) + 1))::integer as k, len(l) as n from d)"


def notices(spark, d):
    """(doc_id, kind, text): a document's lines as an outlook of areas, a list of hazards or a discussion with two periods."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), "\r", " ").alias("text"))
    tidy = F.transform(F.split("text", "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    docs = docs.select("doc_id", F.filter(tidy, lambda x: x.rlike("[A-Za-z]")).alias("l"), F.get(F.array(*map(F.lit, ("outlook", "hazards", "discussion"))), (F.col("doc_id") % 3).cast("int")).alias("kind"))
    number = lambda i: (i + 1).cast("string")
    joined = lambda f, sep: F.array_join(F.transform("l", f), sep)
    area = lambda x, i: F.concat(number(i), F.lit(". Area "), F.substring(x, 1, 12), F.lit(":\nnear "), x, F.lit("\n* Formation chance through 48 hours...low..."), F.when(i % 4 == 0, "near 0").otherwise((i % 9 * 10).cast("string")), F.lit(" percent.\n* Formation chance through 7 days...high..."), (10 * (i % 10)).cast("string"), F.lit(" percent.\n"))
    outlook = F.concat(F.lit("ABNT20\nTropical Weather Outlook\n\n"), joined(area, "\n"))
    hazards = F.concat(F.lit("US Hazards Outlook\nSYNOPSIS: a "), F.coalesce(F.get("l", F.lit(0)), F.lit("calm week")), F.lit("\n goes on.\n\nHAZARDS\n"), joined(lambda x, i: F.concat(F.lit("hazard "), x, F.lit("\n  through day "), number(i)), "\n\n"), F.lit("\n\nDETAILED SUMMARY\nnothing here counts\n"))
    discussion = F.concat(F.lit("Extended Forecast Discussion\n\n"), joined(lambda x, i: F.concat(F.lit("...On "), x, F.lit("...\nIt is "), number(i), F.lit(".\n")), "\n"), F.lit("\n6-10 DAY OUTLOOK FOR JAN 06 - 10 2026\nFORECAST CONFIDENCE FOR THE 6-10 DAY PERIOD: Average, 3 out of 5, as before\n8-14 DAY OUTLOOK FOR JAN 08 - FEB 14 2026\n"))
    return docs.select("doc_id", "kind", F.when(F.col("kind") == "outlook", outlook).when(F.col("kind") == "hazards", hazards).otherwise(discussion).alias("text"))


@register(
    "notice_items",
    rf"""{_ROWS}
    select doc_id, kind, 'areas' as section, k::integer as item, trim(regexp_replace(k || '. Area ' || left(line, 12) || ':', '\s+', ' ', 'g')) as head, 'near ' || line as text,
      '* Formation chance through 48 hours...low...' || case when (k - 1) % 4 = 0 then 'near 0' else ((k - 1) % 9 * 10)::varchar end || ' percent. * Formation chance through 7 days...high...' || 10 * ((k - 1) % 10) || ' percent.' as notes from r where kind = 'outlook'
    union all select doc_id, kind, 'synopsis', 1, 'a ' || coalesce(l[1], 'calm week'), 'goes on.', '' from d where kind = 'hazards'
    union all select doc_id, kind, 'hazards', k, 'hazard ' || line, 'through day ' || k, '' from r where kind = 'hazards'
    union all select doc_id, kind, 'headlines', k, '...On ' || line || '...', 'It is ' || k || '.', '' from r where kind = 'discussion'
    union all select doc_id, kind, 'periods', 1, '6-10 DAY OUTLOOK FOR JAN 06 - 10 2026', 'FORECAST CONFIDENCE FOR THE 6-10 DAY PERIOD: Average, 3 out of 5, as before', '' from d where kind = 'discussion'
    union all select doc_id, kind, 'periods', 2, '8-14 DAY OUTLOOK FOR JAN 08 - FEB 14 2026', '', '' from d where kind = 'discussion'""",
)
def notice_items(spark, d):
    return B.items(notices(spark, d), ["doc_id"], GRAMMAR)


@register(
    "notice_fields",
    rf"""{_ROWS}
    select doc_id, kind, 'areas' as section, k::integer as item, 'title' as field, trim(regexp_replace('Area ' || left(line, 12), '\s+', ' ', 'g')) as value from r where kind = 'outlook'
    union all select doc_id, kind, 'areas', k, 'chance 48 h', case when (k - 1) % 4 = 0 then 'near 0' else ((k - 1) % 9 * 10)::varchar end from r where kind = 'outlook'
    union all select doc_id, kind, 'areas', k, 'category 48 h', 'low' from r where kind = 'outlook'
    union all select doc_id, kind, 'areas', k, 'chance 7 d', (10 * ((k - 1) % 10))::varchar from r where kind = 'outlook'
    union all select doc_id, kind, 'headlines', k, 'headline', 'On ' || line from r where kind = 'discussion'
    union all select doc_id, kind, 'periods', p::integer, f, case p when 1 then a else b end from d, (values ('period', '6-10', '8-14'), ('dates', 'JAN 06 - 10 2026', 'JAN 08 - FEB 14 2026'), ('confidence', 'Average, 3 out of 5', null)) v(f, a, b), (values (1), (2)) q(p)
      where kind = 'discussion' and case p when 1 then a else b end is not null""",
)
def notice_fields(spark, d):
    return B.fields(B.items(notices(spark, d), ["doc_id"], GRAMMAR), ["doc_id"], FIELDS)


@register(
    "hazards_within_budget",
    f"""{_ROWS}, h as (select doc_id, k, 'hazard ' || line || ' through day ' || k as text, n from r where kind = 'hazards'),
    s as (select *, coalesce(sum(length(text) + 3) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) as before from h)
    select doc_id, string_agg(text, ' · ' order by k) as summary, count(*)::integer as kept, any_value(n)::integer as total from s where before + length(text) <= 600 group by doc_id""",
)
def hazards_within_budget(spark, d):
    """Hazards of a list, joined as long as they stay within 600 characters, and how many there are in all."""
    h = B.items(notices(spark, d), ["doc_id"], GRAMMAR).where("section = 'hazards'")
    h = h.withColumn("line", F.concat_ws(" ", "head", "text"))
    total = h.groupBy("doc_id").agg(F.count("*").cast("int").alias("total"))
    kept = B.within_budget(h, ["doc_id"], F.col("line"), 600).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("item", "line"))).alias("k"))
    return kept.join(total, "doc_id").select("doc_id", F.array_join(F.transform("k", lambda x: x["line"]), " · ").alias("summary"), F.size("k").alias("kept"), "total")


#: Words that an issuer writes where a name belongs, and a part's commonest word.
GENERIC = ("NEAR", "NR", "OBS", "FCST", "CENTRE", "CENTER", "PSN", "AT", "WI", "MOV", "TOP", "FRQ", "EMBD", "CB", "RING")


@register(
    "names_in_notices",
    f"""
with n as (select upper(name) as name, string_split(upper(name), ' ') as w, len(string_split(name, ' ')) as n
  from (select distinct p_name as name from part union select distinct p_name || ' ' || p_type from part where p_size > 25 union select distinct p_type from part union select 'ring' from part union select 'near ring' from part)
  where len(list_filter(string_split(upper(name), ' '), lambda x: x not in {GENERIC!r})) > 0),
t as (select l_orderkey, string_split(upper(string_agg('tc ' || p_name || case when p_size % 2 = 0 then ' ' || p_type else ' near ring' end, ' obs at ' order by l_linenumber, l_partkey)), ' ') as w from lineitem join part on p_partkey = l_partkey group by 1),
u as (select l_orderkey, w, unnest(w) as first_, unnest(range(len(w))) as start from t),
f as (select l_orderkey, start, n as length, name from u join n on n.w[1] = first_ and u.w[start + 1 : start + n] = n.w),
m as (select *, max(start + length) over (partition by l_orderkey order by start, length desc rows between unbounded preceding and 1 preceding) as e from f)
select l_orderkey, start::integer as start, length::integer as length, name from m where e is null or start + length > e""",
)
def names_in_notices(spark, d):
    """Names and kinds of parts in a notice of each order's lines; a kind that a longer name holds isn't listed."""
    p = table(spark, d, "part")
    line = F.concat(F.lit("tc "), "p_name", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), "p_type")).otherwise(" near ring"))
    said = table(spark, d, "lineitem").join(p, F.col("p_partkey") == F.col("l_partkey")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", line.alias("s")))).alias("s"))
    texts = said.select("l_orderkey", F.array_join(F.transform("s", lambda x: x["s"]), " obs at ").alias("text"))
    names = p.select(F.upper("p_name").alias("name")).union(p.where("p_size > 25").select(F.upper(F.concat("p_name", F.lit(" "), "p_type")))).union(p.select(F.upper("p_type"))).union(p.select(F.explode(F.array(F.lit("RING"), F.lit("NEAR RING")))))
    return Names.mentions(texts, ["l_orderkey"], "text", names.distinct(), "name", GENERIC)


#: The grammar of an advisory of tracks and what its lines say; a letter's last point before the ocean, or a domestic one.
TRACKS = (B.Section("tracks", "^TODAYS TRACKS:", "tracks", begins=r"^TRACK\s+[A-Z]\s+\S+\s*$"),)
TRACK_FIELDS = (B.Field("tracks", "tracks", "letter", "head", r"^TRACK\s+([A-Z])\s"), B.Field("tracks", "tracks", "entry", "head", r"([A-Z]{5})(?:\.NAT[A-Z])?$"))
_CODE = "translate(lpad((l_partkey % 100000)::varchar, 5, '0'), '0123456789', 'ABCDEFGHIJ')"


#: Lines of orders that a task makes advisories of: what it holds doesn't grow with the table.
LINES_PER_TASK = 100_000


def advisories(spark, d):
    """(o_orderkey, kind, text): a track for each line of an order; lines of 40 pieces or more are unavailable points."""
    lines = table(spark, d, "lineitem")
    line = lines.repartition(lines.count() // LINES_PER_TASK + 1, "l_orderkey").withColumn("code", F.translate(F.lpad((F.col("l_partkey") % 100_000).cast("string"), 5, "0"), "0123456789", "ABCDEFGHIJ"))
    letter = F.char(65 + F.col("l_linenumber") % 5)
    track = F.concat(F.lit("TRACK  "), letter, F.lit("  AAA.LBSTA8.."), "code", F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit(".NAT"), letter)).otherwise(""))
    gone = F.when(F.col("l_quantity") >= 40, F.col("code"))
    one = F.struct("l_linenumber", "l_partkey", "l_suppkey", track.alias("track"), gone.alias("gone"))
    g = line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(one)).alias("l"))
    points = F.array_compact(F.transform("l", lambda x: x["gone"]))
    said = F.when(F.size(points) > 1, F.concat(F.array_join(points, " & "), F.lit(" ARE UNAVAILABLE"))).when(F.size(points) == 1, F.concat(F.array_join(points, ""), F.lit(" INTERSECTION IS NOT AVAILABLE"))).otherwise("ALL ROUTE FLOWS ARE OPEN")
    text = F.concat(F.lit("AS PER NOTAM, "), said, F.lit(".\n\nTRACK X BEFORE\nTODAYS TRACKS:\n"), F.array_join(F.transform("l", lambda x: x["track"]), "\n"), F.lit("\n"))
    return g.select("o_orderkey", F.lit("tracks").alias("kind"), text.alias("text"))


@register(
    "track_entries",
    f"""with t as (select l_orderkey as o_orderkey, chr(65 + l_linenumber % 5) as letter, {_CODE} as entry, row_number() over (partition by l_orderkey, l_linenumber % 5 order by l_linenumber, l_partkey, l_suppkey) as r from lineitem)
    select o_orderkey, letter, entry, row_number() over (partition by o_orderkey order by letter)::integer as place from t where r = 1""",
)
def track_entries(spark, d):
    """The entry point of each lettered track, the first of a letter, in the letters' order from the north."""
    f = B.fields(B.items(advisories(spark, d), ["o_orderkey"], TRACKS), ["o_orderkey"], TRACK_FIELDS)
    value = lambda name: F.max(F.when(F.col("field") == name, F.col("value")))
    tracks = f.groupBy("o_orderkey", "item").agg(value("letter").alias("letter"), value("entry").alias("entry"))
    # The letters' own order serves both windows, so that the first of a letter and its place take one sort.
    earlier = F.lag("item").over(Window.partitionBy("o_orderkey", "letter").orderBy("item"))
    first = tracks.withColumn("earlier", earlier).where("earlier is null")
    place = F.row_number().over(Window.partitionBy("o_orderkey").orderBy("letter"))
    return first.select("o_orderkey", "letter", "entry", place.alias("place"))


@register(
    "unavailable_points",
    f"""with g as (select l_orderkey as o_orderkey, {_CODE} as code, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as r from lineitem where l_quantity >= 40),
    f as (select o_orderkey, code, min(r) as r from g group by all) select o_orderkey, string_agg(code, ',' order by r) as points from f group by 1""",
)
def unavailable_points(spark, d):
    return advisories(spark, d).select("o_orderkey", F.array_join(X.unavailable_points(F.col("text")), ",").alias("points")).where("points <> ''")


_ELEMENT = "case when o_orderkey % 7 = 0 then 'NO CENTRE' else chr((65 + o_custkey % 20)::integer) || 'AB AND ' || chr((65 + o_orderkey % 20)::integer) || 'CD/Z' || chr((65 + o_custkey % 11)::integer) || 'Y' end"


@register(
    "centres_of_places",
    f"""with e as (select o_orderkey, o_custkey, {_ELEMENT} as element from orders), p as (
      select chr((65 + o_custkey % 20)::integer) || 'AB' as place, 'Z' || chr((65 + o_custkey % 11)::integer) || 'Y' as centre, o_orderkey, 0 as i from e where element <> 'NO CENTRE'
      union all select chr((65 + o_orderkey % 20)::integer) || 'CD', 'Z' || chr((65 + o_custkey % 11)::integer) || 'Y', o_orderkey, 1 from e where element <> 'NO CENTRE')
    select place, arg_min(centre, (o_orderkey, i)) as centre, count(*) as n from p group by place""",
)
def centres_of_places(spark, d):
    """The centre that the first control element names for each place, from elements such as ``AAB AND BCD/ZAY``."""
    o = table(spark, d, "orders")
    letter = lambda n: F.char((65 + n).cast("int"))
    element = F.when(F.col("o_orderkey") % 7 == 0, "NO CENTRE").otherwise(F.concat(letter(F.col("o_custkey") % 20), F.lit("AB AND "), letter(F.col("o_orderkey") % 20), F.lit("CD/Z"), letter(F.col("o_custkey") % 11), F.lit("Y")))
    e = o.select("o_orderkey", X.centre_of(element).alias("centre"), F.posexplode(X.places_of(element)).alias("i", "place"))
    first = F.min(F.struct("o_orderkey", "i", "centre"))
    return e.groupBy("place").agg(first.alias("f"), F.count("*").alias("n")).select("place", F.col("f.centre").alias("centre"), "n")
