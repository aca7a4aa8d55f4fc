"""Importance resampling towards a target distribution, from a table of word positions.

A text is a table of its words' positions (``posexplode``). A feature of k words is a position's word with the words that
``lead()`` finds after it in its document; features are hashed into buckets, counted over the corpus and over the target,
and each bucket's gain is the logarithm of how much more often the target has it. A document's weight is the sum of its
features' gains. Gumbel noise that depends on the id alone turns the greatest scores into a sample without replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import beside, numbered, written

#: Words, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Production parameters: words of a feature, buckets, words that a document needs to be drawn, its share in percent, seed.
MAX_ORDER, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
_KEY = ["id", "a", "b"]


def _rows(docs: DataFrame, id: str | None, text: str, max_order: int) -> DataFrame:  # noqa: A002
    """(id, a, b, text, copies): a and b are hashes of the text, which with the id name a row.

    Where words are led over, equal rows come together first, so that positions occur once; else they meet in the sums.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    number = F.col(f"`{id}`").cast("long") if id else F.lit(None).cast("long")
    rows = docs.select(number.alias("id"), whole.alias("text"))
    rows = rows.groupBy("id", "text").agg(F.count("*").alias("copies")) if max_order > 1 else rows.withColumn("copies", F.lit(1).cast("long"))
    return rows.select("id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit("second half"), "text").alias("b"), "text", "copies")


def positions(rows: DataFrame) -> DataFrame:
    """(id, a, b, copies, pos, word): one row for each word, and one without a word for each text that has none."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))
    return rows.select(*_KEY, "copies", F.posexplode_outer(words).alias("pos", "word"))


def features(rows: DataFrame, max_order: int, buckets: int) -> DataFrame:
    """(id, a, b, copies, pos, k, bucket): the runs of 1 to ``max_order`` words from each position; k is a run's words less one."""
    at = positions(rows)
    if max_order == 1:
        grams = at.withColumn("k", F.lit(0)).withColumnRenamed("word", "gram")
    else:
        order = Window.partitionBy(*_KEY).orderBy("pos")
        runs: list[Column] = [F.col("word")]
        for k in range(1, max_order):
            runs.append(F.concat(runs[-1], F.lit(" "), F.lead("word", k).over(order)))
        grams = at.select("*", F.array(*runs).alias("runs")).select(*_KEY, "copies", "pos", F.posexplode("runs").alias("k", "gram")).where("k = 0 or gram is not null")
    return grams.select(*_KEY, "copies", "pos", "k", (F.crc32(F.col("gram").cast("binary")) % buckets).alias("bucket"))


def _counts(rows: DataFrame, name: str, max_order: int, buckets: int) -> DataFrame:
    return features(rows, max_order, buckets).where("bucket is not null").groupBy("bucket").agg(F.sum("copies").alias(name))


def gains(docs: DataFrame, target: DataFrame, *, text: str = "text", target_text: str = "text", max_order: int = MAX_ORDER, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket that a document's feature falls into: at most ``buckets`` rows.

    The gain is floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) for s of the corpus' S features and t of the
    target's T in the bucket, in doubles. A target without words gives every bucket its gain from s alone.
    """
    s, t = _counts(_rows(docs, None, text, max_order), "s", max_order, buckets), _counts(_rows(target, None, target_text, max_order), "t", max_order, buckets)
    both = written(s.join(t, "bucket", "full").select("bucket", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t"))), "gains")
    total = both.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("s", "t"))).first()
    ratio = ((F.col("t") + 1) * F.lit(total.s + buckets)) / ((F.col("s") + 1) * F.lit(total.t + buckets))
    return both.where("s > 0").select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def noise(id: Column, seed: int = SEED) -> Column:  # noqa: A002
    """1000 times Gumbel noise, rounded down, of the hash of ``seed:id``; a null id is hashed as an empty string."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance_resample(
    docs: DataFrame, target: DataFrame, *, id: str = "doc_id", text: str = "text", target_text: str = "text",  # noqa: A002
    max_order: int = MAX_ORDER, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (null if it isn't drawn), all long, whatever the id's column is called.

    Of the N rows with at least ``least_words`` words the floor(percent N / 100) of the highest scores are drawn; on ties the
    smaller id goes first, rows without an id last, then the text's hash decides. Null and empty texts and texts without
    words have no features and weight 0. Repeated rows have equal weights and scores and count as often as they occur, in the
    corpus and in the draw, with a rank each. Rows of one id with different texts are weighed apart and share their noise.
    Empty tables give an empty result or, as a target, gains from the corpus alone. Other columns are left out, whatever
    their names. A text is held by one task, as one row is; its words are summed before anything is shuffled.
    """
    gain = gains(docs, target, text=text, target_text=target_text, max_order=max_order, buckets=buckets)
    runs = beside(features(_rows(docs, id, text, max_order), max_order, buckets), gain, ["bucket"])
    of_copy = lambda column: F.coalesce(F.sum(column * F.col("copies")), F.lit(0))
    one = F.when((F.col("k") == 0) & (F.coalesce(F.col("pos"), F.lit(0)) == 0), 1)
    word, found = F.when((F.col("k") == 0) & F.col("pos").isNotNull(), 1), F.when(F.col("bucket").isNotNull(), 1)
    sums = runs.groupBy(*_KEY).agg(of_copy(one).alias("m"), of_copy(word).alias("n_words"), of_copy(found).alias("n_features"), of_copy(F.col("gain")).alias("weight"))
    each = lambda c: F.expr(f"{c} div m").alias(c)
    rows = sums.select(*_KEY, "m", each("n_words"), each("n_features"), each("weight")).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = written(rows, "scored")
    fit = scored.where(F.col("n_words") >= least_words)
    drawn = percent * int(fit.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n")).first().n) // 100
    several = lambda df: df.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("a"), F.col("b"), F.col("copy")]
    ranked = numbered(several(fit).drop("m", "n_words"), order, "rank", drawn)
    rest = several(scored.where(F.col("n_words") < least_words)).drop("m", "n_words").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def resample_sql(buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> str:
    """``importance_resample`` of ``documents`` towards ``benchmark`` in DuckDB SQL, for features of one word."""
    words = lambda table, id: f"select {id} as id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')) as word from {table}"  # noqa: E731, A002
    step = "list_reduce(list_prepend(xor(c, b), [0::bigint for i in range(8)]), lambda x, y: xor(x >> 1, case when x & 1 = 1 then 3988292384::bigint else 0::bigint end))"
    return f"""
with corpus as ({words("documents", "doc_id")}), target as ({words("benchmark", "item_id")}),
vocabulary as (select distinct word from (select word from corpus union all select word from target)),
hashed as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, [('0x' || substr(h, 2 * i + 1, 2))::bigint for i in range(len(h) // 2)]), lambda c, b: {step}), 4294967295) % {buckets} as bucket
  from (select word, hex(encode(word)) as h from vocabulary)
),
s as (select bucket, count(*) as s from corpus join hashed using (word) group by bucket),
t as (select bucket, count(*) as t from target join hashed using (word) group by bucket),
gain as (
  select bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::double * ((select coalesce(sum(s), 0) from s) + {buckets})::double)
    / ((s + 1)::double * ((select coalesce(sum(t), 0) from t) + {buckets})::double)))::bigint as gain
  from s left join t using (bucket)
),
weighed as (select id, count(*) as n, sum(gain)::bigint as weight from corpus join hashed using (word) join gain using (bucket) group by id),
scored as (
  select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::bigint::double + 0.5) / 4294967296.0::double)))::bigint as score
  from documents left join weighed on id = doc_id
),
placed as (select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as total from scored where n_features >= {least_words})
select s.doc_id, n_features, weight, score, case when place <= {percent} * total // 100 then place end as rank
from scored s left join placed p on p.doc_id = s.doc_id"""
