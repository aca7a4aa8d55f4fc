"""The corpus pipeline: quality rules, quality classifier, near-duplicates, packing, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.classifier import quality_classifier
from isobar.llm.minhash import near_duplicates
from isobar.llm.packing import pack_documents
from isobar.llm.rules import quality_rules
from isobar.llm.shared import free_name, written
from isobar.session import reachable

#: Ids of removed documents up to which they are broadcast (8 bytes each); beyond, a shuffled join removes them.
BROADCAST_IDS = 500_000
TOKENIZER = "word_bpe_49k.json"
#: Near-duplicates of the pipeline: runs of five words, 0.8. A pair at 0.8 differs in all 51 bands of 6 with (1 - 0.8^6)^51 = 1.9e-7.
NEAR = {"size": 5, "percent": 80, "bands": 51, "rows": 6}


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits or that the rules' posterior rejects go.

    Null and empty texts have no words and go; repeated rows stay or go together, whatever their ids. An empty table stays
    empty; other columns pass through, whatever their names.
    """
    return quality_rules(docs, into=free_name(docs, "rules"), reread=True).where(f"`{free_name(docs, 'rules')}`.kept").select(*columns(docs))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer rejects go.

    Equal texts stay or go together; a null or empty text, of which the rules leave none, is scored as a single blank. An empty
    table stays empty; other columns pass through, whatever their names.
    """
    return quality_classifier(docs, into=free_name(docs, "classifier"), reread=True).where(f"`{free_name(docs, 'classifier')}`.kept").select(*columns(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays, and of its repeated rows (id and text) one.

    Rows of one id with different texts stay or go together; empty texts and rows without an id are no copies of others.
    """
    gone = written(near_duplicates(docs, **NEAR).where("not kept").select("doc_id").distinct(), "gone")
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    often = written(left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "often")
    n = often.limit(BROADCAST_IDS + 1).count()
    if not n:
        return left
    often = F.broadcast(often) if n <= BROADCAST_IDS else often
    words = F.col("text").rlike(r"[^ \t-\r]")
    some = left.join(often, "doc_id", "left_semi").select(*docs.columns)
    one = some.where(words).dropDuplicates(["doc_id", "text"])
    return left.join(often, "doc_id", "left_anti").select(*docs.columns).unionByName(one).unionByName(some.where(~F.coalesce(words, F.lit(False))))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their place in sequences of 4096 tokens.

    A null or empty text is its end token alone; rows of one id, or without an id, are documents of their own. An empty table gives
    no pieces; columns other than doc_id and text are left out.
    """
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality rules", rules_stage), ("quality classifier", classifier_stage), ("near-duplicates", dedup_stage), ("packing", packing_stage)]

#: Expectation-maximisation, training and packing have no SQL; tests hold every stage and the whole run against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again by the next."""
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
