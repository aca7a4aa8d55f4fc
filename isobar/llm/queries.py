"""One registered query for each operator, over its whole tables with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reachable
from .bpe import round_trip
from .classifier import quality_classifier
from . import chat, rans
from .divergence import divergence_audit, divergence_sql
from .fingerprints import likeness
from .html import extract
from .licences import licence_scan, licence_sql
from .minhash import near_duplicates
from .packing import pack_documents
from .resampling import importance_resample, resample_sql
from .rules import quality_rules
from .secrets import secret_scan, secret_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), columns=["doc_id"]).select("doc_id", "rules.*")


def op6_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint's likeness is 1 for equal canonical texts and 0 otherwise; bytes are compared where digests agree."""
    return likeness(_table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings, as records of several layouts that their fingerprints map back to turns,
    formatted; turns and masked texts are read back from the strings."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records, own = chat.as_records(rows.unionByName(chat.example(spark, -7, "\\### Assistant: </turn> ok")))
    turns = chat.turns_of_json(records).unionByName(chat.canonical_turns(own))
    back = chat.read_back(chat.conversations(chat.formatted_turns(turns)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = rans.store(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rans.read(spark, path, of=("ids_crc32 long", zlib.crc32))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(_table(spark, sf_dir, "documents"), columns=["doc_id"]).select("doc_id", "classifier.*")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source stands for an owner, and its documents of one language for a repository: the table has neither."""
    return secret_scan(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_minhash": op1_minhash, "op2_packing": op2_packing, "op3_bpe": op3_bpe, "op4_licences": op4_licences, "op5_rules": op5_rules, "op6_digest": op6_digest, "op7_chat": op7_chat, "op8_rans": op8_rans, "op9_html": op9_html, "op10_classifier": op10_classifier, "op11_resampling": op11_resampling, "op12_secrets": op12_secrets, "op13_divergence": op13_divergence}


def oracle_sql() -> dict[str, str]:
    return {"op4_licences": licence_sql(), "op11_resampling": resample_sql(), "op12_secrets": secret_sql(), "op13_divergence": divergence_sql()}
