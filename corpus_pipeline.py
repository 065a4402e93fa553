"""From raw documents to token ids, in stages that are each written and read again.

Toxic documents go, then all but one of each group of near-duplicates, then the words of passages that an
earlier document has, then documents that hold a benchmark item; what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, decontamination, simhash, substring_dedup, toxicity
from ledgerlens.llm.common import table
from ledgerlens.session import materialize

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substring_dedup.rewrite(docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", length).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, token_ids, n_tokens, ids_sha256, decoded_sha256)``."""
    tokens = bpe.encode(docs, WORD_BPE, decoded=True)
    return bpe.digests(tokens.withColumn("ids", F.col("token_ids")), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("encode", encode),
]

# Fingerprints, word-level models and BPE have no SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
