"""A training corpus from ``documents``: quality rules, near-duplicates, decontamination, personal data, tokens.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's documents. All but the
last keep the columns of ``documents``, whatever they are. run() writes each stage's result to the shared folder and
reads it again, so that a lost executor costs a stage's tasks and never the stages before.

Defined results: a null or empty text is rejected by the first stage (it has no words); a null doc_id is kept and is no copy of
another; rows that repeat, id and all, stay together through near-duplicates, of equal texts with different ids the smallest id stays;
long texts are read whole in every stage; an empty table passes through as an empty table; further columns are kept, whatever
their names, up to the last stage, which returns doc_id, counts, digests and ids only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontam, neardup, pii, quality
from tessera.llm.common import cut


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality.filter_documents(docs)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return neardup.deduplicate(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with tags in place of personal data."""
    return pii.redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, with their digests."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [("quality", keep_good), ("near_dedup", keep_first), ("decontaminate", keep_clean), ("redact", redact), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Near-duplicate components and token ids have no form in SQL that runs on whole tables; tests/llm holds a plain version.
ORACLE_SQL = None
