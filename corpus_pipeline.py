"""A training corpus from `documents`: five of the operators, one after the other.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  Its result is written as Parquet and read again as the next
stage's docs.  All stages but the last return the columns of documents, extra ones included.  Nulls in any column, empty and very
long texts, ties, repeated rows and empty tables have the results that each stage names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import decontam, langid, minhash, mixing, queries, tokens
from strandline.llm.common import materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose leading language has at least 40 % of the words.

    Documents without a letter (null and empty texts among them) go; so do all, if no labelled language can be learned.
    """
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that with the smallest id.

    Null ids and texts without words stay; repeated rows of one document become one.
    """
    return minhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with benchmark passages on 1 / 20 of their words or more; documents without words stay."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources meet their target weights, shuffled inside each shard.

    A text without words is never taken; a null source is a source of its own.
    """
    rows = mixing.mixed_rows(docs)
    return rows.repartition("__shard").sortWithinPartitions("__shard", "__turn").select(*docs.columns)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet-matrix shards, read back: one row per document of the mix; a null id sorts first."""
    return tokens.token_table(docs, queries.tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix_sources),
    ("token_shards", token_shards),
]

#: DuckDB cannot express the stages; tests/llm/test_pipeline.py compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
