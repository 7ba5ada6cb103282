"""Cleaning a corpus in five stages: quality, toxicity, near duplicates, benchmark leaks, tokens.

Each stage takes the rows its predecessor kept, read back from Parquet, and all but the last return
the columns of ``documents``. The last gives token counts and digests of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import bpe, decontaminate, neardup, quality, toxicity
from tidegrid.llm.common import small_batches, table
from tidegrid.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules accept."""
    return quality.apply_quality(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the classifier learns from the labelled ones among them."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact or near copies."""
    small_batches(spark)
    return neardup.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document left."""
    small_batches(spark)
    path, pattern = bpe.multilingual()
    return bpe.encode_column(docs, path, pattern, keep=["doc_id"], with_ids=False)


STAGES = [
    ("quality", quality_rules),
    ("toxicity", toxic_documents),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("byte_bpe", byte_pairs),
]

#: SQL can express neither the classifier nor the signatures nor the latent search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read back before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
