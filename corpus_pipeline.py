"""Corpus pipeline: quality rules, near-duplicate join, benchmark decontamination, PII
surrogates and packing, each stage written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

import os
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from landframe.llm import decontaminate, near_duplicates, packing, pii, quality_rules  # noqa: E402
from landframe.session import checkpoint_dir  # noqa: E402


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage may have changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or a rule in which their host is bad, go."""
    return quality_rules.keep_good_documents(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_duplicates.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; a document of which nothing is left goes."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_length(decontaminate.remove_benchmark_overlap(docs, benchmark))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    return with_length(pii.replace_pii(docs, pii.QUERY_KEY))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into windows of 1024 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(packing.QUERY_VOCABULARY))


STAGES = [
    ("quality_rules", quality_stage),
    ("jaccard_join", dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii_surrogates", pii_stage),
    ("packing", packing_stage),
]

#: tokenizers and keyed surrogates have no SQL form; tests/llm holds run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stages are written under the shared checkpoint folder."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
