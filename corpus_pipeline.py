"""From raw documents to a weighted training corpus, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the driver, or run(), writes
it as Parquet and gives what was read back to the next one. All but the last return the
columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapledger.llm import decontaminate, exact_dedup, language_id, mixing, parity_join  # noqa: E402
from snapledger.llm.common import stored  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return language_id.drop_rejected(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (80 % of shingles of five words) the smallest id stays."""
    return parity_join.drop_near(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go. n_chars follows
    the text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = decontaminate.decontaminate(docs, items)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def weigh_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the number of times the mix uses it and its first place in it."""
    return mixing.weigh(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near duplicates", drop_near_copies),
    ("decontamination", remove_benchmark),
    ("mixing", weigh_sources),
]

# Language identification and the suffix automaton are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
