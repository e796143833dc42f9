"""A corpus pipeline: quality rules, near duplicates, benchmark passages, the mix, shards.

Every stage is a function of ``(spark, docs, sf_dir)``; ``run`` writes what a stage returns as
Parquet in the shared work folder and hands the table read from there to the next stage.  All
stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowflow.llm import decontam, mixing, quality, sharding, simhash
from rowflow.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy accepts."""
    return quality.apply_policy(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the shard they go to."""
    return sharding.extendible_shards(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: SQL cannot express the near duplicates and the mix; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
