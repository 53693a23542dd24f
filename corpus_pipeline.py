"""The training-data pipeline: toxicity, near duplicates, benchmark passages,
source mixing and sharding, each an operator of ``pitpanel.llm``.

Every stage takes (spark, docs, sf_dir), works on the whole of ``docs`` and is
written as Parquet before the next one reads it.  All but the last return the
columns of ``documents``; the mix repeats a document's row for each use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitpanel.llm import decontamination, mixing, near_dedup, sharding, toxicity
from pitpanel.llm.common import read, write_stage

#: The factorization machine of the first stage is trained, so SQL cannot give
#: the rows; tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.clean_documents(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.distinct_documents(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each use of a document by the mix, in training order."""
    return mixing.training_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("source_mixing", mix_sources),
    ("sharding", assign_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return docs
