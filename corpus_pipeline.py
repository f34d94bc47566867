"""The corpus pipeline: quality rules, near-duplicate removal, decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import divergence, mixing, qgrams, setsketch, sharding
from tidewater.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the distribution rules reject go."""
    return divergence.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: shingles of five words, similarity 0.8 or more."""
    return setsketch.drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return qgrams.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mixture with its shard and slot."""
    return sharding.shard(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixture", mixture), ("shards", shards)]
#: Label propagation is iterative; SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
