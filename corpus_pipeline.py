"""Documents to training shards: each stage is written and read again before the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatlens.llm import decontam, mixing, neardup, quality, sharding
from chatlens.llm.staging import scratch, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality.select_kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: four-word shingles, four bits."""
    return neardup.keep_one(docs, size=4, budget=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shard and their slot in it."""
    return sharding.shards_with_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

# Hashes, links and latent vectors are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        with scratch(spark):  # what the stage wrote on its way goes once its output is there
            docs = stage(step(spark, docs, sf_dir), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
