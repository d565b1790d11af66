"""Newest version per event, and the parsed/feature join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatlens.schemas import SILVER_FEATURES, SILVER_PARSED


def latest_version(df: DataFrame, processed_ts: str, key: str = "event_id") -> DataFrame:
    """Keep the newest write per key: batch time, then batch id, then run id.

    The rank is limited to 1, which Spark applies per input partition before the shuffle;
    a key replayed without end therefore never gathers in one task.
    """
    order = Window.partitionBy(key).orderBy(
        F.coalesce("_batch_processed_ts", processed_ts).desc(),
        F.coalesce("_batch_id", F.lit(-1)).desc(),
        F.coalesce("_run_id", F.lit("")).desc(),
    )
    ranked = df.withColumn("_version", F.row_number().over(order))
    return ranked.filter("_version = 1").drop("_version")


def latest_parsed(parsed: DataFrame) -> DataFrame:
    return latest_version(parsed, "silver_processed_ts").select(*SILVER_PARSED.fieldNames())


def latest_features(features: DataFrame) -> DataFrame:
    return latest_version(features, "feature_processed_ts").select(*SILVER_FEATURES.fieldNames())


def parsed_left_features(parsed: DataFrame, features: DataFrame) -> DataFrame:
    """Newest parsed rows with their newest features; both sides are already placed by key."""
    return latest_parsed(parsed).join(latest_features(features), "event_id", "left")
