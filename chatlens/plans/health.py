"""Pipeline health per run, minute and stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.text import share
from chatlens.schemas import FEATURE_STAGE, PARSE_STAGE

HEALTH_KEY = ["run_id", "event_minute", "pipeline_stage"]

# Count column -> target-table pattern ('_' stays a wildcard).
TARGET_COUNTS = {
    "bronze_row_count": "%bronze_chat_raw",
    "valid_event_count": "%silver_chat_parsed",
    "feature_row_count": "%silver_chat_features",
    "dlq_row_count_from_sink": "%chat_dlq",
}


def _minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).alias("event_minute")


def distinct_batches(metrics: DataFrame) -> DataFrame:
    """One row per written batch, whatever a retried write left behind."""
    return metrics.groupBy("run_id", "job_name", "batch_id", "target_table").agg(
        F.max("batch_processed_ts").alias("batch_processed_ts"),
        F.max_by("row_count", "batch_processed_ts").alias("row_count"),
    )


def ops_metrics_minute(metrics: DataFrame) -> DataFrame:
    rows = F.col("row_count")
    by_target = [
        F.sum(F.when(F.col("target_table").like(pattern), rows).otherwise(0)).alias(name)
        for name, pattern in TARGET_COUNTS.items()
    ]
    return metrics.groupBy(
        "run_id", _minute(F.col("batch_processed_ts")), F.col("job_name").alias("pipeline_stage")
    ).agg(
        F.count(F.lit(1)).alias("batch_count"),
        F.count_if(rows == 0).alias("zero_row_batch_count"),
        F.sum(rows).alias("total_rows_written"),
        F.avg(rows).alias("avg_rows_per_batch"),
        *by_target,
        F.min("batch_processed_ts").alias("first_batch_processed_ts"),
        F.max("batch_processed_ts").alias("last_batch_processed_ts"),
    )


def dlq_minute(dlq: DataFrame, time_column: str = "dlq_ingestion_ts") -> DataFrame:
    """Failures per run, minute and stage. ``_batch_processed_ts`` as time column keeps a
    batch that crosses a minute edge beside its own metrics row."""
    category = F.col("error_category")
    return dlq.groupBy(F.col("_run_id").alias("run_id"), _minute(F.col(time_column)), "pipeline_stage").agg(
        F.count(F.lit(1)).alias("dlq_count"),
        F.count_if("retryable").alias("retryable_dlq_count"),
        F.count_if(category == "PARSE_ERROR").alias("parse_error_count"),
        F.count_if(category == "CONTRACT_ERROR").alias("contract_error_count"),
        F.count_distinct("error_code").alias("distinct_error_code_count"),
    )


def freshness_minute(parsed: DataFrame, features: DataFrame) -> DataFrame:
    """Mean lags per run, minute and stage; each branch fills the measures it knows."""
    nothing = F.lit(None).cast("double")

    def lag(start: str, end: str) -> Column:
        return F.avg(F.unix_timestamp(end) - F.unix_timestamp(start))

    def keys(processed: str, stage: str) -> list[Column]:
        return [
            F.col("_run_id").alias("run_id"),
            _minute(F.coalesce("_batch_processed_ts", processed)),
            F.coalesce("_job_name", F.lit(stage)).alias("pipeline_stage"),
        ]

    timed = parsed.dropna(subset=["event_ts", "bronze_ingestion_ts", "silver_processed_ts"])
    parse_branch = timed.groupBy(*keys("silver_processed_ts", PARSE_STAGE)).agg(
        lag("event_ts", "bronze_ingestion_ts").alias("avg_event_time_to_ingest_lag_seconds"),
        lag("bronze_ingestion_ts", "silver_processed_ts").alias("avg_bronze_to_silver_latency_seconds"),
    )
    measured = features.dropna(subset=["event_to_feature_latency_seconds"])
    feature_branch = measured.groupBy(*keys("feature_processed_ts", FEATURE_STAGE)).agg(
        F.avg("event_to_feature_latency_seconds").alias("avg_event_to_feature_latency_seconds")
    )
    return parse_branch.withColumn("avg_event_to_feature_latency_seconds", nothing).unionByName(
        feature_branch.withColumns(
            {
                "avg_event_time_to_ingest_lag_seconds": nothing,
                "avg_bronze_to_silver_latency_seconds": nothing,
            }
        )
    )


def ops_left_freshness_dlq(ops: DataFrame, freshness: DataFrame, dlq: DataFrame) -> DataFrame:
    """Batch minutes with their freshness and failures. A null run id matches nothing."""
    return ops.join(freshness, HEALTH_KEY, "left").join(dlq, HEALTH_KEY, "left")


def health_minute(ops: DataFrame, freshness: DataFrame, dlq: DataFrame) -> DataFrame:
    """Counts without a partner become 0, freshness stays null; adds the failure rate."""
    joined = ops_left_freshness_dlq(ops, freshness, dlq).withColumnRenamed("event_minute", "minute_ts")
    counts = [
        c
        for c in ops.columns + dlq.columns
        if c not in HEALTH_KEY and not c.endswith("_processed_ts")
    ]
    filled = joined.fillna(0, subset=counts)
    failed, valid = F.col("dlq_count"), F.col("valid_event_count")
    return filled.withColumn("dlq_rate", share(failed, valid + failed))
