"""Operational analyses over the dead-letter and batch-metrics tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.text import share
from chatlens.operators.observe import VOLUME_TOLERANCE, is_spike_or_drop, seconds_between
from chatlens.operators.parse import VALID
from chatlens.plans.health import TARGET_COUNTS
from chatlens.schemas import BRONZE_STAGE, FEATURE_STAGE, PARSE_STAGE

STAGES = (BRONZE_STAGE, PARSE_STAGE, FEATURE_STAGE)


def in_window(
    df: DataFrame,
    time_column: str,
    start: datetime | None = None,
    end: datetime | None = None,
    run_id: str | None = None,
    run_column: str = "_run_id",
) -> DataFrame:
    """Limit to a run and a half-open time window; both reach the scan as filters."""
    if run_id is not None:
        df = df.filter(F.col(run_column) == run_id)
    if start is not None:
        df = df.filter(F.col(time_column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(time_column) < F.lit(end))
    return df


def dlq_triage(dlq: DataFrame) -> DataFrame:
    """Failures by run, category and code."""
    return dlq.groupBy(F.col("_run_id").alias("run_id"), "error_category", "error_code").agg(
        F.count(F.lit(1)).alias("dlq_count"),
        F.count_if("retryable").alias("retryable_count"),
        F.min("dlq_ingestion_ts").alias("first_seen_ts"),
        F.max("dlq_ingestion_ts").alias("last_seen_ts"),
    )


def dlq_hotspots(dlq: DataFrame) -> DataFrame:
    """Failures by topic and partition, their offset range, and their share of the run.

    Repeated offsets point to a replay loop. Offsets are counted in a first aggregation, so
    a partition with a third of all failures is spread over its offsets.
    """
    place = ["run_id", "source_topic", "source_partition"]
    by_offset = dlq.groupBy(F.col("_run_id").alias("run_id"), *place[1:], "source_offset").agg(
        F.count(F.lit(1)).alias("n")
    )
    by_place = by_offset.groupBy(*place).agg(
        F.sum("n").alias("dlq_count"),
        F.count("source_offset").alias("distinct_offsets"),
        F.min("source_offset").alias("first_offset"),
        F.max("source_offset").alias("last_offset"),
    )
    totals = by_place.groupBy("run_id").agg(F.sum("dlq_count").alias("_total"))
    return (
        by_place.join(totals, "run_id")
        .withColumn("share_of_run", share(F.col("dlq_count"), F.col("_total")))
        .drop("_total")
    )


def dlq_vs_batches(dlq: DataFrame, metrics: DataFrame) -> DataFrame:
    """Failures in the table beside the row count its sink reported, per run and batch."""
    counted = dlq.groupBy(F.col("_run_id").alias("run_id"), F.col("_batch_id").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("dlq_count")
    )
    sink = F.col("target_table").like(TARGET_COUNTS["dlq_row_count_from_sink"])
    valid = F.col("target_table").like(TARGET_COUNTS["valid_event_count"])
    reported = metrics.filter(sink | valid).groupBy("run_id", "batch_id").agg(
        F.sum(F.when(sink, F.col("row_count")).otherwise(0)).alias("reported_dlq_rows"),
        F.sum(F.when(valid, F.col("row_count")).otherwise(0)).alias("reported_valid_rows"),
    )
    both = reported.join(counted, ["run_id", "batch_id"], "full").fillna(
        0, subset=["dlq_count", "reported_dlq_rows", "reported_valid_rows"]
    )
    return both.withColumn("unexplained_rows", F.col("dlq_count") - F.col("reported_dlq_rows"))


def latest_batch_by_job(metrics: DataFrame, as_of: Column, stale_after_seconds: float = 3600.0) -> DataFrame:
    """Newest batch of each run and job, its age, and whether the job is stale."""
    newest = metrics.groupBy("run_id", "job_name").agg(
        F.max("batch_processed_ts").alias("last_batch_processed_ts"),
        F.max_by("batch_id", F.struct("batch_processed_ts", "batch_id")).alias("last_batch_id"),
    )
    age = seconds_between(F.col("last_batch_processed_ts"), as_of)
    return newest.withColumns({"age_seconds": age, "is_stale": age > stale_after_seconds})


def row_count_by_job(metrics: DataFrame, tolerance: float = VOLUME_TOLERANCE) -> DataFrame:
    """Rows per stage side by side, and the first stage whose volume leaves its input's.

    Parsing is held against raw rows, features against parsed rows.
    """
    wide = metrics.groupBy("run_id").agg(
        *[
            F.sum(F.when(F.col("target_table").like(pattern), F.col("row_count")).otherwise(0)).alias(name)
            for name, pattern in TARGET_COUNTS.items()
        ]
    )
    parse_off = is_spike_or_drop(F.col("bronze_row_count"), F.col("valid_event_count"), tolerance)
    feature_off = is_spike_or_drop(F.col("valid_event_count"), F.col("feature_row_count"), tolerance)
    start = F.when(parse_off, PARSE_STAGE).when(feature_off, FEATURE_STAGE).otherwise("none")
    return wide.withColumn("anomaly_start_stage", start)


def batch_shape(metrics: DataFrame, approximate: bool = False) -> DataFrame:
    """Distribution of batch sizes per run, job and target.

    Equal sizes are counted first; the exact percentile then keeps one counter per distinct
    size, which a batch-size limit bounds. ``approximate`` bounds it without such a limit.
    """
    place = ["run_id", "job_name", "target_table"]
    sizes = metrics.groupBy(*place, "row_count").agg(F.count(F.lit(1)).alias("n"))
    rows, n = F.col("row_count"), F.col("n")
    if approximate:
        spread = metrics.groupBy(*place).agg(
            *[F.percentile_approx("row_count", p).cast("double").alias(name) for name, p in (("p50", 0.5), ("p95", 0.95))]
        )
    else:
        spread = sizes.groupBy(*place).agg(
            F.percentile(rows, 0.5, n).alias("p50"), F.percentile(rows, 0.95, n).alias("p95")
        )
    totals = sizes.groupBy(*place).agg(
        F.sum("n").alias("batch_count"),
        F.min(rows).alias("min_rows"),
        F.max(rows).alias("max_rows"),
        (F.sum(rows * n) / F.sum("n")).alias("avg_rows"),
    )
    return totals.join(spread, place)


def run_summary(metrics: DataFrame) -> DataFrame:
    """Volumes, failure rate and batch shape of each run."""
    volumes = [
        F.sum(F.when(F.col("target_table").like(pattern), F.col("row_count")).otherwise(0)).alias(name)
        for name, pattern in TARGET_COUNTS.items()
    ]
    summary = metrics.groupBy("run_id").agg(
        *volumes,
        F.count(F.lit(1)).alias("batch_count"),
        F.avg("row_count").alias("avg_rows_per_batch"),
        F.max("row_count").alias("max_rows_per_batch"),
    )
    failed, valid = F.col("dlq_row_count_from_sink"), F.col("valid_event_count")
    return summary.withColumn("dlq_rate", share(failed, valid + failed))


def run_comparison(metrics: DataFrame, runs: Sequence[str]) -> DataFrame:
    """One row per measure, one column per run."""
    summary = run_summary(metrics.filter(F.col("run_id").isin(*runs)))
    measures = [c for c in summary.columns if c != "run_id"]
    long = summary.select("run_id", *[F.col(c).cast("double") for c in measures]).unpivot(
        "run_id", measures, "measure", "value"
    )
    return long.groupBy("measure").pivot("run_id", list(runs)).agg(F.first("value"))


def late_row_audit(classified: DataFrame, parsed: DataFrame) -> DataFrame:
    """What became of every raw row: valid, dlq, duplicate or late (dropped by the watermark).

    Copies are counted per event first; each event then meets at most one parsed key.
    """
    good = F.col("outcome") == VALID
    per_event = classified.groupBy("event_id").agg(
        F.count_if(good).alias("copies"), F.count_if(~good).alias("dlq_rows")
    )
    kept = parsed.select("event_id").distinct().withColumn("_kept", F.lit(True))
    fate = per_event.join(kept, "event_id", "left")
    found = F.col("_kept").isNotNull() & (F.col("copies") > 0)
    return fate.agg(
        F.sum(F.col("copies") + F.col("dlq_rows")).alias("bronze_rows"),
        F.count_if(found).alias("valid_rows"),
        F.sum("dlq_rows").alias("dlq_rows"),
        F.sum(F.when(found, F.col("copies") - 1).otherwise(0)).alias("duplicate_rows"),
        F.sum(F.when(~found, F.col("copies")).otherwise(0)).alias("late_rows"),
    )


def stream_audit(classified: DataFrame, parsed: DataFrame, dlq: DataFrame, progress: DataFrame, keys: DataFrame) -> DataFrame:
    """One row that squares raw rows with what the stream wrote, dropped and still remembers.

    ``progress`` has the stream's own counts of late rows and copies, ``keys`` its dedupe state. The
    last two checks don't rely on them: events with valid raw rows but no parsed row, and remembered
    keys that the last watermark should have removed.
    """
    rows = F.count(F.lit(1))
    reached = progress.agg(F.max("watermark_ts")).scalar()
    valid = classified.filter(F.col("outcome") == VALID).select("event_id").distinct()
    parts = [
        classified.agg(rows.alias("bronze_rows")),
        parsed.agg(rows.alias("valid_rows")),
        dlq.agg(rows.alias("dlq_rows")),
        progress.agg(
            F.sum("duplicate_rows").alias("duplicate_rows"),
            F.sum("late_rows").alias("late_rows"),
            F.max("watermark_ts").alias("final_watermark_ts"),
        ),
        valid.join(parsed.select("event_id").distinct(), "event_id", "left_anti").agg(rows.alias("lost_events")),
        keys.agg(rows.alias("remembered_keys"), F.count_if(F.col("expires_ts") <= reached).alias("expired_keys")),
    ]
    told = parts[0]
    for part in parts[1:]:
        told = told.unionByName(part, allowMissingColumns=True)
    counts = ("bronze_rows", "valid_rows", "dlq_rows", "duplicate_rows", "late_rows")
    more = ("lost_events", "remembered_keys", "expired_keys")
    result = told.agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in (*counts, *more)], F.max("final_watermark_ts").alias("final_watermark_ts")
    )
    accounted = F.col("valid_rows") + F.col("dlq_rows") + F.col("duplicate_rows") + F.col("late_rows")
    unaccounted = (F.col("bronze_rows") - accounted).alias("unaccounted_rows")
    return result.select(*counts, unaccounted, *more, "final_watermark_ts")


def run_reconciliation(
    bronze: DataFrame, parsed: DataFrame, features: DataFrame, dlq: DataFrame
) -> DataFrame:
    """Raw = valid + dead-letter + repeated copies, and features = valid, per run.

    Raw copies count once per log position. Each table is reduced to per-run counts first.
    """
    raw = (
        bronze.groupBy("_run_id", "source_topic", "source_partition", "source_offset")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("_run_id")
        .agg(F.sum("n").alias("bronze_rows"), F.sum(F.col("n") - 1).alias("repeated_rows"))
    )
    counts = raw
    for name, table in (("valid_rows", parsed), ("feature_rows", features), ("dlq_rows", dlq)):
        counted = table.groupBy("_run_id").agg(F.count(F.lit(1)).alias(name))
        counts = counts.unionByName(counted, allowMissingColumns=True)
    measures = [c for c in counts.columns if c != "_run_id"]
    result = counts.groupBy(F.col("_run_id").alias("run_id")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in measures]
    )
    accounted = F.col("valid_rows") + F.col("dlq_rows") + F.col("repeated_rows")
    return result.withColumns(
        {
            "unaccounted_rows": F.col("bronze_rows") - accounted,
            "features_match_valid": F.col("feature_rows") == F.col("valid_rows"),
        }
    )


def cost_per_million(summary: DataFrame, costs: DataFrame) -> DataFrame:
    """Unit cost of each run beside its failure rate; ``costs`` has run_id, total_cost_usd."""
    return summary.join(costs, "run_id").select(
        "run_id",
        "total_cost_usd",
        "bronze_row_count",
        (share(F.col("total_cost_usd"), F.col("bronze_row_count")) * 1e6).alias("cost_per_million_messages_usd"),
        "dlq_rate",
    )


# Published metric names.
METRIC_NAMES = {
    "ingest_lag": "stream_event_time_to_ingest_lag_seconds",
    "silver_latency": "stream_bronze_to_silver_latency_seconds",
    "records": "stream_records_per_micro_batch",
    "delta": "stream_expected_vs_actual_delta",
    "dlq": "stream_dlq_records_total",
    "drift": "stream_schema_drift_events_total",
    "uptime": "pipeline_uptime_proxy_percent",
}


def _samples(df: DataFrame, metric: str, label: str, value: str) -> DataFrame:
    return df.select(
        F.lit(METRIC_NAMES[metric]).alias("metric"),
        "run_id",
        F.col(label).cast("string").alias("label"),
        F.col(value).cast("double").alias("value"),
    )


def metric_long_format(
    freshness: DataFrame,
    volumes: DataFrame,
    failures: DataFrame,
    drift: DataFrame,
    uptime: DataFrame,
) -> DataFrame:
    """Named samples (metric, run_id, label, value) from the aggregated observability tables.

    ``freshness``: run_id, avg lag and latency; ``volumes``: per run and job mean records and
    delta; ``failures``: dlq_triage; ``drift``: records per field; ``uptime``: per run.
    """
    stages = freshness.withColumns({"_raw": F.lit("bronze"), "_silver": F.lit("silver"), "_all": F.lit("all")})
    parts = [
        _samples(stages, "ingest_lag", "_raw", "avg_event_to_ingest_lag_seconds"),
        _samples(stages, "silver_latency", "_silver", "avg_bronze_to_silver_lag_seconds"),
        _samples(volumes, "records", "job_name", "avg_records"),
        _samples(volumes, "delta", "job_name", "total_delta"),
        _samples(failures, "dlq", "error_code", "dlq_count"),
        _samples(drift.withColumn("run_id", F.lit("all")), "drift", "label", "records"),
        _samples(uptime.withColumn("_all", F.lit("all")), "uptime", "_all", "uptime_proxy_pct"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
