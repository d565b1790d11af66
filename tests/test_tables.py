"""Versions, merges, checks and the health join on small literal tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chatlens.operators import checks, merge, versions
from chatlens.plans import health, triage
from chatlens.schemas import BATCH_METRICS, CONTRACT_RULES, V1_BRONZE
from chatlens.session import checkpoint_root, cut_lineage
from chatlens.sources import log, tables

KEY = ("topic", "partition", "offset")


def at(second: int, minute: int = 0) -> datetime:
    return datetime(2024, 1, 1, 0, minute, second)


def test_latest_version_order(spark):
    rows = [
        ("a", at(1), at(5), 1, "r1", "old"),
        ("a", at(9), at(6), 0, "r1", "newest batch time"),
        ("b", at(3), None, 1, "r1", "tie, lower batch"),
        ("b", at(3), None, 2, None, "tie, higher batch"),
        ("c", at(3), at(3), None, "r1", "lower run"),
        ("c", at(3), at(3), None, "r2", "higher run"),
    ]
    schema = "event_id string, processed timestamp, _batch_processed_ts timestamp, _batch_id bigint, _run_id string, what string"
    got = versions.latest_version(spark.createDataFrame(rows, schema), "processed").collect()
    assert {r["event_id"]: r["what"] for r in got} == {
        "a": "newest batch time",
        "b": "tie, higher batch",
        "c": "higher run",
    }


def v1_rows(spark, *rows):
    full = [(p, at(0), "t", 0, o, at(i), s, None) for i, (p, o, s) in enumerate(rows)]
    return spark.createDataFrame(full, V1_BRONZE)


def test_insert_only_merge_dedupes_inside_the_batch(spark):
    target = v1_rows(spark, ("kept", 1, "OK"))
    batch = v1_rows(spark, ("ignored", 1, None), ("first", 2, None), ("second", 2, None))
    got = merge.merge_insert_new(target, batch, KEY, ["ingest_ts"]).collect()
    assert {(r["offset"], r["json_payload"]) for r in got} == {(1, "kept"), (2, "first")}


def test_status_update_takes_nulls_from_matches_only(spark):
    target = v1_rows(spark, ("x", 1, "OLD"), ("y", 2, "OLD"))
    updates = spark.createDataFrame([("t", 0, 1, "OK", None)], "topic string, partition int, offset bigint, parse_status string, parse_error string")
    got = {r["offset"]: r["parse_status"] for r in merge.merge_update_status(target, updates, KEY).collect()}
    assert got == {1: "OK", 2: "OLD"}
    nulls = updates.withColumn("parse_status", F.lit(None).cast("string"))
    got = {r["offset"]: r["parse_status"] for r in merge.merge_update_status(target, nulls, KEY).collect()}
    assert got == {1: None, 2: "OLD"}


def test_merge_statement():
    text = merge.merge_insert_sql("t1", "v1", KEY)
    assert "t.topic = s.topic AND t.partition = s.partition AND t.offset = s.offset" in text


def metrics(spark, *rows):
    return spark.createDataFrame(rows, BATCH_METRICS)


def test_health_join_misses_failures_across_a_minute_edge(spark):
    m = metrics(
        spark,
        ("r", "silver_parse", 0, at(1, 1), 9, "x.silver_chat_parsed"),
        ("r", "silver_parse", 0, at(1, 1), 0, "x.chat_dlq"),
    )
    dlq = spark.createDataFrame(
        [("r", at(59), "silver_parse", "PARSE_ERROR", "J", True, at(1, 1))],
        "_run_id string, dlq_ingestion_ts timestamp, pipeline_stage string, error_category string, error_code string, retryable boolean, _batch_processed_ts timestamp",
    )
    fresh = spark.createDataFrame(
        [], "run_id string, event_minute timestamp, pipeline_stage string, avg_event_time_to_ingest_lag_seconds double"
    )
    ops = health.ops_metrics_minute(m)
    by_ingestion = health.health_minute(ops, fresh, health.dlq_minute(dlq)).first()
    assert (by_ingestion["dlq_count"], by_ingestion["zero_row_batch_count"], by_ingestion["dlq_rate"]) == (0, 1, 0.0)
    by_batch = health.health_minute(ops, fresh, health.dlq_minute(dlq, "_batch_processed_ts")).first()
    assert (by_batch["dlq_count"], by_batch["dlq_rate"]) == (1, pytest.approx(0.1))


def test_null_run_never_matches_and_empty_rate_is_null(spark):
    ops = health.ops_metrics_minute(metrics(spark, ("r", "bronze_ingest", 0, at(0), 3, "x.bronze_chat_raw")))
    fresh = spark.createDataFrame(
        [(None, at(0), "bronze_ingest", 1.0)],
        "run_id string, event_minute timestamp, pipeline_stage string, avg_event_time_to_ingest_lag_seconds double",
    )
    dlq = spark.createDataFrame([], "run_id string, event_minute timestamp, pipeline_stage string, dlq_count bigint")
    row = health.health_minute(ops.withColumn("run_id", F.lit(None).cast("string")), fresh, dlq).first()
    assert row["avg_event_time_to_ingest_lag_seconds"] is None and row["dlq_rate"] is None


def test_repeated_metrics_rows_collapse(spark):
    row = ("r", "j", 1, at(0), 5, "t")
    again = ("r", "j", 1, at(9), 6, "t")
    got = health.distinct_batches(metrics(spark, row, again, row)).collect()
    assert [(r["row_count"], r["batch_processed_ts"]) for r in got] == [(6, at(9))]


def test_contract_rules_count_unknown_as_violated(spark):
    df = spark.createDataFrame([("c", "u", "m", None), (None, "u", "m", 1)], "channel string, chatter_id string, message_text string, message_length int")
    got = {r["rule"]: r["violations"] for r in checks.contract_check(df, "silver_chat_parsed").collect()}
    assert got == {"required_fields_present": 1, "message_length_positive": 1}
    assert set(CONTRACT_RULES) == {"silver_chat_parsed", "chat_dlq", "streaming_batch_metrics"}


def test_unique_ignores_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert tuple(checks.check_unique(df, "k").first()) == (2, 1, 1)


def test_staging_scan_rejects_other_types(spark):
    df = spark.createDataFrame([("r",)], "run_id string")
    with pytest.raises(ValueError, match="job_name: expected string, found nothing"):
        tables.staging_scan(df, BATCH_METRICS)


def test_batch_shape_equals_its_approximation_on_small_groups(spark):
    m = metrics(spark, *[("r", "j", i, at(0), i, "t") for i in range(1, 102)])
    exact = triage.batch_shape(m).first()
    assert (exact["p50"], exact["p95"], exact["avg_rows"], exact["batch_count"]) == (51.0, 96.0, 51.0, 101)
    assert triage.batch_shape(m, approximate=True).first()["p50"] == 51.0


def test_source_options():
    plain = log.kafka_source_options("h:1", "t", security_protocol="PLAINTEXT")
    assert plain == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"}
    secured = log.kafka_source_options("h:1", "t", user="u", password='p"\\')
    assert secured["kafka.sasl.mechanism"] == "PLAIN"
    assert secured["kafka.sasl.jaas.config"].startswith("org.apache.kafka.common.security.plain.PlainLoginModule required ")
    assert secured["kafka.sasl.jaas.config"].endswith('required username="u" password="p\\"\\\\";')
    with pytest.raises(ValueError):
        log.kafka_source_options("h:1", "t")


def test_cut_lineage_uses_the_named_folder(spark):
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 90
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_root(spark) == (named or checkpoint_root(spark))
    assert named or checkpoint_root(spark).endswith("/_checkpoints")


def test_materialized_buckets_join_without_a_shuffle(spark):
    name = "bucketed_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("event_id"), "id")
    table = tables.materialize(rows, name, bucket_by=["event_id"], buckets=4)
    plan = table.hint("merge").join(table.withColumnRenamed("id", "other"), "event_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")
    assert "Exchange hashpartitioning" not in text
