"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chatlens.catalog.queries import QUERIES
from chatlens.functions.message import message_features
from chatlens.operators import parse, versions
from chatlens.plans import engagement, triage
from chatlens.schemas import SILVER_FEATURES, SILVER_PARSED, with_write_metadata
from chatlens.sources import log, tables

# Their result is a plain scan of what the stream or the batch write left.
WRITTEN = {"stream_table_scan", "v1_foreach_batch", "stream_append", "dlq_sink", "idempotent_batch_write", "skip_empty_batch"}
STREAMS = {name for name in QUERIES if name.endswith("_stream") or name in WRITTEN}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_and_no_cross_join(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for banned in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Parsed and feature files as the jobs would leave them, and log files."""
    from chatlens.sources import derived

    root = str(tmp_path_factory.mktemp("silver"))
    sf = "/root/testdata/sf0.001"
    derived.parsed(spark, sf).write.parquet(f"{root}/parsed")
    derived.features(spark, sf).write.parquet(f"{root}/features")
    derived.bronze(spark, sf).write.parquet(f"{root}/bronze")
    derived.dlq(spark, sf).write.parquet(f"{root}/dlq")
    return root


def test_payload_is_parsed_once(spark, silver):
    rows = spark.read.parquet(f"{silver}/bronze")
    good = parse.valid_events(parse.classify(rows))
    assert optimized(good).count("from_json(") == 1
    assert optimized(parse.dead_letters(parse.classify(rows))).count("from_json(") == 1


def test_one_copy_per_key_leaves_each_partition(spark, silver):
    parsed = tables.read_table(spark, f"{silver}/parsed", with_write_metadata(SILVER_PARSED))
    plan = plan_of(versions.latest_parsed(parsed))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_engagement_shuffles_and_columns(spark, silver):
    parsed = tables.read_table(spark, f"{silver}/parsed", with_write_metadata(SILVER_PARSED))
    features = tables.read_table(spark, f"{silver}/features", with_write_metadata(SILVER_FEATURES))
    joined = versions.parsed_left_features(parsed, features)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(engagement.engagement_rollup(joined, "minute"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One per table for version and join, then (interval, channel, chatter) and (interval, channel).
    assert plan.count("Exchange hashpartitioning") == 4
    assert "Expand" not in plan
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and not any("message_text" in line.split("ReadSchema")[1] for line in scans)


def test_features_need_no_shuffle(spark, silver):
    parsed = tables.read_table(spark, f"{silver}/parsed", SILVER_PARSED)
    features = message_features(parsed)
    assert optimized(features).count("regexp_replace(") == 4
    assert optimized(features.select("event_id", "numeric_char_count")).count("regexp_replace(") == 1
    plan = plan_of(features)
    assert "Exchange" not in plan
    read = plan.split("ReadSchema:")[1]
    assert "channel" not in read and "message_text" in read


def test_triage_filters_reach_the_scan(spark, silver):
    from datetime import datetime, timezone

    dlq = spark.read.parquet(f"{silver}/dlq")
    window = triage.in_window(dlq, "dlq_ingestion_ts", datetime(2024, 1, 10, tzinfo=timezone.utc), run_id="run_a")
    plan = plan_of(triage.dlq_triage(window))
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "EqualTo(_run_id,run_a)" in pushed and "GreaterThanOrEqual(dlq_" in pushed
    assert "raw_payload" not in plan.split("ReadSchema:")[1]


def test_capture_is_a_projection(spark, sf):
    from chatlens.schemas import LOG_RECORD

    empty = spark.createDataFrame([], LOG_RECORD)
    assert "Exchange" not in plan_of(log.bronze_projection(empty, F.lit(None).cast("timestamp")))


def test_refresh_reads_only_touched_days(spark, tmp_path):
    from datetime import date

    from chatlens.plans import refresh

    schema = with_write_metadata(SILVER_PARSED)
    row = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema], F.lit(date(2024, 1, 5)).alias("event_date"))
    row.write.partitionBy("event_date").parquet(str(tmp_path / "parsed"))
    table = spark.read.parquet(str(tmp_path / "parsed"))
    features = spark.createDataFrame([], with_write_metadata(SILVER_FEATURES))
    build = lambda joined: engagement.engagement_mart(engagement.engagement_rollup(joined, "day"), "day")
    mart = build(versions.parsed_left_features(table.drop("event_date"), features))
    plan = refresh.refreshed(mart, "date_day", table, features, [date(2024, 1, 5)], build)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
