"""What keeps the cost of a query in step with its input: rows of its own making, counted passes and files."""

from __future__ import annotations

from datetime import datetime, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from chatlens.catalog import queries as catalog
from chatlens.schemas import BRONZE_RAW
from chatlens.sources import derived, layout
from chatlens.streaming import sinks

KINDS = ("view", "click", "purchase", "error", "signup")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events of a month, some with a document; enough of each kind for every predicate."""
    folder = tmp_path_factory.mktemp("growth")
    start = datetime(2024, 1, 1)
    events = [
        (k, start + timedelta(hours=k * 1.2), k % 7, KINDS[k % 5], float(k * 7 % 240), f"p{k}") for k in range(600)
    ]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    documents = [(k, f"text {k} LUL " + "aaaa bb" * (k % 9)) for k in range(0, 600, 6)]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture
def passes(monkeypatch):
    """How often a query builds the log from the given tables."""
    counted = []
    build = derived.messages
    monkeypatch.setattr(derived, "messages", lambda *args: counted.append(args) or build(*args))
    return counted


@pytest.mark.parametrize(
    "name, most",
    [
        ("engagement_minute_state", 1),
        ("engagement_daily_state", 1),
        ("channel_engagement_daily_refresh", 1),
        ("channel_engagement_minute_refresh", 1),
        ("model_tests", 1),
        ("metric_long_format", 2),
    ],
)
def test_the_log_is_built_once_for_all_branches(spark, tables, passes, name, most):
    rows = catalog.QUERIES[name](spark, tables)
    assert not rows.isEmpty()
    assert len(passes) <= most
    if name not in ("metric_long_format", "model_tests"):
        assert not any("documents.parquet" in f for f in rows.inputFiles())


def test_refresh_equals_the_full_build(spark, tables):
    for grain, full in (("minute", "channel_engagement_minute"), ("daily", "channel_engagement_daily")):
        refreshed = catalog.QUERIES[f"channel_engagement_{grain}_refresh"](spark, tables)
        whole = catalog.QUERIES[full](spark, tables)
        assert refreshed.exceptAll(whole).isEmpty() and whole.exceptAll(refreshed).isEmpty()


def test_log_files_grow_in_number_not_in_size(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "LOG_FILE_BYTES", 1 << 10)
    path, files = catalog._log_files(spark, derived.log_rows(spark, tables), f"{tmp_path}/{uuid4().hex}")
    assert files > catalog.DELIVERY_FILES
    assert {len(list((tmp_path / path.removeprefix(f"{tmp_path}/").removesuffix("/log/*") / "log" / str(k)).glob("*.parquet"))) for k in range(catalog.DELIVERIES)} == {files}
    assert spark.read.parquet(path).count() == derived.log_rows(spark, tables).count()


def test_join_of_events_and_texts_grows_in_number_not_in_size(spark, tables, monkeypatch):
    """The join has the session's number of partitions, or as many as the tables' bytes ask for."""
    whole = derived.messages(spark, tables)
    monkeypatch.setattr(derived, "JOIN_BYTES", 1 << 10, raising=False)
    rows = derived.messages(spark, tables)
    given = layout.stored_bytes(spark, f"{tables}/documents.parquet", f"{tables}/events.parquet")
    parts = -(-given // 1024)
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows.rdd.getNumPartitions() == parts
    assert rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()


def test_buckets_grow_in_number_not_in_size(spark, tables, monkeypatch):
    counts = []
    write = catalog.tables.materialize
    monkeypatch.setattr(catalog.tables, "materialize", lambda *args, **kw: counts.append(kw["buckets"]) or write(*args, **kw))
    monkeypatch.setattr(catalog, "BUCKET_BYTES", 1 << 10, raising=False)
    rows = catalog.QUERIES["materialize_table"](spark, tables)
    given = layout.stored_bytes(spark, f"{tables}/documents.parquet", f"{tables}/events.parquet")
    assert counts == [-(-given // 1024)] * 2 and counts[0] > 8
    whole = catalog.QUERIES["parsed_left_features"](spark, tables)
    assert rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()


def test_a_repeated_batch_is_built_once(spark, tables, passes):
    rows = catalog.QUERIES["idempotent_batch_write"](spark, tables)
    assert len(passes) == 1 and not any("documents.parquet" in f for f in rows.inputFiles())
    assert rows.count() == derived.log_rows(spark, tables).count()


def test_compacted_rows_are_not_shuffled_to_be_read(spark, tables, tmp_path):
    target = f"{tmp_path}/bronze"
    rows = derived.bronze(spark, tables).repartition(3)
    sinks.append_with_batch_metadata(rows, 0, target, "run_a", "bronze_ingest")
    assert sinks.compact_days(spark, target, BRONZE_RAW, catalog.CLOSED)
    sinks.append_with_batch_metadata(rows.filter(F.dayofmonth("kafka_timestamp") < 5), 0, target, "run_a", "bronze_ingest")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = sinks.read_batches(spark, target, BRONZE_RAW)
        plan = read._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("BroadcastHashJoin") and not plan.count("SortMergeJoin")
    assert read.count() == rows.count()
