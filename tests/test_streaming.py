"""Streams over files: several micro-batches, duplicates, late rows, restarts, repeats."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chatlens.functions.message import message_features
from chatlens.operators import parse
from chatlens.plans import health, triage
from chatlens.schemas import (
    BATCH_LEDGER,
    BATCH_METRICS,
    BRONZE_RAW,
    DLQ,
    LOG_RECORD,
    SILVER_FEATURES,
    SILVER_PARSED,
    V1_BRONZE,
    V1_SILVER,
    with_write_metadata,
)
from chatlens.session import checkpoint_root
from chatlens.sources import log, tables
from chatlens.streaming import jobs, ledger, sinks

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def payload(message):
    body = {"source": {"channel": "#a"}, "raw": {"username": "u", "message": message}}
    return json.dumps(body).encode()


def record(offset, hours=0.0, value=None):
    value = payload(f"message {offset}") if value is None else value
    return (b"k", value, "t", 0, offset, T0 + timedelta(hours=hours), 0)


class Lake:
    """Paths of one small installation, and the steps that fill it."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.files = 0

    def path(self, name):
        return f"{self.root}/{name}"

    def deliver(self, *records):
        self.files += 1
        rows = self.spark.createDataFrame(list(records), LOG_RECORD)
        rows.coalesce(1).write.parquet(self.path(f"log/{self.files}"))

    def capture(self):
        stream = log.file_log_stream(self.spark, self.path("log/*"))
        jobs.await_all(
            jobs.kafka_to_bronze_stream(stream, self.path("bronze"), self.path("cp_bronze"), "r1", self.path("metrics"))
        )

    def parse(self, **options):
        bronze = tables.stream_table_scan(self.spark, self.path("bronze"), with_write_metadata(BRONZE_RAW), max_files_per_trigger=1)
        jobs.await_all(
            jobs.bronze_to_silver_stream(
                bronze, self.path("parsed"), self.path("dlq"), self.path("cp_silver"), "r1", self.path("metrics"), **options
            )
        )

    def featurize(self):
        parsed = tables.stream_table_scan(self.spark, self.path("parsed"), with_write_metadata(SILVER_PARSED))
        jobs.await_all(
            jobs.silver_to_features_stream(parsed, self.path("features"), self.path("cp_features"), "r1", self.path("metrics"))
        )

    def table(self, name, schema):
        return tables.read_table(self.spark, self.path(name), with_write_metadata(schema))

    def offsets(self, name="parsed", schema=SILVER_PARSED):
        return sorted(r[0] for r in self.table(name, schema).select("source_offset").collect())

    def metrics(self):
        return tables.read_table(self.spark, self.path("metrics"), BATCH_METRICS)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_capture_parse_features_reconcile(lake, spark):
    lake.deliver(record(1), record(2), record(2), record(3, value=b"broken"))
    lake.capture()
    lake.deliver(record(4, 0.5), record(1), record(5, 0.5, payload(" ")))
    lake.capture()
    lake.parse()
    lake.featurize()

    assert lake.offsets("bronze", BRONZE_RAW) == [1, 1, 2, 2, 3, 4, 5]
    assert lake.offsets() == [1, 2, 4]
    dead = {r["source_offset"]: r["error_code"] for r in lake.table("dlq", DLQ).collect()}
    assert dead == {3: "JSON_PARSE_FAILURE", 5: "CONTRACT_REQUIRED_FIELDS_MISSING"}

    bronze = tables.read_table(spark, lake.path("bronze"), BRONZE_RAW)
    parsed = lake.table("parsed", SILVER_PARSED)
    audit = triage.late_row_audit(parse.classify(bronze), parsed).first().asDict()
    assert audit == {"bronze_rows": 7, "valid_rows": 3, "dlq_rows": 2, "duplicate_rows": 2, "late_rows": 0}
    runs = triage.run_reconciliation(
        lake.table("bronze", BRONZE_RAW), parsed, lake.table("features", SILVER_FEATURES), lake.table("dlq", DLQ)
    ).first()
    assert (runs["unaccounted_rows"], runs["features_match_valid"]) == (0, True)

    batch = parse.dedupe(parse.valid_events(parse.classify(bronze)))
    same = ["event_id", "event_ts", "channel", "chatter_id", "message_text", "message_length"]
    assert sorted(batch.select(*same).collect()) == sorted(parsed.select(*same).collect())
    columns = ["event_id", "token_count", "repeat_char_ratio", "engagement_signal"]
    assert sorted(message_features(batch).select(*columns).collect()) == sorted(
        lake.table("features", SILVER_FEATURES).select(*columns).collect()
    )


def test_zero_row_batches_leave_metrics(lake):
    lake.deliver(record(1))
    lake.capture()
    lake.parse()
    rows = lake.metrics().collect()
    ops = {
        r["pipeline_stage"]: r
        for r in health.ops_metrics_minute(lake.metrics().withColumn("batch_processed_ts", F.lit(T0))).collect()
    }
    assert ops["silver_parse"]["zero_row_batch_count"] >= 1
    assert sum(r["row_count"] for r in rows if r["job_name"] == "silver_parse") == 1


def test_restart_reads_only_new_files(lake):
    lake.deliver(record(1))
    lake.capture()
    lake.parse()
    lake.parse()
    assert lake.offsets() == [1]
    lake.deliver(record(2), record(1))
    lake.capture()
    lake.parse()
    assert lake.offsets() == [1, 2]


class Crash(Exception):
    pass


def test_a_crash_between_the_two_writes_leaves_no_half_batch(lake, spark, monkeypatch):
    lake.deliver(record(1), record(2, value=b"broken"))
    lake.capture()
    lake.parse()
    lake.deliver(record(3), record(4, value=b"broken"), record(1))
    lake.capture()
    plain = ledger.append_with_batch_metadata

    def crash(batch, batch_id, target, *rest, **more):
        if target.endswith("dlq"):
            raise Crash
        return plain(batch, batch_id, target, *rest, **more)

    def shown(name, schema):
        book = tables.read_table(spark, lake.path("cp_silver_ledger"), BATCH_LEDGER)
        return sorted(r[0] for r in ledger.committed(lake.table(name, schema), book).select("source_offset").collect())

    monkeypatch.setattr(ledger, "append_with_batch_metadata", crash)
    with pytest.raises(Exception, match="Crash"):
        lake.parse()
    assert lake.offsets() == [1, 3]
    assert (shown("parsed", SILVER_PARSED), shown("dlq", DLQ)) == ([1], [2])
    monkeypatch.undo()
    lake.parse()
    assert lake.offsets() == [1, 3] and lake.offsets("dlq", DLQ) == [2, 4]
    assert (shown("parsed", SILVER_PARSED), shown("dlq", DLQ)) == ([1, 3], [2, 4])


def test_both_targets_come_from_one_scan(lake, spark):
    """Raw rows are scanned and parsed once a batch, whatever the two writes read."""
    lake.deliver(record(1), record(2, value=b"broken"))
    lake.capture()
    bronze = tables.stream_table_scan(spark, lake.path("bronze"), with_write_metadata(BRONZE_RAW))
    query = jobs.bronze_to_silver_stream(bronze, lake.path("parsed"), lake.path("dlq"), lake.path("cp"), "r1")
    jobs.await_all(query)
    plan = query._jsq.explainInternal(True)
    logical = plan[plan.index("== Optimized Logical Plan ==") : plan.index("== Physical Plan ==")]
    assert logical.count("from_json") == 1
    assert sum(source.numInputRows for report in query.recentProgress for source in report.sources) == 2


def test_progress_and_state_tell_what_became_of_rows(lake, spark):
    """Rows dropped as late and as copies, and the keys still remembered, over a restart."""
    with jobs.state_settings(spark, 2):
        for rows in ([record(1), record(1)], [record(2, 24), record(3, 24, b"broken")], [record(4, 1), record(2, 24), record(5, 23.5)]):
            lake.deliver(*rows)
            lake.capture()
            bronze = tables.stream_table_scan(spark, lake.path("bronze"), with_write_metadata(BRONZE_RAW))
            query = jobs.bronze_to_silver_stream(bronze, lake.path("parsed"), lake.path("dlq"), lake.path("cp_silver"), "r1")
            jobs.await_all(query)
            ledger.record_progress(query, lake.path("progress"), "r1", "silver_parse")
    told = ledger.progress(spark, lake.path("progress"))
    assert lake.offsets() == [1, 2, 5] and lake.offsets("dlq", DLQ) == [3]
    assert told.agg(F.sum("input_rows"), F.sum("late_rows"), F.sum("duplicate_rows")).first()[:] == (7, 1, 2)
    keys = ledger.remembered_keys(spark, lake.path("cp_silver"))
    assert sorted(r["event_id"] for r in keys.collect()) == ["t:0:2", "t:0:5"]
    audit = triage.stream_audit(
        parse.classify(tables.read_table(spark, lake.path("bronze"), BRONZE_RAW)),
        lake.table("parsed", SILVER_PARSED), lake.table("dlq", DLQ), told, keys,
    ).first()
    assert audit.asDict() == {
        "bronze_rows": 7, "valid_rows": 3, "dlq_rows": 1, "duplicate_rows": 2, "late_rows": 1, "unaccounted_rows": 0,
        "lost_events": 1, "remembered_keys": 2, "expired_keys": 0, "final_watermark_ts": datetime(2024, 1, 1, 22),
    }
    changelogs = [f for f in (lake_files(lake.path("cp_silver"))) if f.endswith(".changelog")]
    assert changelogs


def lake_files(root):
    import os

    return [f"{d}/{f}" for d, _, files in os.walk(root) for f in files]


def spread(lake, mode):
    """Three batches: a day-old watermark, then a late new key and a copy of the first key."""
    for rows in ([record(1)], [record(2, 24)], [record(3, 48)]):
        lake.deliver(*rows)
        lake.capture()
        lake.parse(dedupe_mode=mode)
    lake.deliver(record(9, 1), record(1, 48))
    lake.capture()
    lake.parse(dedupe_mode=mode)
    return lake.offsets()


def test_late_keys_drop_and_old_copies_return_within_watermark(lake):
    assert spread(lake, "within_watermark") == [1, 1, 2, 3]


def test_unbounded_dedupe_remembers_old_keys(lake):
    assert spread(lake, "unbounded") == [1, 2, 3]


def test_repeated_batch_replaces_itself(spark, lake):
    df = spark.range(5).select(F.col("id"))
    for _ in range(2):
        rows = sinks.append_with_batch_metadata(df, 7, lake.path("t"), "r1", "job", lake.path("m"))
        assert rows == 5
    sinks.append_with_batch_metadata(df, 8, lake.path("t"), "r1", "job", lake.path("m"))
    assert spark.read.parquet(lake.path("t")).count() == 10
    written = tables.read_table(spark, lake.path("m"), BATCH_METRICS)
    assert written.count() == health.distinct_batches(written).count() == 2


def test_empty_batches(spark, lake):
    empty = spark.range(0)
    assert sinks.append_with_batch_metadata(empty, 0, lake.path("t"), "r1", "job", lake.path("m")) == 0
    assert sinks.append_with_batch_metadata(empty, 1, lake.path("t"), "r1", "job", lake.path("m"), skip_empty=True) == 0
    rows = tables.read_table(spark, lake.path("m"), BATCH_METRICS).collect()
    assert [(r["batch_id"], r["row_count"]) for r in rows] == [(0, 0)]


def test_state_settings_hold_for_queries_started_inside(spark, lake):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    lake.deliver(record(1), record(1))
    lake.capture()
    with jobs.state_settings(spark, 3):
        lake.parse()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    offsets = spark.read.text(lake.path("cp_silver/offsets/0")).collect()
    assert any('"spark.sql.shuffle.partitions":"3"' in r[0] and "RocksDB" in r[0] for r in offsets)
    lake.deliver(record(1), record(2))
    lake.capture()
    lake.parse()
    assert lake.offsets() == [1, 2]


def test_dlq_sink_without_run_id_is_native(spark, lake):
    lake.deliver(record(1, value=b"broken"), record(2))
    stream = log.bronze_projection(log.file_log_stream(spark, lake.path("log/*")))
    dead = parse.dead_letters(parse.classify(stream))
    jobs.await_all(sinks.dlq_sink(dead, lake.path("dlq"), lake.path("cp"), available_now=True))
    assert spark.read.parquet(lake.path("dlq")).columns == DLQ.fieldNames()


def v1_payload(message):
    return json.dumps({"user": "u", "message": message, "sentiment": {"compound": 0.5}}).encode()


def test_v1_batch_is_idempotent_and_sets_status(spark, lake):
    write = jobs.v1_batch(lake.path("raw"), lake.path("silver"))

    def frame(*rows):
        return spark.createDataFrame(list(rows), LOG_RECORD)

    first = frame(record(1, value=v1_payload("LUL")), record(1, value=v1_payload("LUL")), record(2, value=b"broken"))
    second = frame(record(1, value=v1_payload("LUL")), record(3, 30, v1_payload("hello there")))
    for batch, batch_id in ((first, 0), (first, 0), (second, 1), (frame(), 2), (second, 1)):
        write(batch, batch_id)
    raw = tables.read_table(spark, lake.path("raw"), V1_BRONZE).orderBy("offset").collect()
    assert [(r["offset"], r["parse_status"], r["parse_error"]) for r in raw] == [
        (1, "OK", None),
        (2, "PARSE_ERROR", "PARSE_ERROR"),
        (3, "OK", None),
    ]
    silver = tables.read_table(spark, lake.path("silver"), V1_SILVER).orderBy("offset").collect()
    assert [(r["offset"], r["is_emote_only"], r["emote_count"]) for r in silver] == [(1, True, 1), (3, False, 0)]


def test_v1_status_of_mixed_and_redelivered_keys(spark, lake):
    """Errors have the last word in a batch, later batches over earlier ones; keys match in full."""
    write = jobs.v1_batch(lake.path("raw"), lake.path("silver"))

    def frame(*rows):
        return spark.createDataFrame(list(rows), LOG_RECORD)

    good, bad = v1_payload("LUL"), b"broken"
    late = (*record(3, value=good)[:5], T0 + timedelta(days=3), *record(3, value=good)[6:])
    undated = (*record(4, value=good)[:5], None, *record(4, value=good)[6:])
    write(frame(record(1, value=good), record(1, value=bad), record(2, value=bad), record(3, value=good), record(4, value=good)), 0)
    write(frame(record(2, value=good), late, undated), 1)
    write(frame(undated), 2)
    raw = jobs.v1_bronze(spark, lake.path("raw")).orderBy("offset").collect()
    assert [(r["offset"], r["parse_status"]) for r in raw] == [(1, "PARSE_ERROR"), (2, "OK"), (3, "OK"), (4, "OK")]
    silver = tables.read_table(spark, lake.path("silver"), V1_SILVER).orderBy("offset").collect()
    assert [r["offset"] for r in silver] == [1, 2, 3, 4]


def _none_cached(monkeypatch, df):
    def refuse(*_):
        raise AssertionError("a micro-batch of whole texts is held by executors")

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(df), name, refuse)


def _stored(spark):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in files.listStatus(root) if x.getPath().getName().startswith("batch-")] if files.exists(root) else []


def test_v1_batch_is_stored_and_not_cached(spark, lake, monkeypatch):
    before = _stored(spark)
    rows = spark.createDataFrame([record(1, value=v1_payload("LUL")), record(2, value=b"broken")], LOG_RECORD)
    _none_cached(monkeypatch, rows)
    jobs.v1_batch(lake.path("raw"), lake.path("silver"))(rows, 0)
    assert tables.read_table(spark, lake.path("raw"), V1_BRONZE).count() == 2
    assert [r["message"] for r in tables.read_table(spark, lake.path("silver"), V1_SILVER).collect()] == ["LUL"]
    assert _stored(spark) == before


def test_routed_batch_is_stored_once_and_not_cached(spark, lake, monkeypatch):
    """Both targets read the same stored rows, which are dropped after them, also where a write breaks."""
    before = _stored(spark)
    raw = log.bronze_projection(spark.createDataFrame([record(1), record(2, value=b"broken")], LOG_RECORD), F.col("timestamp"))
    rows = parse.classify(raw, F.col("bronze_ingestion_ts"))
    _none_cached(monkeypatch, rows)
    ledger.routed_batch(lake.path("parsed"), lake.path("dlq"), lake.path("ledger"), "r1")(rows, 0)
    entry = spark.read.parquet(lake.path("ledger")).first()
    assert (entry["parsed_rows"], entry["dlq_rows"]) == (1, 1) and _stored(spark) == before
    with pytest.raises(ZeroDivisionError), sinks.stored_batch(rows) as kept:
        assert len(set(_stored(spark)) - set(before)) == 1 and kept.schema.fieldNames() == rows.schema.fieldNames()
        raise ZeroDivisionError
    assert _stored(spark) == before


def test_v1_batch_parses_each_payload_once(spark):
    from chatlens.operators.v1 import v1_parsed_raw

    rows = v1_parsed_raw(spark.createDataFrame([record(1, value=v1_payload("LUL"))], LOG_RECORD))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_repeated_batch_in_a_catalog_table(spark):
    name = "repeated_batch_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.range(5).select(F.col("id").cast("string").alias("raw_key"), "id")
    try:
        for batch_id in (6, 7, 7):
            sinks.append_with_batch_metadata(rows, batch_id, name, "run_a", "bronze_ingest")
        counts = {r["_batch_id"]: r["count"] for r in spark.table(name).groupBy("_batch_id").count().collect()}
        assert counts == {6: 5, 7: 5}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_replay_wins_downstream(spark):
    from chatlens.operators.versions import latest_parsed

    rows = [("t", 0, i, T0 + timedelta(hours=i), 0, "k", payload(f"m{i}").decode(), T0) for i in range(4)]
    bronze = spark.createDataFrame(rows, BRONZE_RAW)
    base, _ = jobs.replay(bronze, "run_a", processed_ts=F.lit(T0))
    scope = jobs.replay_scope(bronze, T0 + timedelta(hours=1), T0 + timedelta(hours=3))
    again, dead = jobs.replay(scope, "run_b", processed_ts=F.lit(T0 + timedelta(days=1)))
    assert (again.count(), dead.count()) == (2, 0)
    assert jobs.replay_scope(bronze, topic="t", partition=0, offsets=(0, 2)).count() == 3
    assert latest_parsed(base.unionByName(again)).count() == 4


def test_jobs_expose_entry_points():
    for name in ("kafka_to_bronze_stream", "bronze_to_silver_stream", "silver_to_features_stream", "v1_foreach_batch"):
        assert callable(getattr(jobs, name))
    assert callable(sinks.dlq_sink)
