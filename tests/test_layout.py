"""Layout by event day or log segment: compaction, repeats, pruning, schema evolution."""

from __future__ import annotations

import json
import os
import re
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chatlens.schemas import BRONZE_RAW, LOG_RECORD
from chatlens.sources import evolution, layout, manifest
from chatlens.streaming import jobs, sinks

T0 = datetime(2024, 1, 1, 6, tzinfo=timezone.utc)


def raw(spark, *places):
    rows = [("t", 0, offset, T0 + timedelta(days=day), 0, "k", f"{note}{offset}", T0) for day, offset, note in places]
    return spark.createDataFrame(rows, BRONZE_RAW)


def files(path):
    return [f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


@pytest.fixture
def table(spark, tmp_path):
    """Six batches over three days, each day of each batch in a partition of its own."""
    path = f"{tmp_path}/bronze"
    for batch_id in range(6):
        rows = raw(spark, *[(day, 10 * batch_id + day, "a") for day in range(3)])
        sinks.append_with_batch_metadata(rows, batch_id, path, "r1", "capture")
    return path


def content(spark, table):
    rows = sinks.read_batches(spark, table, BRONZE_RAW)
    return sorted((r["source_offset"], r["raw_payload"], r["_batch_id"], str(r["event_date"])) for r in rows.collect())


def test_compaction_keeps_rows_and_saves_files(spark, table):
    before = content(spark, table)
    assert len(before) == 18 and len(files(table)) >= 18
    assert sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    assert content(spark, table) == before
    assert len(files(f"{table}_compacted")) <= 3 and all("event_date=2024-01-03" in f for f in files(table))
    assert sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 3)) == []


def test_repeats_still_replace_and_are_compacted_again(spark, table):
    sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 3))
    sinks.append_with_batch_metadata(raw(spark, (0, 20, "b"), (0, 29, "b")), 2, table, "r1", "capture")
    after = content(spark, table)
    assert [r for r in after if r[2] == 2] == [
        (20, "b20", 2, "2024-01-01"), (21, "a21", 2, "2024-01-02"), (22, "a22", 2, "2024-01-03"), (29, "b29", 2, "2024-01-01"),
    ]
    assert len(after) == 19
    assert sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 3)) == ["2024-01-01"]
    assert content(spark, table) == after
    assert layout.vacuum(spark, table) == 1 and content(spark, table) == after


def test_files_that_outlive_their_compaction_are_read_once(spark, table, monkeypatch):
    """A crash after the manifest leaves the small files; readers take those rows from them."""
    before = content(spark, table)
    monkeypatch.setattr(layout, "drop_files", lambda spark, paths: None)
    sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 4))
    assert content(spark, table) == before
    monkeypatch.undo()
    monkeypatch.setattr(manifest, "commit", lambda *_: (_ for _ in ()).throw(manifest.Conflict("lost")))
    sinks.append_with_batch_metadata(raw(spark, (0, 70, "c")), 7, table, "r1", "capture")
    with pytest.raises(manifest.Conflict):
        sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 4))
    assert len(content(spark, table)) == len(before) + 1


def test_a_time_range_opens_its_days_only(spark, table):
    sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 3))
    rows = sinks.read_batches(spark, table, BRONZE_RAW)
    scope = jobs.replay_scope(rows, T0 + timedelta(days=1), T0 + timedelta(days=1, hours=1))
    assert {r["event_date"] for r in scope.collect()} == {date(2024, 1, 2)}
    plan = scope._jdf.queryExecution().explainString(scope._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scans = [block for block in plan.split("\n\n") if "Scan parquet" in block and "Location" in block]
    assert len(scans) >= 3  # small files, compacted files, the list of batches written again
    assert all("PartitionFilters: [" in s and "event_date" in s.split("PartitionFilters:")[1].split("]")[0] for s in scans)


def test_large_groups_are_written_by_several_tasks(spark, table):
    sinks.compact_days(spark, table, BRONZE_RAW, date(2024, 1, 4), target_bytes=5_000)
    by_day = {d: sum(d in f for f in files(f"{table}_compacted")) for d in ("2024-01-01", "2024-01-02", "2024-01-03")}
    assert min(by_day.values()) > 1


def test_numbers_are_written_once(spark, tmp_path):
    folder = f"{tmp_path}/m"
    assert manifest.newest(spark, folder) == (0, {})
    manifest.commit(spark, folder, 1, {"a": 1})
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, folder, 1, {"a": 2})
    manifest.commit(spark, folder, 2, {"a": 3})
    assert manifest.newest(spark, folder) == (2, {"a": 3})


def test_new_columns_join_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    first, wider = raw(spark, (0, 1, "a")), raw(spark, (1, 2, "a")).withColumn("lang", F.lit("en"))
    for batch_id, batch in enumerate((first, wider, raw(spark, (2, 3, "a")))):
        sinks.append_with_batch_metadata(batch, batch_id, path, "r1", "capture")
    found = evolution.read_evolved(spark, path).orderBy("source_offset").collect()
    assert [(r["source_offset"], r["lang"], r["_batch_id"]) for r in found] == [(1, None, 0), (2, "en", 1), (3, None, 2)]
    assert manifest.newest(spark, f"{path}_schema")[0] == 2


def test_retyped_columns_are_refused_before_anything_is_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.append_with_batch_metadata(raw(spark, (0, 1, "a")), 0, path, "r1", "capture")
    before = files(path)
    retyped = raw(spark, (0, 2, "a")).withColumn("source_partition", F.lit("zero"))
    with pytest.raises(ValueError, match="source_partition: the table has int, the batch string"):
        sinks.append_with_batch_metadata(retyped, 1, path, "r1", "capture")
    assert files(path) == before and manifest.newest(spark, f"{path}_schema")[0] == 1
    with pytest.raises(ValueError, match="no schema"):
        evolution.read_evolved(spark, f"{tmp_path}/nothing")


def test_structs_merge_by_field():
    known = StructType.fromDDL("a int, s struct<x: int, y: string>")
    new = StructType.fromDDL("s struct<y: string, z: double>, b date")
    assert evolution.merged(known, new).simpleString() == "struct<a:int,s:struct<x:int,y:string,z:double>,b:date>"
    with pytest.raises(ValueError, match=r"s\.y"):
        evolution.merged(known, StructType([StructField("s", StructType.fromDDL("y int"))]))
    assert evolution.merged(StructType([]), StructType([StructField("a", StringType(), False)])).fields[0].nullable


def test_two_writers_merge_one_after_the_other(spark, tmp_path, monkeypatch):
    path, plain = f"{tmp_path}/t", manifest.commit
    evolution.admit(spark.range(1), path)

    def other_first(spark, folder, number, document):
        monkeypatch.setattr(manifest, "commit", plain)
        evolution.admit(spark.range(1).withColumn("theirs", F.lit(1)), path)
        plain(spark, folder, number, document)

    monkeypatch.setattr(manifest, "commit", other_first)
    assert evolution.admit(spark.range(1).withColumn("ours", F.lit("x")), path).fieldNames() == ["id", "theirs", "ours"]


def v1(spark, *rows):
    def record(offset, message):
        value = json.dumps({"user": "u", "message": message, "sentiment": {"compound": 0.5}}) if message else "broken"
        return (b"k", value.encode(), "t", 0, offset, T0, 0)

    return spark.createDataFrame([record(*r) for r in rows], LOG_RECORD)


def test_status_log_is_reduced_by_segment(spark, tmp_path):
    path, silver = f"{tmp_path}/raw", f"{tmp_path}/silver"
    write = jobs.v1_batch(path, silver, segment_offsets=10)
    for batch_id, rows in enumerate(([(1, "a"), (2, ""), (15, "b")], [(2, "now readable"), (3, "c")], [(16, "d")])):
        write(v1(spark, *rows), batch_id)
    statuses = lambda: sorted((r["offset"], r["parse_status"]) for r in jobs.v1_bronze(spark, path).collect())
    before = statuses()
    assert before == [(1, "OK"), (2, "OK"), (3, "OK"), (15, "OK"), (16, "OK")]
    assert jobs.compact_statuses(spark, path, least_files=2) == ["t-0-0", "t-0-1"]
    assert statuses() == before and files(jobs.status_log(path)) == []
    kept = layout.read_layout(spark, jobs.status_log(path), jobs.STATUS, jobs.SEGMENT, jobs.V1_OWNER)
    assert kept.count() == 5  # one row per key, of six
    write(v1(spark, (1, "a"), (1, "")), 3)
    write(v1(spark, (2, "now readable"), (3, "c")), 1)  # a batch repeated after the compaction
    assert statuses() == [(1, "PARSE_ERROR"), (2, "OK"), (3, "OK"), (15, "OK"), (16, "OK")]


def test_the_anti_join_opens_the_segments_of_the_batch(spark, tmp_path):
    path, silver = f"{tmp_path}/raw", f"{tmp_path}/silver"
    write = jobs.v1_batch(path, silver, segment_offsets=10)
    write(v1(spark, *[(k, "a") for k in range(40)]), 0)
    batch = jobs.in_segments(jobs.v1_parsed_raw(v1(spark, (15, "a"), (99, "b"))), 10)
    absent = jobs._absent(batch, path, 1, ["json_payload"], ["t-0-1", "t-0-9"])
    assert [r["offset"] for r in absent.collect()] == [99]
    plan = absent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_segment#\d+ IN \(t-0-1,t-0-9\)", plan)
    assert jobs.in_segments(spark.createDataFrame([(None, 1, 2)], "topic string, partition int, offset long")).first()["_segment"] == "none"
