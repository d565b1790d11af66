"""The streaming jobs: capture, parse and route, features, first-generation batch, replay."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chatlens.functions.message import message_features
from chatlens.operators.merge import first_per_key, merge_update_status, new_rows
from chatlens.operators.parse import classify, dead_letters, dedupe, stream_dedupe_classified, valid_events
from chatlens.operators.v1 import parse_status, v1_enrich, v1_parsed_raw
from chatlens.schemas import (
    BRONZE_STAGE,
    DEFAULT_DEDUPE_WATERMARK,
    FEATURE_STAGE,
    LOG_KEY,
    PARSE_STAGE,
    SILVER_PARSED,
    V1_BRONZE,
)
from chatlens.sources.layout import compact, read_layout
from chatlens.sources.log import bronze_projection
from chatlens.streaming.ledger import routed_batch
from chatlens.streaming.sinks import EVENT_DATE, stored_batch, stream_append, with_batch_metadata

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession, partitions: int, on_disk: bool = True) -> Iterator[None]:
    """Settings for stateful queries started inside the block.

    A query keeps the partition count of its first start for good, and adaptive execution does
    not coalesce it, so it is chosen for the expected key volume. Large key sets belong on disk; a
    checkpoint then holds what each batch changed, not the whole state.
    """
    wanted = {"spark.sql.shuffle.partitions": str(partitions)}
    if on_disk:
        wanted["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        wanted["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def await_all(*queries: StreamingQuery) -> None:
    """Wait for every query; when one fails, stop the others and raise."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def kafka_to_bronze_stream(
    log: DataFrame,
    bronze: str,
    checkpoint: str,
    run_id: str,
    ops_metrics: str | None = None,
    fmt: str = "parquet",
    available_now: bool = True,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Raw capture: no parsing, no dedupe, no shuffle."""
    return stream_append(
        bronze_projection(log, as_of), bronze, checkpoint, run_id, BRONZE_STAGE, ops_metrics, fmt, available_now
    )


def bronze_to_silver_stream(
    bronze: DataFrame,
    parsed: str,
    dlq: str,
    checkpoint: str,
    run_id: str,
    ops_metrics: str | None = None,
    watermark: str = DEFAULT_DEDUPE_WATERMARK,
    dedupe_mode: str = "within_watermark",
    fmt: str = "parquet",
    available_now: bool = True,
    as_of: Column | None = None,
    literal_routing: bool = False,
    ledger: str | None = None,
) -> StreamingQuery:
    """Validated events and failures from one query: raw rows are read, parsed and kept once a batch.

    The ledger (beside the checkpoint unless named) makes both writes of a batch one unit.
    """
    unique = stream_dedupe_classified(classify(bronze, as_of, literal_routing), watermark, dedupe_mode)
    write = routed_batch(parsed, dlq, ledger or ledger_of(checkpoint), run_id, PARSE_STAGE, ops_metrics, fmt, as_of)
    writer = unique.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ledger_of(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_ledger"


def silver_to_features_stream(
    parsed: DataFrame,
    features: str,
    checkpoint: str,
    run_id: str,
    ops_metrics: str | None = None,
    fmt: str = "parquet",
    available_now: bool = True,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Incremental features of new parsed rows: stateless, no shuffle."""
    return stream_append(
        message_features(parsed, as_of), features, checkpoint, run_id, FEATURE_STAGE, ops_metrics, fmt, available_now
    )


# First-generation tables lie by segments of the log, so a key says in which partition to look for it.
SEGMENT = StructField("_segment", StringType())
SEGMENT_OFFSETS = 1 << 20
V1_OWNER = ["_batch_id"]
BATCH_ID = StructField("_batch_id", LongType())
STATUS_FIELDS = [StructField("parse_status", StringType()), StructField("parse_error", StringType())]
STATUS = StructType([*(V1_BRONZE[k] for k in LOG_KEY), *STATUS_FIELDS, BATCH_ID])


def in_segments(rows: DataFrame, offsets: int = SEGMENT_OFFSETS) -> DataFrame:
    """Add the segment of a row's key: its topic, partition and range of so many offsets."""
    place = F.concat_ws("-", F.col("topic"), F.col("partition"), F.floor(F.col("offset") / offsets))
    known = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return rows.withColumn(SEGMENT.name, F.when(known, place).otherwise("none"))


def _own_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Each batch owns its partitions, so a repeated batch replaces its own rows only."""
    stamped = rows.withColumn(BATCH_ID.name, F.lit(batch_id).cast("bigint"))
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(SEGMENT.name, *V1_OWNER).parquet(path)


def _absent(rows: DataFrame, path: str, batch_id: int, order: list[str], segments: list[str]) -> DataFrame:
    """Rows whose log key no *other* batch has written yet, first copy per key.

    Keys match in full. The target scan opens the segments of the batch only, and reads key columns in
    the batch's range of offsets, so it can skip row groups without missing a match.
    """
    keys = StructType([*(V1_BRONZE[k] for k in LOG_KEY), BATCH_ID])
    table = read_layout(rows.sparkSession, path, keys, SEGMENT, V1_OWNER)
    if table is None:
        return first_per_key(rows, LOG_KEY, order)
    others = table.filter(F.col(SEGMENT.name).isin(segments) & (F.col(BATCH_ID.name) != batch_id))
    return new_rows(others.drop(SEGMENT.name), rows, LOG_KEY, order, prune_on="offset")


def status_log(bronze: str) -> str:
    return f"{bronze.rstrip('/')}_status"


def _newest_status(statuses: DataFrame) -> DataFrame:
    columns = [*(f.name for f in STATUS_FIELDS), BATCH_ID.name]
    newest = F.max_by(F.struct(*columns), BATCH_ID.name).alias("_newest")
    return statuses.groupBy(*LOG_KEY, SEGMENT.name).agg(newest).select(*LOG_KEY, "_newest.*", SEGMENT.name)


def v1_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """Raw rows with the newest status of their key.

    Files cannot be updated in place, so each batch adds the statuses of its keys to a narrow log
    beside the raw rows. Reading merges the newest one per key: of the compacted log, which has one
    row per key, and of the batches since.
    """
    raw = read_layout(spark, bronze, StructType([*V1_BRONZE.fields, BATCH_ID]), SEGMENT, V1_OWNER).select(*V1_BRONZE.fieldNames())
    statuses = read_layout(spark, status_log(bronze), STATUS, SEGMENT, V1_OWNER)
    if statuses is None:
        return raw
    columns = [f.name for f in STATUS_FIELDS]
    return merge_update_status(raw, _newest_status(statuses).select(*LOG_KEY, *columns), LOG_KEY, columns)


def compact_statuses(spark: SparkSession, bronze: str, least_files: int = 8) -> list[str]:
    """Reduce the status log to one row per key in the segments with so many files; run it between batches."""
    return compact(
        spark, status_log(bronze), STATUS, SEGMENT, V1_OWNER, ["offset"], lambda segment: True, least_files, merge=_newest_status
    )


def v1_batch(
    bronze: str, silver: str, as_of: Column | None = None, segment_offsets: int = SEGMENT_OFFSETS
) -> Callable[[DataFrame, int], None]:
    """One micro-batch function: raw insert-if-absent, parse, enrich, status of every key in the batch.

    Payloads are parsed once, into the stored batch that all writes read. The list of the batch's
    segments is all that comes to the driver.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        now = F.lit(datetime.now(timezone.utc)) if as_of is None else as_of
        with stored_batch(v1_parsed_raw(batch)) as parsed:
            segments = [r[0] for r in in_segments(parsed, segment_offsets).select(SEGMENT.name).distinct().collect()]
            status = parse_status(parsed)
            raw = parsed.withColumn("ingest_ts", now).drop("parse_ok")
            raw = _absent(raw, bronze, batch_id, ["json_payload"], segments).join(status, list(LOG_KEY), "left")
            _own_batch(in_segments(raw.select(*V1_BRONZE.fieldNames()), segment_offsets), bronze, batch_id)
            good = _absent(parsed.filter("parse_ok"), silver, batch_id, ["json_payload"], segments)
            _own_batch(in_segments(v1_enrich(good, now), segment_offsets), silver, batch_id)
            _own_batch(in_segments(status, segment_offsets), status_log(bronze), batch_id)

    return write


def v1_foreach_batch(
    log: DataFrame,
    bronze: str,
    silver: str,
    checkpoint: str,
    available_now: bool = True,
    as_of: Column | None = None,
    segment_offsets: int = SEGMENT_OFFSETS,
) -> StreamingQuery:
    write = v1_batch(bronze, silver, as_of, segment_offsets)
    writer = log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def replay_scope(
    bronze: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    topic: str | None = None,
    partition: int | None = None,
    offsets: tuple[int, int] | None = None,
) -> DataFrame:
    """Raw rows of a half-open time window and/or an inclusive offset range.

    A table that lies by event day opens the days of the window only.
    """
    scope = bronze
    dated = EVENT_DATE in bronze.columns
    if start is not None:
        scope = scope.filter(F.col("kafka_timestamp") >= F.lit(start))
        scope = scope.filter(F.col(EVENT_DATE) >= F.to_date(F.lit(start))) if dated else scope
    if end is not None:
        scope = scope.filter(F.col("kafka_timestamp") < F.lit(end))
        scope = scope.filter(F.col(EVENT_DATE) <= F.to_date(F.lit(end))) if dated else scope
    if topic is not None:
        scope = scope.filter(F.col("source_topic") == topic)
    if partition is not None:
        scope = scope.filter(F.col("source_partition") == partition)
    if offsets is not None:
        scope = scope.filter(F.col("source_offset").between(*offsets))
    return scope


def replay(
    scope: DataFrame,
    run_id: str,
    batch_id: int = 0,
    processed_ts: Column | None = None,
    as_of: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Parse raw rows again under their own run id: (validated, failures), both stamped.

    Appended beside earlier runs; ``latest_version`` lets the newest run win downstream.
    """
    processed = F.current_timestamp() if processed_ts is None else processed_ts
    classified = classify(scope, as_of)
    valid = dedupe(valid_events(classified)).select(*SILVER_PARSED.fieldNames())
    return tuple(
        with_batch_metadata(df, run_id, PARSE_STAGE, batch_id, processed)
        for df in (valid, dead_letters(classified, as_of))
    )  # type: ignore[return-value]
