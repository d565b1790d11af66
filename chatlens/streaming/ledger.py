"""What a stream says of itself: committed batches, progress, remembered keys."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatlens.operators.parse import dead_letters, valid_events
from chatlens.schemas import BATCH_LEDGER, PARSE_STAGE, STREAM_PROGRESS
from chatlens.sources.tables import read_table
from chatlens.streaming.sinks import append_with_batch_metadata, replace_rows, stored_batch

LEDGER_PARTITIONS = ["run_id", "job_name", "batch_id"]


def routed_batch(
    parsed: str,
    dlq: str,
    ledger: str,
    run_id: str,
    job_name: str = PARSE_STAGE,
    ops_metrics: str | None = None,
    fmt: str = "parquet",
    as_of: Column | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> Callable[[DataFrame, int], None]:
    """One micro-batch function for classified rows: events to one target, failures to the other.

    The batch is computed once and stored for both writes. A ledger row follows them; until it is
    there, ``committed`` shows neither part, and the repeat of the batch replaces both.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with stored_batch(batch) as rows:
            counts = [
                append_with_batch_metadata(part, batch_id, target, run_id, job_name, ops_metrics, fmt, clock=clock)
                for part, target in ((valid_events(rows), parsed), (dead_letters(rows, as_of), dlq))
            ]
            entry = (run_id, job_name, int(batch_id), clock(), *counts)
            replace_rows(batch.sparkSession.createDataFrame([entry], BATCH_LEDGER), ledger, LEDGER_PARTITIONS)

    return write


def committed(table: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of batches whose ledger row is written: all parts of a batch, or none."""
    names = {"run_id": "_run_id", "job_name": "_job_name", "batch_id": "_batch_id"}
    done = ledger.select(*[F.col(c).alias(k) for c, k in names.items()])
    return table.join(done, list(names.values()), "left_semi")


def record_progress(query: StreamingQuery, target: str, run_id: str, job_name: str) -> int:
    """Write one row per micro-batch of a stopped query from its progress reports; returns how many.

    The reports hold what the state operators dropped: rows behind the watermark and copies. A query
    remembers ``spark.sql.streaming.numRecentProgressUpdates`` of them; a gap is an error.
    """
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    rows, seen = [], set()
    for report in query.recentProgress:
        if report.batchId in seen and not report.numInputRows:
            continue
        seen.add(report.batchId)
        late = sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
        copies = sum(int(op.customMetrics.get("numDroppedDuplicateRows", 0)) for op in report.stateOperators)
        mark = (report.eventTime or {}).get("watermark")
        reached = datetime.fromisoformat(mark.replace("Z", "+00:00")) if mark and not mark.startswith("1970-01-01") else None
        rows.append((run_id, job_name, int(report.batchId), int(report.numInputRows), int(late), copies, reached))
    if rows and len(seen) != max(seen) - min(seen) + 1:
        raise ValueError("progress reports are missing; raise spark.sql.streaming.numRecentProgressUpdates")
    if rows:
        replace_rows(spark.createDataFrame(rows, STREAM_PROGRESS), target, LEDGER_PARTITIONS)
    return len(rows)


def remembered_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys the dedupe state still holds, with the time they expire: partition_id, event_id, expires_ts.

    Entries of failures, which have a key of their own, are left out.
    """
    state = spark.read.format("statestore").load(checkpoint)
    rows = state.where("key._failure IS NULL")
    return rows.select("partition_id", F.col("key.event_id").alias("event_id"), F.timestamp_micros("value.expiresAtMicros").alias("expires_ts"))


def progress(spark: SparkSession, target: str) -> DataFrame:
    return read_table(spark, target, STREAM_PROGRESS)
