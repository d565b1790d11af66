"""Micro-batch writes that can be repeated safely, and their metrics rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from chatlens.schemas import BATCH_METRICS, with_write_metadata
from chatlens.session import checkpoint_root
from chatlens.sources import layout
from chatlens.sources.evolution import admit

BATCH_PARTITIONS = ["_run_id", "_job_name", "_batch_id"]
EVENT_DATE = "event_date"
EVENT_DAY = StructField(EVENT_DATE, DateType())
LOG_TIMES = ("event_ts", "kafka_timestamp", "source_event_ts")  # when the log took a record: the same in every run
METRICS_PARTITIONS = ["run_id", "job_name", "target_table", "batch_id"]


def with_batch_metadata(
    df: DataFrame, run_id: Column | str, job_name: str, batch_id: Column | int, processed_ts: Column
) -> DataFrame:
    """Stamp the four write-metadata columns."""
    return df.withColumns(
        {
            "_run_id": run_id if isinstance(run_id, Column) else F.lit(run_id),
            "_job_name": F.lit(job_name),
            "_batch_id": (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast("bigint"),
            "_batch_processed_ts": processed_ts.cast("timestamp"),
        }
    )


def with_event_date(df: DataFrame) -> DataFrame:
    """Add the day of the log time, which every run of a record shares; tables without one stay as they are."""
    times = [c for c in LOG_TIMES if c in df.columns]
    return df.withColumn(EVENT_DATE, F.to_date(times[0])) if times else df


def _is_path(target: str) -> bool:
    return "/" in target


@contextmanager
def stored_batch(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows of a micro-batch, computed once into files that its writes read, and dropped after them.

    A cache would build columns of ten thousand whole texts in each task and fill the executors' heap
    with the batch, which grows with the log. Files take a task one row group, and losing an executor loses none.
    """
    spark = rows.sparkSession
    folder = f"{checkpoint_root(spark).rstrip('/')}/batch-{uuid4().hex}"
    try:
        rows.write.option("compression", layout.COMPRESSION).parquet(folder)
        yield spark.read.schema(rows.schema).parquet(folder)
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_batch(stamped: DataFrame, target: str, fmt: str, run_id: str, job_name: str, batch_id: int) -> None:
    """Write one stamped batch so that writing it again replaces it.

    Files and catalog tables: the batch owns its partitions, which a repeat overwrites. They lie below
    the event day, so a time range opens its days only. Columns that are new to a file table join its
    schema before anything is written; a retyped one is refused. Delta: the transaction id lets the
    table skip a repeat, and merges schemas itself.
    """
    transaction = {"txnAppId": f"{run_id}:{job_name}:{target}", "txnVersion": str(batch_id)}
    dated = with_event_date(stamped)
    days = [EVENT_DATE] if EVENT_DATE in dated.columns else []
    if fmt != "delta" and _is_path(target):
        admit(dated, target)
    _write(dated, target, fmt, [*days, *BATCH_PARTITIONS], transaction)


def _write(df: DataFrame, target: str, fmt: str, partitions: list[str], transaction: dict[str, str]) -> None:
    """Dynamic partition overwrite stages each write in a folder of its own, so queries that
    share a target (the two parse queries share the metrics) do not disturb each other."""
    if fmt == "delta":
        writer = df.write.format(fmt).mode("append").option("mergeSchema", "true").options(**transaction)
        writer.save(target) if _is_path(target) else writer.saveAsTable(target)
        return
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "parquet":
        writer = writer.option("compression", layout.COMPRESSION)
    if _is_path(target):
        writer.partitionBy(*partitions).save(target)
    elif not df.sparkSession.catalog.tableExists(target):
        writer.partitionBy(*partitions).saveAsTable(target)
    else:
        columns = df.sparkSession.table(target).columns
        df.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(target)


def replace_rows(rows: DataFrame, target: str, partitions: list[str], fmt: str = "parquet") -> None:
    """Write small rows that own their partitions; writing them again replaces them."""
    _write(rows, target, fmt, partitions, {})


def read_batches(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """A table written by ``write_batch``, with its write metadata and event day, compacted or not."""
    return layout.read_layout(spark, table, with_write_metadata(schema), EVENT_DAY, BATCH_PARTITIONS)


def compact_days(
    spark: SparkSession, table: str, schema: StructType, before: date, target_bytes: int = layout.TARGET_BYTES
) -> list[str]:
    """Compact the event days before a day; they must be closed, that is, no stream still writes to them."""
    order = [c for c in LOG_TIMES if c in schema.fieldNames()]
    return layout.compact(
        spark, table, with_write_metadata(schema), EVENT_DAY, BATCH_PARTITIONS, order, lambda day: day < before.isoformat(), target_bytes=target_bytes
    )


def batch_metrics_row(
    df: DataFrame, run_id: str, job_name: str, batch_id: int, processed_ts: datetime, row_count: int, target: str
) -> DataFrame:
    row = (run_id, job_name, int(batch_id), processed_ts, int(row_count), target)
    return df.sparkSession.createDataFrame([row], BATCH_METRICS)


def append_with_batch_metadata(
    batch: DataFrame,
    batch_id: int,
    target: str,
    run_id: str,
    job_name: str,
    ops_metrics: str | None = None,
    fmt: str = "parquet",
    skip_empty: bool = False,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> int:
    """Stamp and write one batch; returns its row count.

    The count is observed while the batch is written, so nothing is cached and the plan runs
    once. Zero-row batches still leave a metrics row. It is a second commit, made after the
    data: a retry replaces it (files, catalog tables) or skips it (Delta).
    """
    if skip_empty and batch.isEmpty():
        return 0
    processed_ts = clock()
    seen = Observation()
    counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
    stamped = with_batch_metadata(counted, run_id, job_name, batch_id, F.lit(processed_ts))
    write_batch(stamped, target, fmt, run_id, job_name, batch_id)
    rows = int(seen.get.get("rows", 0))
    if ops_metrics:
        row = batch_metrics_row(batch, run_id, job_name, batch_id, processed_ts, rows, target)
        # One writer sequence per metrics source: the id names the target it counts.
        transaction = {"txnAppId": f"metrics:{run_id}:{job_name}:{target}", "txnVersion": str(batch_id)}
        _write(row, ops_metrics, fmt, METRICS_PARTITIONS, transaction)
    return rows


def stream_append(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    run_id: str,
    job_name: str,
    ops_metrics: str | None = None,
    fmt: str = "parquet",
    available_now: bool = True,
    skip_empty: bool = False,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Start a query that appends each micro-batch with metadata."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_with_batch_metadata(
            batch, batch_id, target, run_id, job_name, ops_metrics, fmt, skip_empty, clock
        )

    writer = (
        stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def dlq_sink(
    dlq: DataFrame,
    target: str,
    checkpoint: str,
    available_now: bool = False,
    run_id: str | None = None,
    job_name: str = "dlq_router",
    ops_metrics: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Dead-letter sink: with metadata where a run id is given, else a native append sink."""
    if run_id:
        return stream_append(dlq, target, checkpoint, run_id, job_name, ops_metrics, fmt, available_now)
    writer = dlq.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(target) if _is_path(target) else writer.toTable(target)


def log_sink(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Publish rows with a ``value`` column to a log topic (needs the connector)."""
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
