"""Scans and materialisation of the engine's own tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def literal_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A small constant table. It carries its size, so Spark may broadcast it on its own."""
    return spark.createDataFrame(pa.table(columns))


def staging_scan(source: DataFrame, schema: StructType) -> DataFrame:
    """Source-conformed columns in contract order; a missing or retyped column fails at analysis."""
    found = {f.name: f.dataType for f in source.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        f"found {found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in schema.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("source does not match its schema: " + "; ".join(wrong))
    return source.select(*schema.fieldNames())


def read_table(spark: SparkSession, name_or_path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Read a catalog table, or files where a path is given."""
    if "/" in name_or_path:
        files = spark.read.format(fmt).schema(schema).load(name_or_path)
        return files.select(*schema.fieldNames())
    return staging_scan(spark.read.table(name_or_path), schema)


def stream_table_scan(
    spark: SparkSession,
    name_or_path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Incremental scan of an upstream table: new rows only."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if "/" in name_or_path:
        return reader.format(fmt).schema(schema).load(name_or_path).select(*schema.fieldNames())
    return reader.table(name_or_path)


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "table",
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    fmt: str = "parquet",
) -> DataFrame:
    """Publish a model: ``view``, ``ephemeral`` (the DataFrame itself) or ``table``.

    Bucketing the parsed and the feature table by ``event_id`` with the same bucket count
    lets version ranking and their join run without a shuffle.
    """
    if kind == "ephemeral":
        return df
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if buckets:
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return df.sparkSession.table(name)
