"""File tables whose batches own partitions: compaction of closed groups, and reading both forms.

A sink writes each batch into partitions of its own below a group (the event day, or a segment of
the log), so many batches leave many small files. ``compact`` rewrites whole groups into files of a
target size, clustered by the given columns, and commits a manifest that names the folder of each
group; the small files go afterwards. A batch that is written again after that appears as a
partition again, and reading then takes it from there and not from the compacted files. Until the
manifest is committed nothing changes for readers; after it, small files that are still there are
what they read. Either way every row is read once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chatlens.sources import manifest

TARGET_BYTES = 256 << 20
COMPRESSION = "zstd"  # of rows with whole payloads
VERSION = "_version"


def stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """Files of a table, or None before the first batch."""
    fs, where = manifest.file_system(spark, path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames()) if fs.exists(where) else None


def _manifest(table: str) -> str:
    return f"{table.rstrip('/')}_manifest"


def _compacted(table: str) -> str:
    return f"{table.rstrip('/')}_compacted"


def _compacted_rows(spark: SparkSession, table: str, schema: StructType, group: str) -> DataFrame | None:
    _, document = manifest.newest(spark, _manifest(table))
    folders = [f"{_compacted(table)}/{VERSION}={v}/{group}={value}" for value, v in document.get("groups", {}).items()]
    if not folders:
        return None
    files = spark.read.schema(schema).option("basePath", _compacted(table)).parquet(*folders)
    return files.select(*schema.fieldNames())


def read_layout(spark: SparkSession, table: str, schema: StructType, group: StructField, owner: Sequence[str]) -> DataFrame:
    """All rows of a table, with its group column. Filters on the group reach both forms as partition filters.

    ``owner`` names the partition columns below the group that say which batch wrote a row.
    """
    full = schema if group.name in schema.fieldNames() else StructType([*schema.fields, group])
    raw = stored(spark, table, full)
    done = _compacted_rows(spark, table, full, group.name)
    if raw is None or done is None:
        return raw if done is None else done
    key = [group.name, *owner]
    written_again = raw.where(F.col(group.name).isNotNull()).select(*key).distinct()
    # One row per partition folder; rows with their payloads are not shuffled for it.
    return raw.unionByName(done.join(F.broadcast(written_again), key, "left_anti"))


def _files(spark: SparkSession, path: str, group: str) -> DataFrame:
    """path, length and group of data files; only the listing is read."""
    value = F.regexp_extract("path", rf"/{group}=([^/]*)/", 1).alias("value")
    return _listed(spark, path).select("path", "length", value)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(path)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the data files of tables; only the listing is read."""
    return sum(_listed(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] for path in paths)


def group_bytes(spark: SparkSession, path: str, group: str) -> dict[str, int]:
    """Bytes of data files by the value of a group; only the listing is read."""
    sizes = _files(spark, path, group).groupBy("value").agg(F.sum("length").alias("bytes"))
    return {r["value"]: r["bytes"] for r in sizes.collect()}


def compact(
    spark: SparkSession,
    table: str,
    schema: StructType,
    group: StructField,
    owner: Sequence[str],
    order: Sequence[str],
    closed: Callable[[str], bool],
    least_files: int = 2,
    target_bytes: int = TARGET_BYTES,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> list[str]:
    """Rewrite the closed groups that have small files; returns their values.

    Only listings come to the driver: one number of bytes per group and the names of the files to
    drop. Rows are clustered by group and ``order`` with a range shuffle of as many ranges as target
    sizes, so a large group is written by several tasks. ``merge`` may reduce the rows of a group.
    Nobody may write to a group while it is compacted; files that came in between are kept and read.
    """
    full = schema if group.name in schema.fieldNames() else StructType([*schema.fields, group])
    if stored(spark, table, full) is None:
        return []
    listed = _files(spark, table, group.name).where("value <> '' AND value <> '__HIVE_DEFAULT_PARTITION__'")
    sizes = {r["value"]: (r["files"], r["bytes"]) for r in listed.groupBy("value").agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).collect()}
    number, document = manifest.newest(spark, _manifest(table))
    known = document.get("groups", {})
    wanted = sorted(v for v, (files, _) in sizes.items() if closed(v) and (files >= least_files or v in known))
    if not wanted:
        return []
    old = [r["path"] for r in listed.where(F.col("value").isin(wanted)).select("path").collect()]
    again = [f"{_compacted(table)}/{VERSION}={known[v]}/{group.name}={v}" for v in wanted if v in known]
    before = {r["value"]: r["bytes"] for p in again for r in _files(spark, p, group.name).groupBy("value").agg(F.sum("length").alias("bytes")).collect()}
    ranges = sum(math.ceil((sizes[v][1] + before.get(v, 0)) / target_bytes) for v in wanted)
    rows = read_layout(spark, table, schema, group, owner).where(F.col(group.name).isin([F.lit(v).cast(group.dataType) for v in wanted]))
    rows = merge(rows) if merge else rows
    spread = [group.name, *order, F.xxhash64(*rows.columns)]  # rows with equal keys can lie in several ranges too
    clustered = rows.repartitionByRange(ranges, *spread).sortWithinPartitions(*spread)
    folder = f"{_compacted(table)}/{VERSION}={number + 1}"
    clustered.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(group.name).parquet(folder)
    manifest.commit(spark, _manifest(table), number + 1, {"groups": {**known, **dict.fromkeys(wanted, number + 1)}})
    drop_files(spark, old)
    return wanted


def drop_files(spark: SparkSession, paths: Sequence[str]) -> None:
    for name in paths:
        fs, where = manifest.file_system(spark, name)
        fs.delete(where, False)


def vacuum(spark: SparkSession, table: str) -> int:
    """Drop compacted folders that the newest manifest doesn't name; returns how many. Run it when no reader is left on them."""
    fs, where = manifest.file_system(spark, _compacted(table))
    _, document = manifest.newest(spark, _manifest(table))
    named = {(str(v), value) for value, v in document.get("groups", {}).items()}
    dropped = 0
    for version in fs.listStatus(where) if fs.exists(where) else ():
        for part in fs.listStatus(version.getPath()) if version.isDirectory() else ():
            value = part.getPath().getName().partition("=")
            if value[1] and (version.getPath().getName().partition("=")[2], value[2]) not in named:
                fs.delete(part.getPath(), True)
                dropped += 1
    return dropped
