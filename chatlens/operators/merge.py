"""Keyed merges without a table format: insert-if-absent and update-on-match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return batch.withColumn("_copy", rank).filter("_copy = 1").drop("_copy")


def prune_to_batch(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Limit a target scan to the batch's range of ``column``, which must be part of the merge key.

    Rows outside the range, or without a value, cannot match any row of the batch, so the merge
    is the same. One min/max row is fetched; pass a batch that is stored, not one to be computed.
    """
    low, high = batch.agg(F.min(column), F.max(column)).first()
    if low is None:
        return target.limit(0)
    return target.filter(F.col(column).between(low, high))


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    prune_on: str | None = None,
) -> DataFrame:
    """Rows an insert-only merge would add: first copy per key, and only absent keys."""
    if prune_on is not None and prune_on not in keys:
        raise ValueError(f"{prune_on} is no part of the key {list(keys)}")
    known = target if prune_on is None else prune_to_batch(target, batch, prune_on)
    return first_per_key(batch, keys, order).join(known.select(*keys), list(keys), "left_anti")


def merge_insert_new(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The target after the insert-only merge."""
    return target.unionByName(new_rows(target, batch, keys, order).select(*target.columns))


def merge_update_status(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = ("parse_status", "parse_error"),
) -> DataFrame:
    """The target after an update-on-match merge; ``updates`` has one row per key.

    A matched row takes every new value, nulls included.
    """
    marked = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(marked, list(keys), "left")
    changed = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(changed).select(*target.columns)


def merge_condition_sql(keys: Sequence[str], target: str = "t", source: str = "s") -> str:
    """ON clause for table formats that have MERGE."""
    return " AND ".join(f"{target}.{k} = {source}.{k}" for k in keys)


def merge_insert_sql(table: str, source_view: str, keys: Sequence[str]) -> str:
    """The same insert-only merge as a statement for such formats."""
    return (
        f"MERGE INTO {table} t USING {source_view} s ON {merge_condition_sql(keys)} "
        "WHEN NOT MATCHED THEN INSERT *"
    )
