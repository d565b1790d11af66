"""Additive schema evolution of file tables: numbered schemas beside the files, merged on write and read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from chatlens.sources import manifest

TRIES = 5


def _folder(table: str) -> str:
    return f"{table.rstrip('/')}_schema"


def merged(known: StructType, new: StructType, path: str = "") -> StructType:
    """Known columns, then new ones, all nullable; nested structs merge the same way. A retyped column is an error."""
    fields = {f.name: f for f in known.fields}
    for field in new.fields:
        name, old = f"{path}{field.name}", fields.get(field.name)
        if old is None:
            fields[field.name] = StructField(field.name, field.dataType, True)
        elif isinstance(old.dataType, StructType) and isinstance(field.dataType, StructType):
            fields[field.name] = StructField(field.name, merged(old.dataType, field.dataType, f"{name}."), True)
        elif old.dataType != field.dataType:
            raise ValueError(f"{name}: the table has {old.dataType.simpleString()}, the batch {field.dataType.simpleString()}")
    return StructType([StructField(f.name, f.dataType, True) for f in fields.values()])


def table_schema(spark: SparkSession, table: str) -> StructType | None:
    """The newest schema of a table, or None before its first batch."""
    number, document = manifest.newest(spark, _folder(table))
    return StructType.fromJson(document) if number else None


def admit(df: DataFrame, table: str) -> StructType:
    """The table's schema after this batch; a new one is committed first, a retyped column is refused before anything is written.

    Two writers that add columns at once merge one after the other.
    """
    spark = df.sparkSession
    for _ in range(TRIES):
        number, document = manifest.newest(spark, _folder(table))
        known = StructType.fromJson(document) if number else StructType([])
        schema = merged(known, df.schema)
        if number and schema == known:
            return schema
        try:
            manifest.commit(spark, _folder(table), number + 1, schema.jsonValue())
            return schema
        except manifest.Conflict:
            continue
    raise manifest.Conflict(f"the schema of {table} changes too often")


def read_evolved(spark: SparkSession, table: str, fmt: str = "parquet") -> DataFrame:
    """All batches with the columns of all of them; rows of batches without a column have nulls."""
    schema = table_schema(spark, table)
    if schema is None:
        raise ValueError(f"{table} has no schema yet")
    return spark.read.format(fmt).schema(schema).load(table).select(*schema.fieldNames())
