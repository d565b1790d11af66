"""Small tables with the awkward cases every operator has to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the silent river bank"


def documents(spark: SparkSession, rows: list[tuple], schema: str = DOCS) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls everywhere, empty, blank and long texts, repeated rows, ties, and clashing columns."""
    rows = [
        (1, PROSE, "en", "a", 10),
        (1, PROSE, "en", "a", 10),
        (2, PROSE + " indeed", None, "a", None),
        (3, None, None, None, None),
        (None, PROSE, "en", "b", 1),
        (None, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\r\n\x0b\x0c", "en", "b", 6),
        (6, "word " * 30_000, "en", "c", 150_000),
        (7, "a" * 200_000, "en", "c", 200_000),
        (8, "\n\n\n", "en", "c", 3),
        (9, "Ünïcödé tëxt \U0001f600 " * 20, "de", "b", 1),
    ]
    df = documents(spark, rows)
    for name in ("kept", "fp", "h", "size", "hash", "bucket", "node", "root", "id", "shard", "slot", "word", "n", "term", "pos"):
        df = df.withColumn(name, F.lit("theirs"))
    return df


def nothing(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
