"""Tables written once between steps, in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def stage(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write a table that several steps read, and read it back.

    Cuts the lineage: losing executors later costs no more than reading the files again. Inside a
    ``scratch`` block the table goes at its end; with ``keep``, at the end of the block around it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/staged-{uuid4().hex}"
    scopes = _SCOPES.get()[: -1 if keep else None]
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drops the tables staged inside at its end, also after a failure.

    What leaves the block must not read them any more: stage it with ``keep``. Kept tables outside
    any block stay until the shared folder is cleaned up, since their reader may still need them.
    """
    made: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in made:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)
