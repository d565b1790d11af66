"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the one setting results depend on, the time zone; the rest is the caller's.

    Large shuffles rely on adaptive plans with skew splitting, which are on unless a caller turned them off.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the one named for checkpoints, else one in the warehouse."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint()
