"""Numbered JSON documents beside a table: the newest one holds, and no number is written twice."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(Exception):
    """Another writer committed the same number first."""


def file_system(spark: SparkSession, path: str):  # noqa: ANN201  a JVM object
    """The file system of a path and the path for it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def newest(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """Number and content of the newest document; (0, {}) before the first."""
    fs, where = file_system(spark, folder)
    if not fs.exists(where):
        return 0, {}
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    if not numbers:
        return 0, {}
    text = spark.read.text(f"{folder}/{max(numbers):08d}.json", wholetext=True).first()[0]
    return max(numbers), json.loads(text)


def commit(spark: SparkSession, folder: str, number: int, document: dict) -> None:
    """Write a document under the next number; ``Conflict`` if that number is taken.

    It is written under a name readers don't look at and renamed, which fails if the name exists.
    """
    fs, where = file_system(spark, f"{folder}/{number:08d}.json")
    _, draft = file_system(spark, f"{folder}/.{number:08d}.{spark.sparkContext.applicationId}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(document).encode()))
    finally:
        out.close()
    try:
        done = not fs.exists(where) and fs.rename(draft, where)
    except Py4JJavaError:
        done = False
    if not done:
        fs.delete(draft, False)
        raise Conflict(f"{where} is already there")
