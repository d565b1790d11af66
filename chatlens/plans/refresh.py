"""Marts brought up to date for the days that new batches touched."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlens.operators.versions import parsed_left_features

Build = Callable[[DataFrame], DataFrame]


def touched_days(new_rows: DataFrame) -> list[date]:
    """Event days of newly written rows: as many values as days, so they can be literals of a filter."""
    days = new_rows.select(F.to_date("event_ts").alias("day")).where("day IS NOT NULL").distinct()
    return sorted(row["day"] for row in days.collect())


def refreshed(mart: DataFrame, time_column: str, parsed: DataFrame, features: DataFrame, days: list[date], build: Build) -> DataFrame:
    """The mart with the rows of ``days`` built anew and all others kept; equal to a full build.

    An event keeps its log time in every version, so all versions of the events of a day lie in that
    day: ranking, join and roll-up read those days only. A parsed table partitioned by ``event_date``
    is pruned to them.
    """
    in_days = F.to_date("event_ts").isin(days)
    if "event_date" in parsed.columns:
        in_days = F.col("event_date").isin(days)
    recent = parsed.where(in_days).drop("event_date")
    known = features.join(recent.select("event_id").distinct(), "event_id", "left_semi")
    rebuilt = build(parsed_left_features(recent, known))
    kept = mart.where(~F.to_date(time_column).isin(days) | F.col(time_column).isNull())
    return kept.unionByName(rebuilt)
