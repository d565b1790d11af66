"""Engagement roll-ups as mergeable state: late and replayed rows are folded in, other days are not read.

A state row holds, per interval, channel and bucket of chatters, what adds up: counts, integer and
decimal sums, and the chatters as a bitmap over numbers from a dictionary. Adding states adds the sums
and unites the bitmaps, so the roll-up of any number of folds equals the roll-up of all rows.
A newer version of an event is folded in by adding it and taking the older version away; sums
are exact, so nothing of the old one remains. Bits cannot be taken away: where an event's interval,
channel or chatter changed, its days are built anew.

State lies by event day. A fold reads and writes the days it touches, as a new version, and commits
a manifest that names the version of every day and the last batch of every source, so a repeated
fold does nothing and a failed one leaves nothing behind that is read.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatlens.plans.engagement import FLAGS, GRAIN_COLUMNS, MEANS, TOTALS
from chatlens.schemas import SILVER_FEATURES, SILVER_PARSED
from chatlens.sources import layout, manifest

DAY, VERSION = "_day", "_version"
EXACT = "decimal(18,15)"  # shares between 0 and 1


def _addend(column: str) -> Column:
    kinds = {f.name: f.dataType.typeName() for f in (*SILVER_PARSED.fields, *SILVER_FEATURES.fields)}
    return F.col(column).cast(EXACT if kinds[column] == "double" else "bigint")


def _sums(sign: int) -> list[Column]:
    """Everything that adds up; ``sign`` -1 takes rows away."""
    sums = [F.sum(F.lit(sign).cast("bigint")).alias("n")]
    for c in (*MEANS, *TOTALS):
        sums += [(sign * F.count(c)).alias(f"{c}_n"), (sign * F.sum(_addend(c))).alias(f"{c}_total")]
    for flag in FLAGS:
        sums += [(sign * F.count(flag)).alias(f"{flag}_n"), (sign * F.count_if(flag)).alias(f"{flag}_true")]
    return sums


def _chatter_numbers(spark: SparkSession, path: str, generation: int, chatters: DataFrame) -> DataFrame:
    """chatter_id, number: known chatters keep theirs, others get new ones, written before they are used."""
    schema = StructType.fromDDL(f"chatter_id string, number bigint, {VERSION} int")
    known = layout.stored(spark, path, schema)
    unseen = chatters.where("chatter_id IS NOT NULL").distinct()
    first = 0
    if known is not None:
        known = known.where(F.col(VERSION) < generation).drop(VERSION)  # a later one is left of a failed fold
        unseen = unseen.join(known, "chatter_id", "left_anti")
        first = (known.agg(F.max("number")).first()[0] or 0) + 1
    numbered = unseen.select("chatter_id", (F.monotonically_increasing_id() + first).alias("number"))
    numbered.write.mode("overwrite").parquet(f"{path}/{VERSION}={generation}")
    return layout.stored(spark, path, schema).where(F.col(VERSION) <= generation).drop(VERSION)


def contributions(joined: DataFrame, numbers: DataFrame, grain: str, sign: int = 1) -> DataFrame:
    """State of joined rows. Rows are added up per chatter before they meet the dictionary."""
    time_column, _ = GRAIN_COLUMNS[grain]
    interval = F.date_trunc(grain, "event_ts").alias(time_column)
    per_chatter = joined.groupBy(interval, "channel", "chatter_id").agg(*_sums(sign))
    named = per_chatter.join(numbers, "chatter_id", "left")
    bucket = F.coalesce(F.bitmap_bucket_number("number"), F.lit(0).cast("bigint")).alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("chatters")
    totals = [c for c in per_chatter.columns if c not in (time_column, "channel", "chatter_id")]
    summed = named.groupBy(time_column, "channel", bucket).agg(*[F.sum(c).alias(c) for c in totals], bits)
    return _typed(summed).withColumn(DAY, F.to_date(time_column))


def _typed(state: DataFrame) -> DataFrame:
    """One width for sums, however often they were added up."""
    width = {c: F.col(c).cast("decimal(38,15)") for c, kind in state.dtypes if kind.startswith("decimal")}
    return state.withColumns(width) if width else state


def merge(state: DataFrame, time_column: str) -> DataFrame:
    """One row per interval, channel and bucket."""
    keys = [DAY, time_column, "channel", "bucket"]
    totals = [c for c in state.columns if c not in (*keys, "chatters")]
    merged = state.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in totals], F.bitmap_or_agg("chatters").alias("chatters"))
    return _typed(merged).select(*state.columns)


def rollup(state: DataFrame, grain: str) -> DataFrame:
    """The engagement roll-up a state stands for; intervals that lost all their messages are gone."""
    time_column, _ = GRAIN_COLUMNS[grain]
    total = lambda c: F.sum(c)
    mean = lambda top, n: F.try_divide(F.sum(top).cast("double"), F.sum(n).cast("double"))
    measures = [
        total("n").alias("total_messages"),
        F.sum(F.bitmap_count("chatters")).alias("unique_chatters"),
        total("token_count_n").alias("feature_enriched_message_count"),
    ]
    measures += [mean(f"{c}_total", f"{c}_n").alias(f"avg_{c}") for c in MEANS]
    measures += [F.when(total(f"{c}_n") > 0, total(f"{c}_total")).alias(f"{c}_sum") for c in TOTALS]
    for flag, name in FLAGS.items():
        measures += [total(f"{flag}_true").alias(f"{name}_count"), mean(f"{flag}_true", f"{flag}_n").alias(f"{name}_rate")]
    return state.groupBy(time_column, "channel").agg(*measures).where("total_messages > 0")


def read_state(spark: SparkSession, path: str, days: list[date] | None = None) -> DataFrame | None:
    """The state of some days, or of all; None where there is none. Only folders of these days are opened."""
    _, document = manifest.newest(spark, f"{path}_manifest")
    wanted = None if days is None else {d.isoformat() for d in days}
    folders = [f"{path}/{VERSION}={v}/{DAY}={d}" for d, v in document.get("days", {}).items() if wanted is None or d in wanted]
    if not folders:
        return None
    schema = StructType.fromJson(document["schema"])
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def moved_days(old: DataFrame, new: DataFrame, grain: str) -> list[date]:
    """Days of events whose interval, channel or chatter differs between their versions."""
    place = [F.date_trunc(grain, "event_ts").alias("at"), "channel", "chatter_id"]
    before = old.select("event_id", F.struct(*place).alias("old"))
    both = before.join(new.select("event_id", F.struct(*place).alias("new")), "event_id").where(~F.col("old").eqNullSafe(F.col("new")))
    days = both.select(F.explode(F.array(F.to_date("old.at"), F.to_date("new.at"))).alias("day")).distinct()
    return sorted(r["day"] for r in days.collect())


def fold(
    spark: SparkSession,
    path: str,
    grain: str,
    new: DataFrame,
    source: str,
    batch_id: int,
    old: DataFrame | None = None,
    rows_of: Callable[[list[date]], DataFrame] | None = None,
) -> list[date]:
    """Fold joined rows into the state at ``path``; returns the days it touched, none for a repeated batch.

    ``old`` has the versions that rows of ``new`` replace, ``rows_of`` gives all present rows of days
    that have to be built anew. What comes to the driver are days.
    """
    time_column, _ = GRAIN_COLUMNS[grain]
    number, document = manifest.newest(spark, f"{path}_manifest")
    if document.get("applied", {}).get(source, -1) >= batch_id:
        return []
    anew = moved_days(old, new, grain) if old is not None else []
    if anew and rows_of is None:
        raise ValueError(f"events moved on {', '.join(map(str, anew))}; give rows_of to build these days anew")
    rows = [(new, 1)] + ([(old, -1)] if old is not None else []) + ([(rows_of(anew), 0)] if anew else [])
    chatters = rows[0][0].select("chatter_id")
    for more, _ in rows[1:]:
        chatters = chatters.unionByName(more.select("chatter_id"))
    numbers = _chatter_numbers(spark, f"{path}_chatters", number + 1, chatters)
    delta = contributions(new, numbers, grain)
    if old is not None:
        delta = delta.unionByName(contributions(old, numbers, grain, -1))
    if anew:
        rebuilt = contributions(rows_of(anew), numbers, grain)
        delta = delta.where(~F.col(DAY).isin(anew)).unionByName(rebuilt)
    pending = f"{path}_pending/{source}-{batch_id}"
    delta.write.mode("overwrite").parquet(pending)
    delta = spark.read.schema(delta.schema).parquet(pending)
    days = sorted({r[DAY] for r in delta.select(DAY).distinct().collect()} | set(anew))
    known = read_state(spark, path, [d for d in days if d not in anew])
    merged = merge(delta if known is None else known.unionByName(delta), time_column)
    merged.write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/{VERSION}={number + 1}")
    written = {r[DAY].isoformat() for r in spark.read.schema(delta.schema).parquet(f"{path}/{VERSION}={number + 1}").select(DAY).distinct().collect()}
    kept = {d: v for d, v in document.get("days", {}).items() if d not in {x.isoformat() for x in days}}
    manifest.commit(
        spark, f"{path}_manifest", number + 1,
        {
            "schema": document.get("schema") or delta.schema.jsonValue(),
            "days": kept | dict.fromkeys(sorted(written), number + 1),
            "applied": {**document.get("applied", {}), source: batch_id},
        },
    )
    fs, where = manifest.file_system(spark, pending)
    fs.delete(where, True)
    return days
