"""Mixing sources to target weights with nested hash thresholds.

Every document has a fixed hash, of its id and text. Of a source whose target is r times its size, each document is
taken floor(r) times, and once more when its hash lies below the source's threshold, so a larger
target only adds documents. The threshold comes from sums by source and hash bucket: the first
bucket whose running sum passes the budget is the boundary, only its rows are counted again in
finer buckets, and the final filter compares hashes. Documents are never sorted, and a hot source
is summed where it lies.

Defined cases: a null or empty text has size 0; the null source is a source, ordered last; null
ids and texts hash like empty strings; rows that are equal in both share a hash and are taken together,
while rows that only share an id, or have none, are taken one by one; an empty table gives an empty mix; other columns are ignored. Reruns give the same rows: nothing is random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlens.llm.staging import stage
from chatlens.llm.text import words

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BUCKET_BITS = 12
LEVELS = 2
HASH_BITS = BUCKET_BITS * LEVELS


def row_hash(docs: DataFrame) -> Column:
    """The leading 24 bits of an MD5 digest of id and text, which any SQL engine can compute."""
    parts = [F.coalesce(docs[c].cast("string"), F.lit("")) for c in ("doc_id", "text")]
    digest = F.md5(F.concat(parts[0], F.lit(":"), parts[1]).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size -> plus target: all sizes shared by weight, at most three times a source.

    What a full source leaves is shared again. In order of room per weight the full sources come
    first, so running sums give the level of each candidate split, and the first source that stays
    below its limit has the final level. One row per source: the only global order in the operator.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), position).cast("long")
    limit = F.col("source_size") * MAX_REPEATS
    room = limit.cast("double") / F.col("weight")
    rows = sizes.withColumn("weight", weight).withColumn("limit", limit).withColumn("room", room)
    everything = Window.partitionBy()
    before = Window.orderBy("room", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left.cast("double") / weight_left.cast("double"))
    final = F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", F.col("source").isNull(), "source", "level")))
    rows = rows.withColumn("final", final.over(everything)["level"])
    target = F.least(F.col("limit").cast("double"), F.col("final") * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _boundary(sums: DataFrame, key: list[str], budget: Column) -> DataFrame:
    """The first bucket of each key whose running sum passes the budget, and the sum before it."""
    order = Window.partitionBy(*key).orderBy("bucket")
    running = sums.withColumn("upto", F.sum("n").over(order))
    passed = running.where(F.col("upto").cast("double") > budget)
    first = F.min(F.struct("bucket", "upto", "n"))
    return passed.groupBy(*key).agg(first.alias("b")).select(
        *key, F.col("b.bucket").alias("bucket"), (F.col("b.upto") - F.col("b.n")).alias("before"), F.col("b.n").alias("n")
    )


def _plan(sized: DataFrame) -> DataFrame:
    """source, source_size, target, whole, threshold, from rows of source, size and hash."""
    top = F.shiftright("hash", HASH_BITS - BUCKET_BITS)
    coarse = stage(sized.groupBy("source", top.alias("bucket")).agg(F.sum("size").alias("n")))
    sizes = coarse.groupBy("source").agg(F.sum("n").alias("source_size"))
    ratio = F.floor(F.try_divide("target", F.col("source_size").cast("double")))
    targets = source_targets(sizes).withColumn("whole", F.coalesce(ratio, F.lit(0)))
    budget = F.col("target") - F.col("whole") * F.col("source_size")
    targets = stage(targets.withColumn("budget", budget.cast("double")).withColumn("id", F.monotonically_increasing_id()))

    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    counted = coarse.join(targets.select("source", "id", "budget"), same(coarse, targets)).drop("source")
    first = stage(_boundary(counted, ["id", "budget"], F.col("budget")).withColumnRenamed("bucket", "at").drop("n"))
    known = targets.select("source", "id").join(first, "id")
    inside = sized.join(known, same(sized, known) & (top == known["at"])).drop("source")
    fine_bucket = F.col("hash").bitwiseAND((1 << (HASH_BITS - BUCKET_BITS)) - 1)
    fine = inside.groupBy("id", "at", "before", "budget", fine_bucket.alias("bucket")).agg(F.sum("size").alias("n"))
    rest = fine.withColumn("rest", F.col("budget") - F.col("before")).drop("before", "budget")
    edge = _boundary(rest, ["id", "at", "rest"], F.col("rest"))
    # the boundary bucket itself is taken when that ends nearer to the budget
    under = F.col("rest") - F.col("before")
    nearer = (F.col("before") + F.col("n")).cast("double") - F.col("rest") < under
    threshold = F.shiftleft("at", HASH_BITS - BUCKET_BITS) + F.col("bucket") + F.when(nearer, 1).otherwise(0)
    thresholds = edge.select("id", threshold.alias("threshold"))
    plan = targets.join(thresholds, "id", "left")
    return stage(plan.select("source", "source_size", "target", "whole", F.coalesce("threshold", F.lit(1 << HASH_BITS)).alias("threshold")))


def _sized(docs: DataFrame, **carried: Column) -> DataFrame:
    return docs.select(
        docs["source"].alias("source"), F.size(words(docs["text"])).cast("long").alias("size"), row_hash(docs).alias("hash"),
        *[column.alias(name) for name, column in carried.items()],
    )


def _times(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``times``: how often each row is taken."""
    named = plan.withColumnRenamed("source", "_source")
    extra = F.when((F.col("hash") < F.col("threshold")) & (F.col("whole") < MAX_REPEATS), 1).otherwise(0)
    return rows.join(named, rows["source"].eqNullSafe(named["_source"])).withColumn("times", (F.col("whole") + extra).cast("long"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, times: what the mix takes of every document."""
    sized = stage(_sized(docs, doc_id=docs["doc_id"]))
    taken = (F.col("size") * F.col("times")).alias("taken")
    return _times(sized, _plan(sized)).select("doc_id", "size", "source_size", "target", taken, "times")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, with all its columns."""
    plan = _plan(stage(_sized(docs)))
    row = F.struct(*[docs[c] for c in docs.columns])
    packed = docs.select(row.alias("_row"), docs["source"].alias("source"), row_hash(docs).alias("hash"))
    taken = _times(packed, plan).where("times > 0")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("_k")).select("_row.*")
