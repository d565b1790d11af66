"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` points of a hash ring. Rows have a point from a hash of their id and text
and arrive in the order of a second one; each goes clockwise from its own point to the first shard that is not full. A shard is
full once it holds its bounded share of all bytes, so loads are near equal, and a row moves only
if its arc changed owner or a shard on its way filled up earlier or later.

The walk is a pure function of the times at which shards fill up, one number per shard. Bytes are
summed by arc and time bucket (a table whose size depends on the ring, not on the data), the
filling is replayed on these sums, the buckets in which a shard fills are summed again in finer
buckets, and then every row finds its shard on its own. Slots number the rows of a shard without
gaps: rows are ranked inside small ranges of the arrival order, and each range knows its offset. The
ring and the times are constants of the plan; rows stay in the JVM.

What a shard takes beyond its share, the others need not: their bound is the rest, shared by those that are
open. So one very large row, or many rows that are equal, fill one shard and leave the others equal.

Defined cases: a null text has no bytes and counts 1; null ids and texts hash like any value; rows that
share an id are spread by their texts; rows equal in both arrive together at one shard, each in a slot
of its own; other columns are
ignored, or carried as payload by ``shards_with_rows``, where input columns named shard or slot are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import json

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlens.llm.staging import stage

SHARDS = 16
VNODES = 16
SLACK = 0.0  # over an equal share; what full shards leave over would all fall to the last one
STEP_BITS = 7  # time buckets: 2^7 coarse ones of 2^7 fine ones each
STEPS = 1 << STEP_BITS
RANGE_BITS = 8
CELL_BITS = 12  # the ring is cut into so many equal cells; a row's point is the start of its cell


class Ring:
    """Sorted points, and for each arc the shards in clockwise order."""

    def __init__(self, shards: int, vnodes: int = VNODES) -> None:
        points = sorted((xxhash.xxh64_intdigest(f"{s}/{v}"), s) for s in range(shards) for v in range(vnodes))
        self.shards = shards
        self.points = np.array([p for p, _ in points], dtype=np.uint64)
        owners = [s for _, s in points]
        around = [list(dict.fromkeys(owners[k:] + owners[:k])) for k in range(len(owners))]
        self.order = np.array(around)
        cells = np.arange(1 << CELL_BITS, dtype=np.uint64) << np.uint64(64 - CELL_BITS)
        self.arc_of_cell = np.searchsorted(self.points, cells) % len(self.points)


def fill_times(ring: Ring, begin: np.ndarray, end: np.ndarray, sums: np.ndarray, capacity: float) -> np.ndarray:
    """When each shard is full, given bytes by time bucket [begin, end) and arc; the last one never is.

    ``capacity`` is the bound while all are open; what closed ones hold too much or too little changes the others'.
    """
    total, slack = sums.sum(), capacity * ring.shards / max(sums.sum(), 1e-9)
    full = np.full(ring.shards, np.iinfo(np.int64).max)
    load = np.zeros(ring.shards)
    still = np.ones(ring.shards, dtype=bool)
    arcs = np.arange(len(ring.order))

    def close(over: np.ndarray, time: int) -> None:
        if over.sum() == still.sum():
            over[np.flatnonzero(over)[np.argmin(load[over])]] = False
        full[over] = time
        still[over] = False

    def bound() -> float:
        return slack * (total - load[~still].sum()) / max(still.sum(), 1)

    for k in np.argsort(begin, kind="stable"):
        while True:  # a shard is full before the bucket if that is nearer to its bound, unless it is too large for any
            capacity = bound()
            first = ring.order[arcs, np.argmax(still[ring.order], axis=1)]
            after = load + np.bincount(first, weights=sums[k], minlength=ring.shards)
            early = still & (after > load) & (after - capacity > capacity - load) & (after - load <= capacity)
            open_ = still.sum()
            close(early, begin[k])
            if still.sum() == open_:
                break
        load = after
        close(still & (load >= bound()), end[k])
    return full


def _times(rows: DataFrame, ring: Ring, slack: float) -> np.ndarray:
    """Replay the filling on sums, refining the coarse buckets in which a shard fills until none is new."""
    by_arc = rows.groupBy("arc", "coarse").agg(F.sum("size").cast("double").alias("n")).toPandas()
    arcs = len(ring.points)
    coarse = np.zeros((STEPS, arcs))
    coarse[by_arc["coarse"].to_numpy(int), by_arc["arc"].to_numpy(int)] = by_arc["n"].to_numpy(float)
    capacity = coarse.sum() / ring.shards * (1 + slack)
    fine: dict[int, np.ndarray] = {}
    while True:
        begin, end, sums = [], [], []
        for c in range(STEPS):
            if c in fine:
                begin += range(c * STEPS, (c + 1) * STEPS)
                end += range(c * STEPS + 1, (c + 1) * STEPS + 1)
                sums.append(fine[c])
            else:
                begin.append(c * STEPS)
                end.append((c + 1) * STEPS)
                sums.append(coarse[c : c + 1])
        full = fill_times(ring, np.array(begin), np.array(end), np.concatenate(sums), capacity)
        events = {int(x) // STEPS for t in full if t <= STEPS * STEPS for x in (t - 1, t)}
        new = sorted((events & set(range(STEPS))) - set(fine))
        if not new:
            return full
        found = (
            rows.where(F.col("coarse").isin(new)).groupBy("arc", "coarse", "fine").agg(F.sum("size").cast("double").alias("n")).toPandas()
        )
        for c in new:
            part, table = found[found["coarse"] == c], np.zeros((STEPS, arcs))
            table[part["fine"].to_numpy(int), part["arc"].to_numpy(int)] = part["n"].to_numpy(float)
            fine[c] = table


def _constant(values: np.ndarray, kind: str) -> Column:
    """A table of the plan; it is folded to one literal."""
    return F.from_json(F.lit(json.dumps(values.tolist())), kind)


def _keyed(docs: DataFrame, ring: Ring, **carried: Column) -> DataFrame:
    point = F.xxhash64(docs["doc_id"], docs["text"], F.lit("ring"))
    arrival = F.xxhash64(docs["doc_id"], docs["text"], F.lit("arrival"))
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        docs["doc_id"].alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.get(_constant(ring.arc_of_cell, "array<int>"), F.shiftrightunsigned(point, 64 - CELL_BITS).cast("int")).alias("arc"),
        arrival.alias("arrival"),
        F.shiftrightunsigned(arrival, 64 - STEP_BITS).cast("int").alias("coarse"),
        F.shiftrightunsigned(arrival, 64 - 2 * STEP_BITS).bitwiseAND(STEPS - 1).cast("int").alias("fine"),
        *[column.alias(name) for name, column in carried.items()],
    )


def _placed(keyed: DataFrame, ring: Ring, full: np.ndarray) -> DataFrame:
    """Add ``shard``: the first one clockwise that is not full at the row's time."""
    clockwise = F.get(_constant(ring.order, "array<array<int>>"), F.col("arc"))
    at = F.col("coarse").cast("long") * STEPS + F.col("fine")
    times = _constant(full, "array<bigint>")
    return keyed.withColumn("shard", F.get(F.filter(clockwise, lambda s: F.get(times, s) > at), F.lit(0)))


def _slots(placed: DataFrame) -> DataFrame:
    """Add ``slot``: rank inside a range of arrivals plus the rows of the shard's earlier ranges."""
    ranged = placed.withColumn("_range", F.shiftrightunsigned("arrival", 64 - RANGE_BITS).cast("int"))
    counts = ranged.groupBy("shard", "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("shard", "_range").orderBy("arrival", "doc_id", "text_crc32", "size")
    ranked = ranged.withColumn("_rank", F.row_number().over(inside).cast("long") - 1)
    return ranked.join(stage(offsets), ["shard", "_range"]).withColumn("slot", F.col("_offset") + F.col("_rank"))


def shards(docs: DataFrame, n: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row."""
    ring = Ring(n)
    keyed = stage(_keyed(docs, ring))
    placed = stage(_placed(keyed, ring, _times(keyed, ring, slack)).drop("arc", "coarse", "fine"))
    return _slots(placed).select("doc_id", "size", "text_crc32", "shard", "slot")


def shards_with_rows(docs: DataFrame, n: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """The rows themselves with their shard and slot. Texts are read twice and shuffled once."""
    ring = Ring(n)
    full = _times(stage(_keyed(docs, ring).select("arc", "coarse", "fine", "size")), ring, slack)
    row = F.struct(*[docs[c] for c in docs.columns if c.lower() not in ("shard", "slot")])
    placed = _placed(_keyed(docs, ring, _row=row), ring, full)
    return _slots(placed).select("_row.*", "shard", "slot")
