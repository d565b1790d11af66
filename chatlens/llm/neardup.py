"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64 bits; two link when at most ``budget`` bits differ. A trie over all of them
would compare almost every pair of nodes before the errors add up, so the join starts below bits
that agree, taken from the pigeonhole principle: the bits are cut into ``budget + 2`` blocks, two
linked fingerprints agree on at least two of them, and for each choice of two blocks the
fingerprints with the same bits there form one trie. Each trie is joined with
itself: pairs of nodes descend together, bits that differ add up, and a pair is dropped once it is
over budget, empty, or wholly in one known component. Only links that join components are kept, a
spanning forest, so no link is lost and dense groups don't multiply.

Tries with more than ``UNIT`` fingerprints are dealt over salts, and each pair of salts is joined
on its own, so no task holds more than two salts of a hot trie. Copies share a fingerprint and
take part once. Components come from the links by contraction; nothing is gathered on the driver.

Defined cases: null, empty and blank texts have no words and fingerprint zero, which links like any
other; null ids never name a component (it is null when all its ids are); repeated rows are
returned as often as they occur; other columns are ignored, and ``keep_one`` keeps them all; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlens.llm.components import components
from chatlens.llm.staging import scratch, stage

SEED = 42
BITS = 64
UNIT = 4096
FRONTIER = 1 << 18
HASHES = 1 << 16
BATCH = 1 << 17
LOOK = 64  # hot tries are looked for among one in so many fingerprints; salting changes no result


def shingle_hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a text, repeats included, in pieces of bounded size.

    Bytes split and lower-case exactly as the contract says: at ASCII white space, A to Z only.
    """
    words = (text or "").encode().lower().split()
    n = max(min(len(words), 1), len(words) - size + 1)
    shingles = zip(*(words[k:] for k in range(size))) if len(words) >= size else iter([tuple(words)])
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, n, HASHES):
        count = min(HASHES, n - start)
        yield np.fromiter((digest(join(next(shingles)), SEED) for _ in range(count)), dtype="<u8", count=count)


def simhash(text: str | None, size: int) -> int:
    """Majority bits of the shingle hashes as a signed 64-bit integer."""
    return _majority(shingle_hashes(text, size))


def _majority(pieces: Iterable[np.ndarray]) -> int:
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in pieces:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, size: int = 4) -> Column:
    """The fingerprint of a text column as a long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, size) for t in texts], dtype="int64")

    return of(text)


class _Forest:
    """Smallest-member labels of the linked values of one batch."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = self.label[self.label]
                if (jumped == self.label).all():
                    break
                self.label = jumped

    def changes(self) -> np.ndarray:
        """Running count of label changes: a range has one label if the count is equal at its ends."""
        return np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])


def trie_links(unit: np.ndarray, values: np.ndarray, budget: int) -> np.ndarray:
    """Self-join of the tries of values sorted by unit and value.

    Returns the position of the smallest value that each one is connected with by links of at most ``budget`` bits.
    A trie node is a range of the sorted values. Pairs of nodes of the same unit start at its root.
    """
    n = len(values)
    forest = _Forest(n)
    for turn in range(0, BITS, 16):  # neighbours in a few orders join dense groups before any pair is tried
        turned = values if not turn else (values << np.uint64(turn)) | (values >> np.uint64(BITS - turn))
        order = np.lexsort((turned, unit))
        i, j = order[:-1], order[1:]
        near = (unit[i] == unit[j]) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        forest.link(i[near], j[near])
    start = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    end = np.append(start[1:], n)
    several = end - start > 1
    start, end = start[several], end[several]
    ones: dict[int, np.ndarray] = {}
    stack = [(BITS - 1, start, end, start, end, np.zeros(len(start), dtype=np.int64))]
    while stack:
        bit, lo1, hi1, lo2, hi2, err = stack.pop()
        same = lo1 == lo2
        changes = forest.changes()
        whole = (changes[hi1 - 1] == changes[lo1]) & (changes[hi2 - 1] == changes[lo2])
        open_ = ~(whole & (forest.label[lo1] == forest.label[lo2]))
        two = same & (hi1 - lo1 == 2)
        leaf = open_ & (two | (~same & (hi1 - lo1 == 1) & (hi2 - lo2 == 1)))
        i, j = lo1[leaf], lo2[leaf] + two[leaf]
        near = np.bitwise_count(values[i] ^ values[j]) <= budget
        forest.link(i[near], j[near])
        down = open_ & ~leaf
        lo1, hi1, lo2, hi2, err, same = (x[down] for x in (lo1, hi1, lo2, hi2, err, same))
        if not len(lo1) or bit < 0:
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        count = ones[bit]
        mid1, mid2 = hi1 - (count[hi1] - count[lo1]), hi2 - (count[hi2] - count[lo2])
        parts = (
            (lo1, mid1, lo2, mid2, err, same & (mid1 - lo1 == 1)),
            (mid1, hi1, mid2, hi2, err, same & (hi1 - mid1 == 1)),
            (lo1, mid1, mid2, hi2, err + 1, False),
            (mid1, hi1, lo2, mid2, err + 1, same),
        )
        kept = []
        for a, b, c, d, e, useless in parts:
            ok = (a < b) & (c < d) & (e <= budget) & ~np.asarray(useless)
            kept.append([x[ok] for x in (a, b, c, d, e)])
        children = [np.concatenate(x) for x in zip(*kept)]
        for at in range(0, len(children[0]), FRONTIER):
            stack.append((bit - 1, *(x[at : at + FRONTIER] for x in children)))
    return forest.label


def _joined(budget: int):
    """Batches sorted by unit -> links; the unit that a batch ends in waits for the next batch."""

    def links_of(frame: pd.DataFrame) -> pa.RecordBatch:
        values = frame["fp"].to_numpy().view(np.uint64)
        unit = frame.groupby(["unit", "key"], sort=False).ngroup().to_numpy()
        order = np.lexsort((values, unit))
        values, unit = values[order], unit[order]
        label = trie_links(unit, values, budget)
        moved = np.flatnonzero(label != np.arange(len(label)))
        signed = values.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            waiting.append(batch.to_pandas())
            if sum(map(len, waiting)) < BATCH:
                continue
            frame = pd.concat(waiting, ignore_index=True)
            last = ((frame["unit"] == frame["unit"].iloc[-1]) & (frame["key"] == frame["key"].iloc[-1])).to_numpy()
            waiting = [frame[last]]
            if not last.all():
                yield links_of(frame[~last].reset_index(drop=True))
        if sum(map(len, waiting)):
            yield links_of(pd.concat(waiting, ignore_index=True))

    return run


def block_masks(budget: int) -> list[int]:
    """Two of ``budget + 2`` blocks of bits, in every choice: pairs within budget agree on one of these."""
    blocks = budget + 2
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [x | y for x, y in combinations(masks, 2)]


def hamming_links(distinct: DataFrame, budget: int) -> DataFrame:
    """Distinct ``fp`` -> links (a, b) that connect all fingerprints within ``budget`` bits."""
    masks = block_masks(budget)
    signed = [F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("long") for m in masks]

    def keyed(rows: DataFrame) -> DataFrame:
        keys = [F.struct(F.lit(r).cast("long").alias("r"), F.col("fp").bitwiseAND(m).alias("key")) for r, m in enumerate(signed)]
        return rows.select("fp", F.inline(F.array(*keys)))

    look = max(1, min(LOOK, UNIT // LOOK))
    sizes = keyed(distinct.where(F.pmod(F.xxhash64("fp", F.lit("look")), F.lit(look)) == 0)).groupBy("r", "key").agg((F.count("*") * look).alias("n"))
    hot = stage(sizes.where(F.col("n") > UNIT // 2).select("r", "key", F.ceil(F.col("n") * 2 / UNIT).cast("int").alias("salts")))
    dealt = keyed(distinct).join(hot, ["r", "key"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("salts") - 1), lambda s: s != own)
    pairs = F.transform(others, lambda s: F.shiftleft(F.least(s, own).cast("long"), 20) + F.greatest(s, own))
    alone = F.array(F.lit(0).cast("long"))
    several = F.col("salts") > 1
    salted = dealt.select("r", "fp", F.explode(F.when(several, pairs).otherwise(alone)).alias("s"))
    # the key follows from the table and the fingerprint, so it doesn't travel
    key = F.col("fp").bitwiseAND(F.element_at(F.array(*signed), (F.shiftright("unit", 40) + 1).cast("int")))
    units = salted.select((F.shiftleft("r", 40) + F.col("s")).alias("unit"), "fp").repartition("unit", key)
    sorted_units = units.select("unit", key.alias("key"), "fp").sortWithinPartitions("unit", "key")
    return sorted_units.mapInArrow(_joined(budget), "a long, b long")


def clusters(prints: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, fp) and links of fingerprints -> one row per distinct fp.

    fp, component (its smallest fp), component_id (the smallest id of the component), first_id (of the fp).
    """
    with scratch(prints.sparkSession):
        distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
        roots = components(links)
        rooted = stage(
            distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
                "fp", "first_id", F.coalesce("root", "fp").alias("component")
            )
        )
        firsts = stage(rooted.groupBy("component").agg(F.min("first_id").alias("component_id")))
        return stage(rooted.join(firsts, "component").select("fp", "component", "component_id", "first_id"), keep=True)


def near_duplicates(docs: DataFrame, size: int = 4, budget: int = 4) -> DataFrame:
    """doc_id, fp, component_id: the smallest id reachable over links, one row per document."""
    with scratch(docs.sparkSession):
        prints = stage(docs.select(docs["doc_id"], fingerprint(docs["text"], size).alias("fp")), keep=True)
        links = hamming_links(stage(prints.select("fp").distinct()), budget)
        found = stage(clusters(prints, links).select(F.col("fp").alias("_fp"), "component_id"), keep=True)
    return prints.join(found, prints["fp"] == found["_fp"]).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, size: int = 4, budget: int = 4) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Fingerprints travel with a hash of id and text; the texts are shuffled once, by that hash, each
    task sending one of equal rows. Of rows with the smallest id, the one with the smallest hash stays.
    """
    key, number = F.xxhash64(docs["doc_id"], docs["text"]), F.coalesce(docs["doc_id"].cast("long"), F.lit(0).cast("long"))
    with scratch(docs.sparkSession):
        prints = docs.select(docs["doc_id"], key.alias("key"), number.alias("number"), fingerprint(docs["text"], size).alias("fp"))
        prints = stage(prints)
        links = hamming_links(stage(prints.select("fp").distinct()), budget)
        found = clusters(prints, links)
        order = F.struct(F.col("first_id").isNull(), "first_id", "fp")
        chosen = found.groupBy("component").agg(F.min_by("fp", order).alias("fp")).select("fp")
        row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "number", "key")
        keepers = prints.join(chosen, "fp", "left_semi").groupBy("fp").agg(F.min(row).alias("row"))
        keepers = stage(keepers.select(F.col("row.key").alias("_key"), F.col("row.number").alias("_number")), keep=True)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), key.alias("_key"), number.alias("_number"))
    same = Window.partitionBy("_key", "_number").orderBy("_key")
    firsts = rows.withColumn("_rank", F.row_number().over(same)).where("_rank = 1")
    return firsts.join(keepers, ["_key", "_number"], "left_semi").select("_row.*")
