from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from chatlens.llm import sharding
from tests.llm.tables import awkward, documents, nothing


def check(rows, docs) -> dict[int, int]:
    """Sizes, checksums and slots of a placement; bytes by shard."""
    texts = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == texts
    slots, load = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    for used in slots.values():
        assert sorted(used) == list(range(len(used)))
    return load


def test_placement_is_the_sequential_walk(spark):
    """The fill times give what walking the ring row by row gives, up to one time bucket."""
    rows = [(i, "x" * (i % 90 + 10), "en", "a", 1) for i in range(4000)]
    docs = documents(spark, rows)
    placed = sharding.shards(docs).collect()
    load = check(placed, docs.collect())
    mean = sum(load.values()) / sharding.SHARDS
    assert set(load) == set(range(16))
    assert max(load.values()) <= mean * (1 + sharding.SLACK) + 2000
    assert min(load.values()) >= mean * 0.9

    ring = sharding.Ring(16)
    keyed = sharding._keyed(docs, ring).collect()
    held, walked = Counter(), {}
    for r in sorted(keyed, key=lambda r: (r["coarse"], r["fine"], r["arrival"] & ((1 << 50) - 1))):
        shard = next(s for s in ring.order[r["arc"]] if held[s] < mean * (1 + sharding.SLACK))
        held[shard] += r["size"]
        walked[r["doc_id"]] = int(shard)
    moved = sum(1 for r in placed if walked[r["doc_id"]] != r["shard"])
    assert moved <= len(rows) * 0.03


@pytest.mark.parametrize("hot", [None, 7])
def test_one_id_with_a_third_of_all_rows(spark, hot):
    """Texts spread rows that share an id; every shard is within the largest row of the mean."""
    rows = [(hot if i % 3 == 0 else i, f"text {i} " + "x" * (i % 90), "en", "a", 1) for i in range(3000)]
    docs = documents(spark, rows)
    load = check(sharding.shards(docs).collect(), docs.collect())
    mean = sum(load.values()) / sharding.SHARDS
    assert len(load) == 16 and max(abs(n - mean) for n in load.values()) <= 101


def test_equal_rows_fill_one_shard_and_leave_the_others_equal(spark):
    rows = [(None if i % 3 == 0 else i, "same text" if i % 3 == 0 else f"text {i}", "en", "a", 1) for i in range(3000)]
    docs = documents(spark, rows)
    load = sorted(check(sharding.shards(docs).collect(), docs.collect()).values())
    assert len(load) == 16 and load[-1] >= 10_000
    assert load[-2] <= 1.4 * load[0]


def test_growth_moves_little(spark):
    docs = documents(spark, [(i, "x" * (i % 90 + 10), "en", "a", 1) for i in range(4000)])
    before = {r["doc_id"]: r["shard"] for r in sharding.shards(docs, 16).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.shards(docs, 17).collect()}
    assert sum(1 for k in before if before[k] != after[k]) < 0.4 * len(before)


def test_fill_times_keep_the_last_shard_open():
    ring = sharding.Ring(4, 2)
    sums = np.full((10, 8), 5.0)
    full = sharding.fill_times(ring, np.arange(10), np.arange(1, 11), sums, 1.0)
    assert (full == np.iinfo(np.int64).max).sum() == 1


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(sharding.shards(docs).collect(), docs.collect())
    rows = sharding.shards_with_rows(docs)
    assert rows.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    narrow = Counter((r["shard"], r["slot"]) for r in sharding.shards(docs).collect())
    assert Counter((r["shard"], r["slot"]) for r in rows.collect()) == narrow


def test_empty_table(spark):
    assert sharding.shards(nothing(spark)).count() == 0
    assert sharding.shards_with_rows(nothing(spark)).count() == 0
