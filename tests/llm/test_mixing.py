from __future__ import annotations

import pytest

from chatlens.llm import mixing
from tests.llm.tables import awkward, documents, nothing


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """The contract's sharing, round by round."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        share = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and share[s] > 3 * sizes[s]}
        if not over:
            return share
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 1, None: 7}, {"x": 5}, {"a": 0, "b": 9}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert found == pytest.approx(targets(sizes))


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (i % 7 + 1), "en", s, 1) for s, n in (("a", 3000), ("b", 300), ("c", 200)) for i in range(n)]
    mixed = mixing.mix(documents(spark, rows)).collect()
    assert len(mixed) == len(rows)
    by_source: dict[float, list] = {}
    for r in mixed:
        by_source.setdefault(r["target"], []).append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for target, members in by_source.items():
        assert abs(sum(r["taken"] for r in members) - target) <= 3 * 7


@pytest.mark.parametrize("hot", [None, 7])
def test_one_id_with_a_third_of_all_rows(spark, hot):
    """Rows that share an id are taken one by one, so every source is within one document of its target."""
    rows = [(hot if i % 3 == 0 else i, f"w{i} " * (i % 5 + 1), "en", "a" if i % 3 == 0 else "b", 1) for i in range(3000)]
    by_source: dict[float, int] = {}
    for r in mixing.mix(documents(spark, rows)).collect():
        by_source[r["target"]] = by_source.get(r["target"], 0) + r["taken"]
    assert len(by_source) == 2 and all(abs(taken - target) <= 5 for target, taken in by_source.items())


def test_rows_are_repeated_as_often_as_taken(spark):
    docs = awkward(spark)
    times = sorted((str(r["doc_id"]), r["times"]) for r in mixing.mix(docs).collect() if r["times"])
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    assert rows.count() == sum(t for _, t in times)
    assert {r["size"] for r in rows.collect()} == {"theirs"}


def test_larger_budget_only_adds(spark):
    rows = [(i, "w " * 5, "en", "abc"[i % 3], 1) for i in range(900)]
    less = {r["doc_id"]: r["times"] for r in mixing.mix(documents(spark, rows)).collect()}
    again = {r["doc_id"]: r["times"] for r in mixing.mix(documents(spark, rows[::-1])).collect()}
    assert less == again


def test_empty_table(spark):
    assert mixing.mix(nothing(spark)).count() == 0
    assert mixing.mixed_rows(nothing(spark)).count() == 0
