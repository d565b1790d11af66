from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from chatlens.llm import neardup, staging
from chatlens.llm.components import components
from tests.llm.tables import awkward, documents, nothing


def slow_simhash(text: str | None, size: int) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def groups(prints: list[tuple], budget: int) -> dict:
    """Brute force: every pair of fingerprints, then union-find; smallest id by fingerprint."""
    values = sorted({fp for _, fp in prints})
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    array = np.array(values, dtype=np.int64).view(np.uint64)
    for k, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array[k] ^ array[:k]) <= budget):
            a, b = find(v), find(values[j])
            parent[max(a, b)] = min(a, b)
    smallest: dict = {}
    for doc, fp in prints:
        root = find(fp)
        if doc is not None:
            smallest[root] = min(doc, smallest.get(root, doc))
    return {v: smallest.get(find(v)) for v in values}


@pytest.mark.parametrize("table", ["sf", "awkward"])
def test_query_matches_brute_force(spark, sf, table):
    docs = awkward(spark) if table == "awkward" else spark.read.parquet(f"{sf}/documents.parquet")
    prints = [(r["doc_id"], slow_simhash(r["text"], 4)) for r in docs.select("doc_id", "text").collect()]
    reached = groups(prints, 4)
    key = lambda r: (str(r[0]), r[1])
    expected = sorted(((d, fp, reached[fp]) for d, fp in prints), key=key)
    found = sorted((tuple(r) for r in neardup.near_duplicates(docs).collect()), key=key)
    assert found == expected


def clustered(seed: int, centres: int, members: int, flips: int) -> list[int]:
    rng = np.random.default_rng(seed)
    values = []
    for centre in rng.integers(0, 1 << 63, centres):
        for _ in range(members):
            bits = rng.choice(64, rng.integers(0, flips + 1), replace=False)
            value = int(centre) ^ sum(1 << int(b) for b in bits)
            values.append(value - (1 << 64) if value >> 63 else value)
    return values


@pytest.mark.parametrize("unit", [4096, 16])
@pytest.mark.parametrize("budget", [0, 2, 4])
def test_trie_join_finds_every_link(spark, monkeypatch, unit, budget):
    """Also with tiny units, so that most tries are dealt over salts."""
    monkeypatch.setattr(neardup, "UNIT", unit)
    monkeypatch.setattr(neardup, "FRONTIER", 64)
    values = clustered(budget, 12, 40, 6) + clustered(9, 300, 1, 0) + [0, -1, 1, 1 << 62]
    prints = [(k, v) for k, v in enumerate(values)]
    df = spark.createDataFrame(prints, "doc_id long, fp long")
    links = neardup.hamming_links(df.select("fp").distinct(), budget)
    found = {r["fp"]: r["component_id"] for r in neardup.clusters(df, links).collect()}
    assert found == groups(prints, budget)


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(200, k) for k in range(100, 150)] + [(7, 7), (300, 301), (301, 300), (None, 4)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 150)} | {200: 100, 300: 300, 301: 300}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("table", ["sf", "awkward"])
def test_one_document_of_each_group_stays(spark, sf, table):
    docs = awkward(spark) if table == "awkward" else spark.read.parquet(f"{sf}/documents.parquet")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    given, rows = docs.collect(), kept.collect()
    prints = [(r["doc_id"], slow_simhash(r["text"], 4)) for r in given]
    reached = groups(prints, 4)
    assert len(rows) == len({(reached[fp], fp if reached[fp] is None else 0) for _, fp in prints})
    assert {r["doc_id"] for r in rows} == set(reached.values())
    assert all(r in given for r in rows)


def test_rows_of_one_id_and_rows_without(spark):
    """Texts that share an id, or have none, are told apart by the text; equal rows count once."""
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "red blue green white black pink"]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (None, texts[2]), (None, texts[2]), (9, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r[0]), r[1]) for r in neardup.keep_one(docs).collect()) == [("7", texts[0]), ("7", texts[1]), ("None", texts[2])]


def test_empty_table(spark):
    assert neardup.near_duplicates(nothing(spark)).count() == 0
    assert neardup.keep_one(nothing(spark)).count() == 0


def test_copies_and_near_copies_collapse(spark):
    words = [f"w{i * i % 997}x{i}" for i in range(4000)]
    near = words[:200] + ["changed"] + words[201:]
    other = [f"q{i * 7 % 991}y{i}" for i in range(400)]
    rows = [(k, " ".join(w), "en", "a", 1) for k, w in enumerate([words, words, near, other])]
    assert sorted(r["doc_id"] for r in neardup.keep_one(documents(spark, rows)).collect()) == [0, 3]


def test_only_what_the_result_reads_is_left(spark, tmp_path, monkeypatch):
    """The tables between the steps are gone before the result is read."""
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path))
    for result, left in ((neardup.near_duplicates, 2), (neardup.keep_one, 1)):
        before = len(list(tmp_path.iterdir()))
        assert result(awkward(spark)).count()
        assert len(list(tmp_path.iterdir())) == before + left
