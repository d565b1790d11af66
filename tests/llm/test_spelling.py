from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from chatlens.llm import spelling
from chatlens.llm.catalog import NOISE, QUERIES
from tests.llm.tables import awkward, documents, nothing


def counted(rows: list[tuple], noise: int | None) -> dict[str, int]:
    counts: Counter[str] = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if noise and h % noise == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts: dict[str, int]) -> list[tuple]:
    """Every pair of words."""
    near = {w: [] for w in counts}
    words = sorted(counts)
    for k, a in enumerate(words):
        for b in words[:k]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def some_words(seed: int) -> list[tuple]:
    """Few letters, so that words are near in every way, equal neighbours included."""
    rng = random.Random(seed)
    made = []
    for _ in range(150):
        word = "".join(rng.choice("abbé") for _ in range(rng.randint(4, 9)))
        for _ in range(rng.randint(1, 6)):
            made += [word] * rng.randint(1, 9)
            k = rng.randrange(len(word))
            word = rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice("abÿZ") + word[k:], word[:k] + rng.choice("abç") + word[k + 1 :]])
    rng.shuffle(made)
    return [(k, " ".join(made[k::40]) + "-1,x", "en", "a", 1) for k in range(40)]


@pytest.mark.parametrize("noise", [None, 7])
def test_matches_brute_force(spark, monkeypatch, noise):
    monkeypatch.setattr(spelling, "CELLS", 64)
    rows = some_words(11) + [(None, "nulled nulled nulled nulles nulles nulles", "en", "a", 1)]
    rows += [(900 + k, "chainaaa " * 3 + "chainaab " * 6 + "chainabb " * 12 + "chainbb " * 24, "en", "a", 1) for k in range(3)]
    expected = brute(counted([r[:2] for r in rows], noise))
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] != r[2] for r in expected if r[1])
    found = sorted(tuple(r) for r in spelling.variants(documents(spark, rows), noise).collect())
    assert found == expected


def test_query_matches_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op11_spelling_variants"](spark, sf)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in found.collect()) == brute(counted(docs, NOISE))


def test_node_pairs_are_few_and_bounded(spark):
    """2 L + 1 pairs a word; no group is larger than the alphabet and the word without the letter."""
    words = spark.createDataFrame([(k, "stem" + chr(97 + k), 5) for k in range(26)] + [(30, "stem", 9)], "id long, word string, n long")
    pairs = spelling.node_pairs(words)
    assert pairs.count() == 26 * 11 + 9
    assert pairs.groupBy("prefix", "suffix").count().agg({"count": "max"}).first()[0] == 27
    assert {r["id"]: r["n_near"] for r in spelling.near_words(words).collect()} == {k: 26 for k in range(26)} | {30: 26}


def test_words_of_any_length(spark):
    long = "y" * 60_000
    rows = [(1, f"{long} {long} {long}", "en", "a", 1), (2, f"{long}z {long}z {long}z " * 2, "en", "a", 1)]
    found = {len(r["word"]): r for r in spelling.variants(documents(spark, rows)).collect()}
    assert found[60_000]["form"] == long + "z" and found[60_000]["n_near"] == 1 and found[60_001]["form"] is None


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    expected = brute(counted([(r["doc_id"], r["text"]) for r in docs.collect()], None))
    assert sorted(tuple(r) for r in spelling.variants(docs).collect()) == expected
    assert spelling.variants(nothing(spark)).count() == 0
