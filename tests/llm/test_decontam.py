from __future__ import annotations

import random

import numpy as np
import pytest

from chatlens.llm import decontam
from tests.llm.tables import awkward, documents, nothing

ITEMS = "item_id long, text string"


def subsequence(a: list[bytes], b: list[bytes]) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
        row = new
    return row[-1]


def test_common_words_match_the_table_method():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(1, 12))]
        b = [rng.choice([b"a", b"b", b"c", b"e"]) for _ in range(rng.randint(0, 20))]
        assert decontam.common_words(decontam.position_masks(a), b) == subsequence(a, b)


def brute(docs: list, items: list) -> set[tuple]:
    """Every item against every stretch of one and a half times its size power, without retrieval."""
    block = decontam.Items.of([(r["item_id"], r["text"]) for r in items])
    found = set()
    for r in docs:
        words = decontam.words_of(r["text"])
        for k, own in enumerate(block.words):
            step = max(8, 1 << (len(own) - 1).bit_length()) // 2
            for start in range(0, max(1, len(words)), step):
                if block.check(k, words[start : start + 3 * step])[1]:
                    found.add((r["doc_id"], block.ids[k]))
                    break
    return found


def test_recall_against_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    expected = brute(docs.collect(), items.collect())
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, items).collect()}
    assert expected and found <= expected
    assert len(found & expected) >= 0.9 * len(expected)


def prose(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n)]


def test_copies_and_paraphrases_go_and_clean_documents_stay(spark):
    item, answer = prose(1, 36), prose(2, 4)
    text = " ".join(item) + ". " + " ".join(answer) + "."
    reworded = [w if k % 4 else f"new{k}" for k, w in enumerate(item)]
    inside = lambda k, middle: " ".join([*prose(100 + k, 150), *middle, *prose(200 + k, 150)])
    rows = [
        (1, inside(1, [text.upper()]), "en", "a", 1),
        (2, inside(2, [*reworded, "so", *answer]), "en", "a", 1),
        (3, inside(3, reworded), "en", "a", 1),
        (4, inside(4, item[:12]), "en", "a", 1),
        (5, text, "en", "a", 1),
        *((k, inside(k, []), "en", "a", 1) for k in range(10, 60)),
    ]
    docs = documents(spark, rows)
    items = spark.createDataFrame([(1, text), (2, None), (3, ""), (None, "tiny item")], ITEMS)
    found = {r["doc_id"]: r["kind"] for r in decontam.leaks(docs, items).collect()}
    assert found == {1: "copy", 2: "paraphrase", 5: "copy"}
    kept = {r["doc_id"] for r in decontam.clean(docs, items).collect()}
    assert kept == {r[0] for r in rows} - {1, 2, 5}


def test_an_item_that_a_third_of_all_documents_holds(spark):
    text = " ".join(prose(1, 40))
    rows = [(k, " ".join([*prose(300 + k, 80), *([text] if k % 3 == 0 else []), *prose(900 + k, 80)]), "en", "a", 1) for k in range(90)]
    found = {r["doc_id"] for r in decontam.leaks(documents(spark, rows), spark.createDataFrame([(1, text)], ITEMS)).collect()}
    assert found == set(range(0, 90, 3))


def test_blocks_of_items_give_the_same(spark, sf, monkeypatch):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, items).collect()}
    monkeypatch.setattr(decontam, "ITEM_BLOCK", 15)
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, items).collect()} == whole


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while seven wise owls watch")], ITEMS)
    docs = awkward(spark)
    found = sorted((str(r["doc_id"]), r["item_id"]) for r in decontam.leaks(docs, items).collect())
    assert found == [("1", 1), ("1", 1), ("2", 1), ("None", 1)]
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 4


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "some item of a benchmark that has enough words")], ITEMS)
    assert decontam.leaks(nothing(spark), items).count() == 0
    assert decontam.leaks(awkward(spark), items.limit(0)).count() == 0
    assert decontam.clean(awkward(spark), items.limit(0)).count() == awkward(spark).count()


def test_verbatim_copies_of_a_thousand_items_are_found(spark):
    """Items just above a power of two and items of a single word, of one vocabulary, each copied once."""
    rng = random.Random(5)
    vocabulary = sorted({"".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4)) for _ in range(20_000)})
    texts = [" ".join(rng.choices(vocabulary, k=33)) for _ in range(1000)] + [f"alone{k}" for k in range(3)]
    rows = [(k, " ".join([*rng.choices(vocabulary, k=150), t, *rng.choices(vocabulary, k=150)]), "en", "a", 1) for k, t in enumerate(texts)]
    items = spark.createDataFrame(list(enumerate(texts)), ITEMS)
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(documents(spark, rows), items).collect()}
    assert {(k, k) for k in range(len(texts))} <= found


def test_the_space_holds_every_item(spark):
    rng = random.Random(6)
    texts = [" ".join(prose(1000 + k, 20)) for k in range(decontam.ITEM_BLOCK)]
    rows = [(k, " ".join(rng.choices(" ".join(texts).split(), k=300)), "en", "a", 1) for k in range(50)]
    block = decontam.Items.of(list(enumerate(texts)))
    index = decontam.fit(documents(spark, rows), block)
    for k, words in enumerate(block.words):
        length = sum(index.weight[block.vocabulary[w]] ** 2 * words.count(w) ** 2 for w in set(words)) ** 0.5
        assert index.norms[k] >= 0.94 * length


@pytest.mark.parametrize("needed", [0.01, 0.2, 0.6])
def test_overlap_bound_drops_no_passage_that_a_check_takes(monkeypatch, needed):
    """Against every item and every passage of its size, for items of repeated and of common words too."""
    monkeypatch.setattr(decontam, "NEEDED", needed)
    rng = random.Random(4)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 400}"
    items = decontam.Items.of([(k, " ".join(word() for _ in range(rng.choice([1, 3, 7, 8, 9, 16, 17, 40, 64, 70])))) for k in range(60)])
    texts = []
    for k in range(120):
        own = list(rng.choice(items.words))
        held = [w for w in own if rng.random() > rng.choice([0, 0.1, 0.3, 0.5])]
        mixed = [x for w in held for x in ([w.decode()] + ([word()] if rng.random() < 0.1 else []))]
        texts.append(" ".join([word() for _ in range(rng.randint(0, 90))] + mixed + [word() for _ in range(rng.randint(0, 90))]))
    taken = 0
    for rows, words, ids, bounds in decontam._groups(texts, items.vocabulary):
        frequency = np.bincount(ids[ids >= 0], minlength=len(items.vocabulary))
        for own in decontam.overlaps(items, frequency):
            found = set(own.passages(ids, bounds))
            for doc, text in enumerate(words):
                for start in range(0, max(1, len(text)), own.step):
                    if start and start + 2 * own.step >= len(text):
                        continue
                    for item in np.flatnonzero(own.needed < np.iinfo(np.int64).max).tolist():
                        if items.check(item, text[start : start + 3 * own.step])[1]:
                            taken += 1
                            assert (doc, item, start) in found
    assert taken > 100
