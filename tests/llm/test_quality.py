from __future__ import annotations

import re
from collections import Counter

from chatlens.llm import quality
from tests.llm.tables import awkward, documents, nothing


def measured(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_ledger_matches_brute_force(spark, sf):
    for docs in (awkward(spark), spark.read.parquet(f"{sf}/documents.parquet")):
        expected = sorted((str(r["doc_id"]), *measured(r["text"])) for r in docs.collect())
        found = quality.ledger(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == expected


def test_policies_and_ablations_agree_with_the_texts(spark, sf):
    ledger = quality.ledger(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = ledger.collect()
    for version, names in quality.POLICIES.items():
        bits = quality.mask(names)
        kept = quality.apply_policy(ledger, version).where("kept").count()
        assert kept == sum(1 for r in rows if not r["fail_bits"] & bits)
        table = {r["rule"]: r for r in quality.ablations(ledger, version).collect()}
        for name in names:
            bit = quality.mask([name])
            assert table[name]["documents"] == len(rows)
            assert table[name]["rejected_by_policy"] == len(rows) - kept
            assert table[name]["rejected_by_rule"] == sum(1 for r in rows if r["fail_bits"] & bit)
            assert table[name]["rejected_only_by_rule"] == sum(1 for r in rows if r["fail_bits"] & bits == bit)


def test_kept_rows_carry_their_columns(spark):
    docs = awkward(spark)
    kept = quality.select_kept(docs)
    assert kept.columns == docs.columns
    assert {r["kept"] for r in kept.collect()} == {"theirs"}
    assert kept.where("doc_id = 1").count() == 2


def test_empty_table(spark):
    assert quality.ledger(nothing(spark)).count() == 0
    assert quality.select_kept(nothing(spark)).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert quality.ablations(quality.ledger(nothing(spark))).count() == 0


def test_clean_prose_stays_and_junk_goes(spark):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} stands here," for i in range(40))
    rows = [
        (1, clean, "en", "a", 1),
        (2, " ".join(w + "###" for w in clean.split()), "en", "a", 1),
        (3, clean.upper(), "en", "a", 1),
        (4, "\n".join(["one line of this text"] * 30), "en", "a", 1),
        (5, "too short", "en", "a", 1),
    ]
    assert [r["doc_id"] for r in quality.select_kept(documents(spark, rows)).collect()] == [1]
