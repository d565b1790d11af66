from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from chatlens.llm import pii
from tests.llm.tables import awkward, documents, nothing

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    return [
        (k, m.start(), m.end())
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text)
        if passes(kind, m[0])
    ]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a@.+-0159 ()%\né", max_size=60))
def test_certain_spans_match_the_patterns(text):
    assert pii.certain_spans(text) == plain_spans(text)


def test_table_matches_the_patterns(spark, sf):
    for docs in (awkward(spark), spark.read.parquet(f"{sf}/documents.parquet")):
        rows = pii.find(docs).collect()
        expected = []
        for r in docs.select("doc_id", "text").collect():
            spans = plain_spans(r["text"] or "")
            told = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for k, a, b in spans)
            counts = [sum(1 for k, _, _ in spans if k == kind) for kind in range(4)]
            expected.append((str(r["doc_id"]), *counts, hashlib.sha256(told.encode()).hexdigest()))
        found = [(str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in rows]
        assert sorted(found) == sorted(expected)
        texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        for r in rows:
            for span in filter(None, r["spans"].split(",")):
                kind, start, end = span.split(":")
                assert kind in pii.KINDS and texts[r["doc_id"]][int(start) : int(end)].strip()


def corpus() -> list[tuple]:
    rows = []
    for i in range(400):
        number = f"{4917000000000 + 7919 * i}"
        text = f"item {i} has 12 parts. call +{number} today, or write to user{i}@mail{i % 9}.example.com and ask user{i}@mail{i % 9}.example.com"
        rows.append((i, text if i % 2 else f"in 19{i % 90 + 10} there were {i} of {1000 + i} boxes, 3.5 each", "en", "a", 1))
    return rows


def test_repeats_of_a_known_number_are_found_elsewhere(spark):
    """Long-range agreement: a number written with a plus once is recognised where the plus is missing."""
    known = "+491712345678"
    text = f"call {known} now. " + "words in between. " * 50 + "again 491712345678 please. and 17 other things."
    rows = corpus() + [(10_000, text, "en", "a", 1)]
    found = {r["doc_id"]: r for r in pii.find(documents(spark, rows)).collect()}
    start = text.index(" 491712345678 ") + 1
    assert f"phone:{start}:{start + 12}" in found[10_000]["spans"].split(",")
    clean = [r for k, r in found.items() if k < 400 and k % 2 == 0]
    assert all(r["spans"] == "" for r in clean)


def test_messages_agree_with_exact_marginals_on_a_chain():
    """On a chain, message passing is exact: compare with enumeration."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    n = 4
    features = np.zeros((n, len(pii.SLOTS)), dtype=int) + pii.OFFSETS
    features[:, 3] += np.arange(n)
    field = pii.Field(rng.normal(size=(pii.WIDTH, pii.LABELS)) / 3, rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    zeros = np.zeros(n, dtype=int)
    found = pii.Candidates(zeros, zeros, features, zeros, np.array([False, True, True, True]), np.full(n, -1))
    weights = np.zeros((n, pii.LABELS))
    own = field.unary[features].sum(axis=1)
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        score = sum(own[k, y] for k, y in enumerate(labels)) + sum(field.chain[a, b] for a, b in zip(labels, labels[1:]))
        for k, y in enumerate(labels):
            weights[k, y] += np.exp(score)
    exact = weights / weights.sum(axis=1, keepdims=True)
    assert np.abs(pii.marginals(field, found) - exact).max() < 0.02


def test_empty_table(spark):
    assert pii.find(nothing(spark)).count() == 0
