from __future__ import annotations

import random

import numpy as np
import pytest

from chatlens.llm import periodic
from tests.llm.tables import awkward, documents, nothing


def brute(words: list) -> list[tuple[int, int, int]]:
    """Every period, word by word."""
    found, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            stretch = words[i : i + length]
            if length >= max(24, 3 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def some_text(rng: random.Random) -> list[str]:
    """Random words, repeated parts of random periods (cut anywhere), nested and neighbouring."""
    words: list[str] = []
    for _ in range(rng.randint(0, 4)):
        words += [f"w{rng.randint(0, rng.choice([1, 3, 50, 5000]))}" for _ in range(rng.randint(0, 60))]
        unit = [f"u{rng.randint(0, rng.choice([1, 2, 9, 400]))}" for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 23, 24, 25, 26, 30, 31, 38, 60, 97]))]
        if rng.random() < 0.3:
            unit = unit * rng.randint(2, 4) + unit[:1]
        words += (unit * 6)[: rng.randint(len(unit), 6 * len(unit))]
    return words


def test_runs_match_brute_force():
    rng = random.Random(5)
    texts = [some_text(rng) for _ in range(120)]
    expected = [brute(t) for t in texts]
    assert sum(map(len, expected)) > 100 and max(q for r in expected for _, _, q in r) > 60
    found = periodic._piece([[w.encode() for w in t] for t in texts])
    assert found == expected


@pytest.mark.parametrize("period", [24, 25, 30, 31, 37, 38, 46, 150, 151, 1000, 3333])
@pytest.mark.parametrize("turns", [3.0, 3.01, 7.3])
def test_every_period_is_found_at_its_least_length(period, turns):
    rng = np.random.default_rng(period)
    unit = rng.integers(0, 2, period) * 2 + rng.integers(0, 2, period)  # few words, so many equal short sequences
    unit[0] = 9
    length = int(period * turns)
    run = np.resize(unit, length)
    ids = np.concatenate([[100], run, [101], run[: 3 * period - 1], [102]]).astype(np.int64)
    assert (1, length, period) in periodic.runs_of(ids, len(ids))
    assert all(q != period or s == 1 for s, _, q in periodic.runs_of(ids, len(ids)))


def test_operator_matches_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(periodic, "PIECE", 500)
    rng = random.Random(7)
    made = documents(spark, [(k, " \n".join(some_text(rng)), "en", "a", 1) for k in range(30)])
    sets = (spark.read.parquet(f"{sf}/documents.parquet").where("n_chars < 4000").limit(40), made)
    for docs in sets:
        texts = {r["doc_id"]: (r["text"] or "").encode().split() for r in docs.collect()}
        rows = periodic.periodic_runs(docs).collect()
        assert len(rows) == len(texts)
        for r in rows:
            words = [w.decode() for w in texts[r["doc_id"]]]
            runs = brute(words)
            assert [tuple(x) for x in r["runs"]] == runs
            assert r["collapsed"] == collapsed(words, runs)


def test_awkward_and_empty_tables(spark):
    rows = periodic.periodic_runs(awkward(spark)).collect()
    assert len(rows) == 12 and sum(r["doc_id"] is None for r in rows) == 2
    by_id = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by_id[6]["runs"]] == [(0, 30_000, 1)] and by_id[6]["collapsed"] == "word"
    assert [tuple(x) for x in by_id[9]["runs"]] == [(0, 40, 2)]
    for k in (3, 4, 5, 8):
        assert by_id[k]["runs"] == [] and by_id[k]["collapsed"] == ""
    assert periodic.periodic_runs(nothing(spark)).count() == 0


def test_query_plants_and_digests(spark, tmp_path):
    import hashlib
    import zlib

    from chatlens.llm.catalog import QUERIES

    rng = random.Random(3)
    rows = [(k, " ".join(some_text(rng) + [f"x{j}" for j in range(rng.randint(0, 90))]), "en", "a", 1) for k in range(60)]
    rows += [(None, "a b " * 20, "en", "a", 1), (500, None, "en", "a", 0), (None, None, None, None, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect() if r["doc_id"] is not None}
    planted = 0
    for doc, text, *_ in rows:
        if doc is None:
            continue
        words = (text or "").split(" ") if text else []
        words = [w for w in words if w]
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        r = found[doc]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 1
