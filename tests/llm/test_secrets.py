from __future__ import annotations

import hashlib
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from chatlens.llm import secrets
from tests.llm.tables import awkward, documents, nothing

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


pieces = st.sampled_from(["token", "Api_Key", "PASSWD", "apikey", "=", " ", ":", '"', "'", "AKIA", "ABCDEFGH12", "deadbeef", "0123", "xyz/+", "\n", "é", "K", "secret"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_certain_spans_match_the_patterns(text):
    assert secrets.certain_spans(text) == plain_spans(text)


def test_table_matches_the_patterns(spark, sf):
    for docs in (awkward(spark), spark.read.parquet(f"{sf}/documents.parquet")):
        expected = []
        for r in docs.select("doc_id", "text").collect():
            spans = plain_spans(r["text"] or "")
            told = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
            counts = [sum(1 for _, k, _ in spans if k == kind) for kind in range(3)]
            expected.append((str(r["doc_id"]), *counts, hashlib.sha256(told.encode()).hexdigest()))
        rows = secrets.find(docs).collect()
        assert sorted((str(r["doc_id"]), r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in rows) == sorted(expected)


KEY = "qT7vLx2Zb9RkW4mHs8NpYc3EgJd6UfAa"


def brute(rows: list[tuple]) -> dict:
    """Novel spans, with the dictionary counted and every string judged here."""
    counts = Counter(w for _, text in rows for w in set(re.findall(secrets.IDENTIFIER, text or "")))
    common = {w: n for w, n in counts.items() if n >= 2}
    top = sorted(common, key=lambda w: (-common[w], w))[: secrets.IDENTIFIERS]
    novelty = secrets.Novelty(top[::-1])
    found = {}
    for doc, text in rows:
        spans = []
        for x, starts in secrets.sensitive_places(text or "", plain_spans(text or "")).items():
            around = text[max(0, starts[0] - 200) : starts[0]] + "\n" + text[starts[0] + len(x) : starts[0] + len(x) + 200]
            names = sorted(w for w in set(secrets.NAME.findall(x)) if w in common)
            if novelty(x, around.replace(x, ""), names) >= secrets.NOVELTY:
                spans += [f"novel:{k}:{k + len(x)}" for k in starts]
        found[doc] = sorted(spans, key=lambda x: int(x.split(":")[1]))
    return found


def novel(rows) -> dict:
    return {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("novel")] for r in rows}


def cases() -> list[tuple]:
    rows = [(k, f"session_cookie_name = session_cookie_name_default; connection_pool_manager_{k % 3} used") for k in range(50)]
    texts = [
        f"client config: auth_header = {KEY} and more code follows here", "auth_mode = session_cookie_name_default",
        f"known {KEY} was set before; auth_header = {KEY} again", "auth_mode = zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz",
        f"auth_header = {KEY}\nsession_key = {KEY}", f"Authorization: Bearer {KEY}", f'signingKey = "{KEY}"', f"privateKey1 = {KEY}",
        f"postgres://user:{KEY}@host/db", f"auth_header =\t{KEY}", "db_pass = x9Kq2mZ7pLw4v", f"the author passed {KEY} along",
        f"keyboard and passage of {KEY}", f"key on this line\n{KEY} on the next", "access_key_name = warehouse_partition_rebalancer",
        "é key: ключ passe = motdepassemotdepasse", f"token = {KEY}",
    ]
    return rows + [(100 + k, t) for k, t in enumerate(texts)] + [(200, "warehouse_partition_rebalancer runs"), (201, "a warehouse_partition_rebalancer"), (202, None)]


def test_novel_strings_are_reported_and_names_are_not(spark):
    rows = cases()
    found = novel(secrets.find(documents(spark, [(k, t, "en", "a", 1) for k, t in rows])).collect())
    texts = dict(rows)
    for k in (100, 105, 106, 107, 108, 109):
        assert found[k] == [f"novel:{texts[k].index(KEY)}:{texts[k].index(KEY) + 32}"], texts[k]
    assert len(found[104]) == 2 and len(found[110]) == 1 and len(found[102]) == 1
    for k in (101, 103, 111, 112, 113, 114, 116, 200, 202, *range(50)):
        assert found[k] == [], texts[k]


def test_result_does_not_depend_on_the_size_of_the_common_list(spark, monkeypatch):
    monkeypatch.setattr(secrets, "IDENTIFIERS", 1)
    found = novel(secrets.find(documents(spark, [(k, t, "en", "a", 1) for k, t in cases()])).collect())
    assert found[114] == [] and found[101] == [] and len(found[104]) == 2


def test_novel_spans_match_brute_force(spark, sf):
    made = documents(spark, [(k, t, "en", "a", 1) for k, t in cases()])
    given = spark.read.parquet(f"{sf}/documents.parquet")
    for docs in (made, given):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        found = secrets.find(docs).collect()
        assert novel(found) == brute(rows)
        assert all(r["n_novel"] == r["spans"].count("novel:") for r in found)


def test_identifiers_are_counted_over_all_documents(spark):
    rows = [(k, "common_identifier rare_identifier_%d" % k, "en", "a", 1) for k in range(5)]
    assert secrets.identifiers(secrets.identifier_counts(documents(spark, rows))) == ["common_identifier"]


def test_empty_table(spark):
    assert secrets.find(nothing(spark)).count() == 0
