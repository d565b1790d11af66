"""Text features against plain-Python brute force on hard messages."""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatlens.functions.enrich import lexicon_scores, with_v1_enrichment
from chatlens.functions.message import with_message_features
from chatlens.functions.profile import with_text_profile
from chatlens.functions.text import char_counts, longest_run, squeeze, strip
from chatlens.schemas import EMOTE_SENTIMENT

MESSAGES = [
    "",
    "   ",
    "aaaaaaa",
    "AaAaA",
    "GOOOOAL",
    "x\\1111",
    "http http://a HTTPS://b",
    "see hTTp://",
    "Kappa LUL",
    "Kappa!",
    "hello Kappa",
    "!!! ??",
    "(PogChamp) 4Head,",
    "é è ñandú ÑÑÑÑÑ",
    "😀😀😀 ok 😀",
    "tab\t\trun\n\n\nend\n",
    "  nbsp  ",
    "one\n two",
    "Kappa\n LUL",
    "\n\n\n\n\nx",
    "a" * 5000 + "!" * 5000 + "b",
    "12345 67",
    "snake_case __ x",
]


def runs(text: str) -> list[int]:
    return [len(list(g)) for _, g in groupby(text)]


def brute_message(message: str) -> dict:
    t = message.strip(" ")
    n = len(t)
    alpha = sum(c.isascii() and c.isalpha() for c in t)
    ratio = sum(r - 1 for r in runs(t)) / n if n else 0.0
    complexity = alpha / n if n else 0.0
    return {
        "token_count": len(re.split(r"[ \t\n\x0b\f\r]+", t)) if n else 0,
        "alpha_char_count": alpha,
        "numeric_char_count": sum(c in "0123456789" for c in t),
        "link_count": t.lower().count("http"),
        "candidate_emote_token_count": len(re.findall(r"[A-Za-z0-9_]+", t)),
        "repeat_char_ratio": ratio,
        "text_complexity_proxy": complexity,
        "has_repeat_spam_pattern": ratio >= 0.7 or max(runs(t.lower()), default=0) >= 5,
        "engagement_signal": len(message) >= 2 and complexity >= 0.3 and ratio < 0.7,
    }


def brute_profile(message: str) -> dict:
    body = message.strip()
    tokens = [t for t in body.split(" ") if t]
    shaped = [bool(re.match(r"^[A-Za-z0-9_]{2,24}$", t)) for t in tokens]
    counts = Counter(body)
    share = round(sum(c for c in counts.values() if c > 2) / len(body), 4) if body else 0.0
    proxy = round(math.log2(len(counts)), 4) if body else 0.0
    four = any(len(list(g)) >= 4 for k, g in groupby(message) if k != "\n")
    return {
        "profile_message_length": len(body),
        "profile_tokens": tokens,
        "profile_emote_count": sum(ok and any(c.isupper() for c in t) for t, ok in zip(tokens, shaped)),
        "profile_is_emote_only": bool(tokens) and all(shaped),
        "frequent_char_share": share,
        "entropy_proxy": proxy,
        "contains_link": re.search(r"https?://\S+", message, re.I) is not None,
        "profile_spam": four or share >= 0.35,
        "profile_engagement": len(body) >= 2 and proxy >= 1.0 and share < 0.7,
    }


def brute_v1(message: str) -> dict:
    n = len(message)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(message).values()) if n else 0.0
    run = max(runs(message), default=0) / n if n else 0.0
    words = [re.sub(r"^[^\w]+|[^\w]+$", "", w) for w in message.split()]
    words = [w for w in words if w]
    length = len(message.strip(" "))
    return {
        "message_length": length,
        "entropy": entropy,
        "repeat_char_ratio": run,
        "alpha_ratio": sum(c.isalpha() for c in message) / n if n else 0.0,
        "is_emote_only": bool(words) and all(w in EMOTE_SENTIMENT for w in words),
        "emote_count": sum(w in EMOTE_SENTIMENT for w in words),
        "emote_sentiment": sum(EMOTE_SENTIMENT.get(w, 0.0) for w in words),
        "engagement_flag": length >= 2 and round(entropy, 12) >= 1.0 and run < 0.7,
    }


def frame(spark, messages):
    rows = [(i, m, len(m)) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "id int, message string, message_length int").withColumn(
        "event_ts", F.timestamp_seconds(F.lit(0))
    )


def check(df, messages, brute):
    for row in df.orderBy("id").collect():
        for name, value in brute(messages[row["id"]]).items():
            expected = pytest.approx(value, abs=1e-9) if isinstance(value, float) else value
            assert row[name] == expected, (name, messages[row["id"]][:60])


def test_message_features(spark):
    check(with_message_features(frame(spark, MESSAGES), "message"), MESSAGES, brute_message)


def test_text_profile(spark):
    check(with_text_profile(frame(spark, MESSAGES), "message"), MESSAGES, brute_profile)


def test_v1_enrichment(spark):
    df = with_v1_enrichment(frame(spark, MESSAGES).drop("message_length"), with_sentiment=True)
    check(df, MESSAGES, brute_v1)


def test_literal_patterns_match_backslashes_only(spark):
    rows = with_message_features(frame(spark, ["aaaaaaa", "x\\1111"]), "message", literal_patterns=True)
    first, second = rows.orderBy("id").collect()
    assert (first["repeat_char_ratio"], first["has_repeat_spam_pattern"]) == (0.0, False)
    assert second["repeat_char_ratio"] == pytest.approx(5 / 6) and second["has_repeat_spam_pattern"]


def test_null_text(spark):
    df = spark.createDataFrame([(1, None)], "id int, message string")
    v1 = with_v1_enrichment(df, with_sentiment=True).first()
    assert (v1["entropy"], v1["repeat_char_ratio"], v1["alpha_ratio"]) == (0.0, 0.0, 0.0)
    assert (v1["is_emote_only"], v1["emote_count"], v1["emote_sentiment"]) == (False, 0, 0.0)
    profile = with_text_profile(df, "message").first()
    assert (profile["profile_message_length"], profile["profile_is_emote_only"]) == (0, False)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aAb \n\tñ😀_1!\\", max_size=40), min_size=20, max_size=60))
def test_random_texts(spark, texts):
    got = (
        frame(spark, texts)
        .select(
            "id",
            F.sort_array(char_counts(F.col("message"))).alias("counts"),
            longest_run(F.col("message")).alias("run"),
            strip(F.col("message")).alias("stripped"),
            squeeze(F.col("message")).alias("squeezed"),
        )
        .collect()
    )
    for row in got:
        text = texts[row["id"]]
        assert row["counts"] == sorted(Counter(text).values())
        assert row["run"] == max(runs(text), default=0)
        assert row["stripped"] == text.strip()
        assert row["squeezed"] == " ".join(text.split())


def test_lexicon_scores(spark):
    df = spark.createDataFrame(
        [("a", "LUL LUL bad day"), ("b", "nothing"), ("c", "!!")], "event_id string, message string"
    )
    lexicon = spark.createDataFrame([("LUL", 0.6), ("bad", -1.0)], "token string, score double")
    rows = {r["event_id"]: r for r in lexicon_scores(df, lexicon).collect()}
    total = 0.2
    assert rows["a"]["compound"] == pytest.approx(round(total / math.sqrt(total**2 + 15), 4))
    assert rows["a"]["pos"] == pytest.approx(round(3.2 / 6.2, 3))
    assert rows["a"]["neg"] == pytest.approx(round(2.0 / 6.2, 3))
    assert (rows["b"]["neu"], rows["b"]["compound"]) == (1.0, 0.0)
    assert (rows["c"]["neu"], rows["c"]["pos"], rows["c"]["neg"], rows["c"]["compound"]) == (0.0, 0.0, 0.0, 0.0)


def test_character_counts_of_long_texts(spark):
    """Letters that begin late, other scripts, zero bytes and pairs of surrogates; long texts are not sorted as a whole."""
    texts = ["ab " * 400 + "Q" + "é" * 5, "漢字" * 200 + "x", "\x00a\n" * 300 + "😀😀𝒳", "é" * 300, "a" * 255, "a" * 256, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r["i"]: r["c"] for r in df.select("i", F.sort_array(char_counts(F.col("t"))).alias("c")).collect()}
    assert found == {i: None if t is None else sorted(Counter(t).values()) for i, t in enumerate(texts)}
    plan = df.select(char_counts(F.col("t")).alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(split(t" in plan.split("ELSE")[0] and "sort_array(split(t" not in plan.split("ELSE")[1]
