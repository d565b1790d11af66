"""First-generation message enrichment: entropy, runs, letters, emotes and sentiment.

All of it is built from native expressions, so no row leaves the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.text import char_counts, longest_run, words
from chatlens.schemas import EMOTE_SENTIMENT

WORD = r"\p{L}\p{N}_"
# The look-behind anchors the tail match at the start of its run: linear, not quadratic.
EDGE_PUNCTUATION = rf"^[^{WORD}]+|(?<![^{WORD}])[^{WORD}]+$"

# Normalisation constant of the published rule-based sentiment formula s / sqrt(s*s + alpha).
COMPOUND_ALPHA = 15.0


def shannon_entropy(text: Column) -> Column:
    """Bits per character; 0 for null or empty text.

    -sum(p log p) with p = n/size, written as log(size) - sum(n log n)/size: one logarithm
    and one product per distinct character.
    """
    body = F.coalesce(text, F.lit(""))
    size = F.length(body).cast("double")
    weighted = F.aggregate(char_counts(body), F.lit(0.0), lambda acc, n: acc + n * F.log2(n))
    return F.when(size > 0, F.log2(size) - weighted / size).otherwise(0.0)


def max_run_ratio(text: Column) -> Column:
    """Longest run of one character over length; 0 for null or empty text."""
    body = F.coalesce(text, F.lit(""))
    return F.coalesce(F.try_divide(longest_run(body).cast("double"), F.length(body)), F.lit(0.0))


def alpha_ratio(text: Column) -> Column:
    """Letters of any script over length; 0 for null or empty text."""
    body = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]+", ""))
    return F.coalesce(F.try_divide(letters.cast("double"), F.length(body)), F.lit(0.0))


def emote_tokens(text: Column) -> Column:
    """Words without punctuation at their edges."""
    bare = F.transform(words(text), lambda w: F.regexp_replace(w, EDGE_PUNCTUATION, ""))
    return F.filter(bare, lambda w: w != "")


def _known(tokens: Column, lexicon: Mapping[str, float]) -> Column:
    return F.filter(tokens, lambda t: t.isin(*lexicon))


def dict_emote_count(tokens: Column, lexicon: Mapping[str, float] = EMOTE_SENTIMENT) -> Column:
    return F.size(_known(tokens, lexicon))


def dict_is_emote_only(tokens: Column, lexicon: Mapping[str, float] = EMOTE_SENTIMENT) -> Column:
    return (F.size(tokens) > 0) & (F.size(tokens) == F.size(_known(tokens, lexicon)))


def emote_sentiment(tokens: Column, lexicon: Mapping[str, float] = EMOTE_SENTIMENT) -> Column:
    """Sum of dictionary scores. For dictionaries that are tables, see ``lexicon_scores``."""
    scores = F.create_map(*[F.lit(x) for pair in lexicon.items() for x in pair])
    return F.aggregate(
        _known(tokens, lexicon), F.lit(0.0), lambda acc, t: acc + F.try_element_at(scores, t)
    )


def with_v1_enrichment(
    df: DataFrame,
    text: str = "message",
    lexicon: Mapping[str, float] = EMOTE_SENTIMENT,
    with_sentiment: bool = False,
) -> DataFrame:
    message = F.col(text)
    columns = {
        "message_length": F.length(F.trim(message)),
        "entropy": shannon_entropy(message),
        "repeat_char_ratio": max_run_ratio(message),
        "alpha_ratio": alpha_ratio(message),
        "_tokens": emote_tokens(message),
    }
    enriched = df.withColumns(columns)
    tokens = F.col("_tokens")
    enriched = enriched.withColumns(
        {
            "is_emote_only": dict_is_emote_only(tokens, lexicon),
            "emote_count": dict_emote_count(tokens, lexicon),
            "engagement_flag": (F.col("message_length") >= 2)
            & (F.col("entropy") >= 1.0)
            & (F.col("repeat_char_ratio") < 0.7),
        }
    )
    if with_sentiment:
        enriched = enriched.withColumn("emote_sentiment", emote_sentiment(tokens, lexicon))
    return enriched.drop("_tokens")


FILTER_BITS = 1 << 18


def word_filter(lexicon: DataFrame, bits: int = FILTER_BITS) -> Callable[[Column], Column]:
    """A Bloom filter of the lexicon's words, as a test of one token: false only for words it lacks.

    What comes to the driver is the filter, ``bits`` of it at most; it becomes a constant of the plan.
    """

    def places(token: Column) -> list[Column]:
        return [F.pmod(h, F.lit(bits)) for h in (F.xxhash64(token), F.hash(token).cast("bigint"))]

    marked = lexicon.select(F.explode(F.array(*places(F.col("token")))).alias("bit"))
    longs = marked.groupBy(F.floor(F.col("bit") / 64).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("value"))
    values = [0] * (bits // 64)
    for row in longs.collect():
        values[row["at"]] = row["value"]
    table = F.from_json(F.lit(json.dumps(values)), "array<bigint>")

    def may_hold(token: Column) -> Column:
        found = [F.getbit(F.get(table, F.floor(bit / 64).cast("int")), (bit % 64).cast("int")) == 1 for bit in places(token)]
        return found[0] & found[1]

    return may_hold


def candidate_tokens(messages: DataFrame, lexicon: DataFrame, key: str, text: str) -> DataFrame:
    """key, token: one that may be in the lexicon, or null if none may; total: how many tokens a message has, on its first row."""
    tokens = messages.select(key, emote_tokens(F.col(text)).alias("_tokens"))
    may_hold = word_filter(lexicon)
    size = F.coalesce(F.size("_tokens"), F.lit(0)).alias("_size")
    kept = tokens.select(key, size, F.filter("_tokens", may_hold).alias("_kept"))
    rows = kept.select(key, "_size", F.posexplode_outer("_kept").alias("_at", "token"))
    return rows.select(key, "token", F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("_size")).otherwise(0).alias("total"))


def lexicon_scores(
    messages: DataFrame, lexicon: DataFrame, key: str = "event_id", text: str = "message"
) -> DataFrame:
    """neg/neu/pos/compound per message from a lexicon table (token, score), one row per token.

    Words that cannot be in the lexicon are dropped inside the row by a Bloom filter; only how many
    there were travels on. The others are counted per message before the join, which decides. It
    carries no hint: Spark broadcasts the lexicon only while its size stays under the session's
    threshold, and otherwise shuffles with skew splitting.
    """
    candidates = candidate_tokens(messages, lexicon, key, text)
    counted = candidates.groupBy(key, "token").agg(F.count("token").alias("n"), F.sum("total").alias("total"))
    scored = counted.join(lexicon.select("token", "score"), "token", "left")
    score = F.coalesce("score", F.lit(0.0))
    hits = F.col("n")
    sums = scored.groupBy(key).agg(
        F.sum(F.when(score > 0, (score + 1) * hits).otherwise(0.0)).alias("_pos"),
        F.sum(F.when(score < 0, (1 - score) * hits).otherwise(0.0)).alias("_neg"),
        (F.sum("total") - F.sum(F.when(score != 0, hits).otherwise(0))).cast("double").alias("_neu"),
        F.sum(score * hits).alias("_sum"),
    )
    total = F.col("_pos") + F.col("_neg") + F.col("_neu")

    def part(name: str) -> Column:
        return F.coalesce(F.round(F.try_divide(F.col(name), total), 3), F.lit(0.0))

    compound = F.col("_sum") / F.sqrt(F.col("_sum") * F.col("_sum") + COMPOUND_ALPHA)
    return sums.select(
        key,
        part("_neg").alias("neg"),
        part("_neu").alias("neu"),
        part("_pos").alias("pos"),
        F.round(compound, 4).alias("compound"),
    )
