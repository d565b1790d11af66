"""Features of a parsed message for the streaming feature job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.schemas import SILVER_FEATURES

SPAM_RATIO = 0.7
MIN_ENGAGED_LENGTH = 2
MIN_ENGAGED_COMPLEXITY = 0.3

# Runs of anything but ASCII letters, digits and underscores. The predefined class is matched
# several times faster than the same set written as a negated bracket.
NON_WORD = r"\W+"

# Runs of one repeated character.
REPEAT_RUN = r"(?s)(.)\1+"
LONG_REPEAT_RUN = r"(?s)(.)\1{4,}"

# The published patterns carry a doubled backslash, so they match
# "any character, a backslash, then 1s". Only ``literal_patterns`` uses them.
LITERAL_REPEAT_RUN = r"(.)\\1+"
LITERAL_LONG_REPEAT_RUN = r"(.)\\1{4,}"


def with_message_features(
    df: DataFrame,
    text: str = "message_text",
    as_of: Column | None = None,
    literal_patterns: bool = False,
) -> DataFrame:
    """Add the feature columns. ``as_of`` is the processing time (default: now)."""
    now = F.current_timestamp() if as_of is None else as_of
    run = LITERAL_REPEAT_RUN if literal_patterns else REPEAT_RUN
    long_run = LITERAL_LONG_REPEAT_RUN if literal_patterns else LONG_REPEAT_RUN

    # Each step is a projection of its own: Spark keeps it apart while a costly column is read
    # more than once, and drops the columns a query never asks for.
    trimmed = df.withColumn("_text", F.trim(F.col(text)))
    body = F.col("_text")
    emote_text = F.trim(F.regexp_replace(body, NON_WORD, " "))
    measured = trimmed.withColumns(
        {
            "_size": F.length(body),
            "_tokens": F.size(F.split(body, r"\s+")),
            "alpha_char_count": F.length(F.regexp_replace(body, "[^A-Za-z]+", "")),
            "numeric_char_count": F.length(F.regexp_replace(body, "[^0-9]+", "")),
            "link_count": F.size(F.split(F.lower(body), "http")) - 1,
            "_emote_text": emote_text,
            "_collapsed": F.length(F.regexp_replace(body, run, "$1")),
            "_long_run": F.lower(body).rlike(long_run),
        }
    )

    def ratio(part: Column) -> Column:
        return F.when(F.col("_size") > 0, part / F.col("_size")).otherwise(F.lit(0.0))

    rated = measured.withColumns(
        {
            "repeat_char_ratio": ratio(F.col("_size") - F.col("_collapsed")),
            "text_complexity_proxy": ratio(F.col("alpha_char_count")),
        }
    )
    engaged = (
        (F.col("message_length") >= MIN_ENGAGED_LENGTH)
        & (F.col("text_complexity_proxy") >= MIN_ENGAGED_COMPLEXITY)
        & (F.col("repeat_char_ratio") < SPAM_RATIO)
    )
    spam = (F.col("repeat_char_ratio") >= SPAM_RATIO) | F.col("_long_run")
    emotes = F.when(
        F.length("_emote_text") > 0, F.size(F.split(F.col("_emote_text"), r"\s+"))
    ).otherwise(0)
    return rated.withColumns(
        {
            "token_count": F.when(F.col("_size") > 0, F.col("_tokens")).otherwise(0),
            "link_count": F.greatest(F.col("link_count"), F.lit(0)),
            "candidate_emote_token_count": emotes,
            "event_to_feature_latency_seconds": (
                F.unix_timestamp(now) - F.unix_timestamp("event_ts")
            ).cast("int"),
            "has_repeat_spam_pattern": F.coalesce(spam, F.lit(False)),
            "engagement_signal": F.coalesce(engaged, F.lit(False)),
            "feature_processed_ts": now,
        }
    ).drop("_text", "_size", "_tokens", "_emote_text", "_collapsed", "_long_run")


def message_features(
    parsed: DataFrame, as_of: Column | None = None, literal_patterns: bool = False
) -> DataFrame:
    """The narrow feature table: ``event_id`` and derived columns only. No shuffle."""
    return with_message_features(parsed, as_of=as_of, literal_patterns=literal_patterns).select(
        *SILVER_FEATURES.fieldNames()
    )
