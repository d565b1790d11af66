"""Engagement roll-ups and marts at minute and day grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlens.functions.text import share

MEANS = (
    "message_length",
    "token_count",
    "alpha_char_count",
    "numeric_char_count",
    "repeat_char_ratio",
    "text_complexity_proxy",
    "event_to_feature_latency_seconds",
)
TOTALS = ("link_count", "candidate_emote_token_count")
FLAGS = {"has_repeat_spam_pattern": "repeat_spam", "engagement_signal": "engagement_signal"}

# grain -> (roll-up time column, mart time column)
GRAIN_COLUMNS = {"minute": ("event_minute", "minute_ts"), "day": ("event_date", "date_day")}


def engagement_rollup(joined: DataFrame, grain: str, approximate_chatters: bool = False) -> DataFrame:
    """Per channel and interval. Messages without features count, but not in feature means.

    The single distinct count is planned as group-by (interval, channel, chatter) first, so
    one busy channel is spread over its chatters before anything gathers by channel.
    """
    time_column, _ = GRAIN_COLUMNS[grain]
    chatters = F.approx_count_distinct if approximate_chatters else F.count_distinct
    measures = [
        F.count(F.lit(1)).alias("total_messages"),
        chatters("chatter_id").alias("unique_chatters"),
        F.count("token_count").alias("feature_enriched_message_count"),
    ]
    measures += [F.avg(c).alias(f"avg_{c}") for c in MEANS]
    measures += [F.sum(c).alias(f"{c}_sum") for c in TOTALS]
    for flag, name in FLAGS.items():
        measures.append(F.count_if(flag).alias(f"{name}_count"))
        measures.append(F.avg(F.col(flag).cast("double")).alias(f"{name}_rate"))
    return joined.groupBy(F.date_trunc(grain, "event_ts").alias(time_column), "channel").agg(*measures)


def engagement_mart(rollup: DataFrame, grain: str) -> DataFrame:
    """The roll-up with messages per chatter and the share of enriched messages."""
    time_column, mart_column = GRAIN_COLUMNS[grain]
    messages = F.col("total_messages")
    return rollup.withColumnRenamed(time_column, mart_column).withColumns(
        {
            "avg_messages_per_chatter": share(messages, F.col("unique_chatters")),
            "feature_enrichment_rate": share(F.col("feature_enriched_message_count"), messages),
        }
    )
