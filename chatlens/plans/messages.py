"""First-generation marts: message facts, minute metrics, daily sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlens.functions.text import share
from chatlens.schemas import LOG_KEY, MESSAGE_TYPES
from chatlens.sources.tables import literal_table

# Fixed value: placeholder for null parts of a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
NEUTRAL_BAND = 0.05


def message_type_dim(spark: SparkSession) -> DataFrame:
    names, descriptions = zip(*MESSAGE_TYPES)
    return literal_table(spark, {"message_type": list(names), "description": list(descriptions)})


def surrogate_key(*columns: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_PART)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def message_type() -> Column:
    """First matching class wins."""
    return (
        F.when(F.col("is_emote_only"), "EMOTE_ONLY")
        .when((F.col("message_length") < 3) | (F.col("entropy") < 0.8), "LOW_EFFORT")
        .when(F.col("repeat_char_ratio") >= 0.7, "REPETITIVE_SPAM")
        .when(F.col("engagement_flag"), "ENGAGED_CHAT")
        .otherwise("OTHER")
    )


def chat_messages_fact(silver: DataFrame) -> DataFrame:
    return silver.withColumns({"message_id": surrogate_key(*LOG_KEY), "message_type": message_type()})


def message_type_dim_join(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows with their type's description. Spark broadcasts the dimension while it is small."""
    return fact.join(dim, "message_type")


def _sentiment_counts() -> dict[str, Column]:
    score = F.col("sent_compound")
    return {
        "positive_messages": F.count_if(score > NEUTRAL_BAND),
        "negative_messages": F.count_if(score < -NEUTRAL_BAND),
        "neutral_messages": F.count_if(score.between(-NEUTRAL_BAND, NEUTRAL_BAND)),
    }


def chat_metrics_minute(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.date_trunc("minute", "kafka_timestamp").alias("minute")).agg(
        F.count(F.lit(1)).alias("message_count"),
        F.avg("sent_compound").alias("avg_sentiment"),
        *[c.alias(name) for name, c in _sentiment_counts().items()],
        F.count_if("engagement_flag").alias("engaged_messages"),
        F.avg(F.col("engagement_flag").cast("int")).alias("engagement_rate"),
        F.count_if("is_emote_only").alias("emote_only_messages"),
        F.avg("message_length").alias("avg_message_length"),
    )


def sentiment_summary(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("topic", F.to_date("kafka_timestamp").alias("message_date")).agg(
        F.count(F.lit(1)).alias("total_messages"),
        *[c.alias(name) for name, c in _sentiment_counts().items()],
    )
    total = F.col("total_messages")
    return counted.withColumns(
        {
            f"pct_{side}": F.round(share(F.col(f"{side}_messages"), total), 4)
            for side in ("positive", "negative")
        }
    )
