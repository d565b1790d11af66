"""First-generation parse and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.enrich import with_v1_enrichment
from chatlens.operators.parse import envelope_parse
from chatlens.schemas import LOG_KEY, V1_PAYLOAD, V1_SILVER


def v1_parse(log: DataFrame) -> DataFrame:
    """Flatten {user, message, sentiment} payloads; ``parse_ok`` marks readable ones."""
    text = log.withColumn("_payload", F.col("value").cast("string"))
    return envelope_parse(text, V1_PAYLOAD, "_payload").select(
        F.col("envelope.user").alias("user"),
        F.col("envelope.message").alias("message"),
        *[F.col(f"envelope.sentiment.{s}").alias(f"sent_{s}") for s in ("neg", "neu", "pos", "compound")],
        F.col("timestamp").alias("kafka_timestamp"),
        *LOG_KEY,
        "parse_ok",
    )


def v1_enrich(parsed: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Readable rows with features, in Silver column order."""
    return (
        with_v1_enrichment(parsed.filter("parse_ok"))
        .withColumn("ingest_ts", F.current_timestamp() if as_of is None else as_of)
        .select(*V1_SILVER.fieldNames())
    )


def v1_parsed_raw(log: DataFrame) -> DataFrame:
    """``v1_parse`` beside the payload text: what one batch needs, from one parse of each payload."""
    text = log.withColumn("_payload", F.col("value").cast("string"))
    return envelope_parse(text, V1_PAYLOAD, "_payload").select(
        F.col("_payload").alias("json_payload"),
        F.col("envelope.user").alias("user"),
        F.col("envelope.message").alias("message"),
        *[F.col(f"envelope.sentiment.{s}").alias(f"sent_{s}") for s in ("neg", "neu", "pos", "compound")],
        F.col("timestamp").alias("kafka_timestamp"),
        *LOG_KEY,
        "parse_ok",
    )


def parse_status(parsed: DataFrame) -> DataFrame:
    """One status row per log key: PARSE_ERROR where any copy could not be read, else OK.

    The status merges run OK keys first and error keys second, so the error has the last word.
    """
    readable = parsed.groupBy(*LOG_KEY).agg(F.bool_and("parse_ok").alias("_ok"))
    return readable.select(
        *LOG_KEY,
        F.when(F.col("_ok"), "OK").otherwise("PARSE_ERROR").alias("parse_status"),
        F.when(~F.col("_ok"), "PARSE_ERROR").alias("parse_error"),
    )


def enriched_message(messages: DataFrame) -> DataFrame:
    """Rows to publish back to a log: key coordinates dropped, one JSON ``value``."""
    sentiment = F.struct(*[F.col(f"sent_{s}").alias(s) for s in ("neg", "neu", "pos", "compound")])
    return messages.select(
        F.to_json(
            F.struct("user", "message", sentiment.alias("sentiment")), {"ignoreNullFields": "false"}
        ).alias("value")
    )


def warehouse_rows(messages: DataFrame) -> DataFrame:
    """Bulk rows for an external warehouse table."""
    sentiment = F.struct(*[F.col(f"sent_{s}").alias(s) for s in ("neg", "neu", "pos", "compound")])
    return messages.select(
        F.col("user").alias("USERNAME"),
        F.col("message").alias("MESSAGE"),
        F.col("sent_compound").alias("COMPOUND_SCORE"),
        F.to_json(sentiment, {"ignoreNullFields": "false"}).alias("SENTIMENT_JSON"),
    )
