"""Chat-protocol lines to JSON envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.text import strip
from chatlens.schemas import DEFAULT_PLATFORM, ENVELOPE_VERSION

# First line marker, then its first colon, then the message.
PRIVMSG = r"(?s)^.*?PRIVMSG[^:]*:(.*)$"


def irc_filter(lines: DataFrame, line: str = "line") -> DataFrame:
    """Drop blank lines and keep-alives; lines come out stripped."""
    cleaned = lines.withColumn(line, strip(F.col(line)))
    return cleaned.filter((F.length(line) > 0) & ~F.startswith(F.col(line), F.lit("PING")))


def irc_parse(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``username`` and ``message``; both null for lines that carry no chat message."""
    text = F.col(line)
    is_chat = text.rlike(PRIVMSG)
    user = F.ltrim(F.substring_index(text, "!", 1), F.lit(":"))
    return lines.withColumns(
        {
            "username": F.when(is_chat, user),
            "message": F.when(is_chat, strip(F.regexp_extract(text, PRIVMSG, 1))),
        }
    )


def envelope_build(
    parsed_lines: DataFrame,
    server: Column,
    channel: Column,
    environment: Column,
    ingestion_ts: Column,
    line: str = "line",
) -> DataFrame:
    """Add ``value``: the envelope as JSON, with explicit nulls."""
    kind = F.when(F.col("message").isNotNull(), "chat_message").otherwise("non_chat_event")
    envelope = F.struct(
        ingestion_ts.alias("ingestion_ts"),
        F.struct(
            F.lit(DEFAULT_PLATFORM).alias("platform"),
            F.lit("irc").alias("protocol"),
            server.alias("server"),
            channel.alias("channel"),
        ).alias("source"),
        F.struct(
            F.col(line).alias("irc_line"),
            F.col("username"),
            F.col("message"),
        ).alias("raw"),
        F.struct(
            kind.alias("event_kind"),
            environment.alias("producer_env"),
            F.lit(ENVELOPE_VERSION).alias("schema_version"),
        ).alias("metadata"),
    )
    return parsed_lines.withColumn("value", F.to_json(envelope, {"ignoreNullFields": "false"}))


def iso_instant(ts: Column) -> Column:
    """ISO-8601 text with microseconds and an explicit UTC offset."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
