"""Table schemas and contract values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def _struct(**columns: str | T.StructType) -> T.StructType:
    """Columns by name; ``!`` after a type marks a required column. Needs no session."""
    return T.StructType(
        [
            T.StructField(name, kind, True)
            if isinstance(kind, T.StructType)
            else T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!"))
            for name, kind in columns.items()
        ]
    )


BRONZE_RAW = _struct(
    source_topic="string", source_partition="int", source_offset="bigint", kafka_timestamp="timestamp",
    kafka_timestamp_type="int", raw_key="string", raw_payload="string", bronze_ingestion_ts="timestamp",
)

# What a log connector delivers; file-based streams use the same columns.
LOG_RECORD = _struct(
    key="binary", value="binary", topic="string", partition="int", offset="bigint", timestamp="timestamp",
    timestampType="int",
)

CORRUPT_COLUMN = "_corrupt_payload"

ENVELOPE = _struct(
    ingestion_ts="string",
    source=_struct(platform="string", protocol="string", server="string", channel="string"),
    raw=_struct(irc_line="string", username="string", message="string"),
    metadata=_struct(event_kind="string", producer_env="string", schema_version="string"),
)

SILVER_PARSED = _struct(
    event_id="string!", source_topic="string!", source_partition="int!", source_offset="bigint!",
    event_ts="timestamp!", bronze_ingestion_ts="timestamp!", silver_processed_ts="timestamp!",
    channel="string!", chatter_id="string!", message_text="string!", message_text_normalized="string",
    message_length="int", source_platform="string",
)

SILVER_FEATURES = _struct(
    event_id="string!", token_count="int", alpha_char_count="int", numeric_char_count="int",
    link_count="int", candidate_emote_token_count="int", repeat_char_ratio="double",
    text_complexity_proxy="double", event_to_feature_latency_seconds="int",
    has_repeat_spam_pattern="boolean", engagement_signal="boolean", feature_processed_ts="timestamp",
)

DLQ = _struct(
    dlq_ingestion_ts="timestamp!", error_category="string!", error_code="string", error_detail="string!",
    retryable="boolean!", raw_payload="string!", source_topic="string", source_partition="int",
    source_offset="bigint", source_event_ts="timestamp", pipeline_stage="string!",
)

BATCH_METRICS = _struct(
    run_id="string!", job_name="string!", batch_id="bigint!", batch_processed_ts="timestamp!",
    row_count="bigint!", target_table="string!",
)

WRITE_METADATA = _struct(
    _run_id="string", _job_name="string", _batch_id="bigint", _batch_processed_ts="timestamp",
)

V1_PAYLOAD = _struct(
    user="string", message="string",
    sentiment=_struct(neg="double", neu="double", pos="double", compound="double"),
)

V1_BRONZE = _struct(
    json_payload="string", kafka_timestamp="timestamp", topic="string", partition="int", offset="bigint",
    ingest_ts="timestamp", parse_status="string", parse_error="string",
)

V1_SILVER = _struct(
    user="string", message="string", sent_neg="double", sent_neu="double", sent_pos="double",
    sent_compound="double", kafka_timestamp="timestamp", topic="string", partition="int", offset="bigint",
    message_length="int", entropy="double", repeat_char_ratio="double", alpha_ratio="double",
    is_emote_only="boolean", emote_count="int", engagement_flag="boolean", ingest_ts="timestamp",
)

BATCH_LEDGER = _struct(
    run_id="string!", job_name="string!", batch_id="bigint!", committed_ts="timestamp!", parsed_rows="bigint!",
    dlq_rows="bigint!",
)

STREAM_PROGRESS = _struct(
    run_id="string!", job_name="string!", batch_id="bigint!", input_rows="bigint!", late_rows="bigint!",
    duplicate_rows="bigint!", watermark_ts="timestamp",
)

LOG_KEY = ("topic", "partition", "offset")


def with_write_metadata(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + WRITE_METADATA.fields)


# They must equal the published contract.
DEFAULT_PLATFORM = "twitch"
ENVELOPE_VERSION = "1.0.0"
DEFAULT_DEDUPE_WATERMARK = "2 hours"
PARSE_STAGE = "silver_parse"
FEATURE_STAGE = "silver_features"
BRONZE_STAGE = "bronze_ingest"

DLQ_CATEGORIES = ("PARSE_ERROR", "CONTRACT_ERROR", "TYPE_ERROR", "QUALITY_ERROR", "UNKNOWN_ERROR")

# Default reason text of each category.
DLQ_REASONS = {
    "PARSE_ERROR": "Failed to parse raw payload as valid event envelope",
    "CONTRACT_ERROR": "Required fields missing after parse/normalize",
    "TYPE_ERROR": "Type mismatch against expected Silver contract",
    "QUALITY_ERROR": "Quality policy violation",
    "UNKNOWN_ERROR": "Unknown processing error",
}

# Fixed values: (message_type, description).
MESSAGE_TYPES = (
    ("EMOTE_ONLY", "Messages containing only emotes"),
    ("LOW_EFFORT", "Very short or low-entropy messages"),
    ("REPETITIVE_SPAM", "Messages with excessive repeated characters"),
    ("ENGAGED_CHAT", "Messages showing meaningful engagement"),
    ("OTHER", "Messages not fitting other categories"),
)

# Emote -> sentiment.
EMOTE_SENTIMENT = {
    "Kappa": -0.2,
    "PogChamp": 0.8,
    "OMEGALUL": 0.7,
    "LUL": 0.6,
    "Kreygasm": 0.7,
    "4Head": 0.1,
    "FeelsBadMan": -0.6,
    "FeelsGoodMan": 0.6,
}


@dataclass(frozen=True)
class EnvelopeContract:
    """Top-level fields of the payload: which must be there, which may, and their JSON kinds."""

    required: tuple[str, ...] = ("ingestion_ts", "source", "raw")
    expected: tuple[str, ...] = ("ingestion_ts", "source", "raw", "metadata")
    kinds: tuple[tuple[str, str], ...] = (
        ("ingestion_ts", "string"),
        ("source", "object"),
        ("raw", "object"),
        ("metadata", "object"),
    )


# Row rules of each contract dataset, as SQL predicates that must hold.
CONTRACT_RULES: dict[str, dict[str, str]] = {
    "silver_chat_parsed": {
        "required_fields_present": "channel is not null and chatter_id is not null and message_text is not null",
        "message_length_positive": "message_length > 0",
    },
    "chat_dlq": {
        "dlq_rows_must_include_raw_payload": "raw_payload is not null",
        "dlq_rows_must_include_error_context": "error_category is not null and error_detail is not null",
        "parse_failures_marked_retryable": "error_code <> 'JSON_PARSE_FAILURE' or retryable",
    },
    "streaming_batch_metrics": {
        "run_id_present": "run_id is not null",
        "job_name_present": "job_name is not null",
        "batch_id_present": "batch_id is not null",
        "row_count_non_negative": "row_count >= 0",
    },
}
