"""Record-level quality rules over JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.record import has, is_filled, is_kind, text_of
from chatlens.functions.text import evaluate_once, strip

# Field names, limits and texts of the published rules.
CURRENT_FIELDS = ("channel", "chatter_id", "message_text")
V1_FIELDS = ("user", "message")
MAX_MESSAGE_CHARS = 500
INTEGER_FIELDS = {
    "message_length": "message_length must be int",
    "source_partition": "source_partition must be int",
    "source_offset": "source_offset must be long/int",
}
SEVERE = "DLQ"
WARNING = "WARN"
CONTROL_CHARS = r"[\x00-\x08]"


def missing_fields(record: Column) -> Column:
    """Required fields that are absent or empty; names depend on the record's generation."""
    current = has(record, "message_text") | has(record, "chatter_id") | has(record, "channel")

    def unfilled(names: tuple[str, ...]) -> Column:
        return F.array_compact(
            F.array(*[F.when(~is_filled(record, n), F.lit(n)) for n in names])
        )

    return F.when(current, unfilled(CURRENT_FIELDS)).otherwise(unfilled(V1_FIELDS))


def message_size_ok(text: Column, max_chars: int = MAX_MESSAGE_CHARS) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))).between(1, max_chars)


def has_control_chars(text: Column) -> Column:
    return F.coalesce(text.rlike(CONTROL_CHARS), F.lit(False))


def record_message(record: Column) -> Column:
    """Message text as the rules see it: '' when absent, 'None' when it holds null."""
    return (
        F.when(~has(record, "message_text"), "")
        .otherwise(F.coalesce(text_of(record, "message_text"), F.lit("None")))
    )


def _issue(when: Column, code: Column | str, severity: str, detail: Column | str) -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(
        when,
        F.struct(
            as_column(code).alias("code"),
            F.lit(severity).alias("severity"),
            as_column(detail).alias("detail"),
        ),
    )


def type_issues(record: Column) -> list[Column]:
    return [
        _issue(has(record, name) & ~is_kind(record, name, "int"), f"{name}_type_invalid", SEVERE, detail)
        for name, detail in INTEGER_FIELDS.items()
    ]


def text_issues(message: Column) -> list[Column]:
    return [
        _issue(~message_size_ok(message), "message_size_out_of_range", SEVERE, "Message is empty or too long"),
        _issue(has_control_chars(message), "message_has_control_chars", WARNING, "Control characters detected"),
    ]


def assess_records(records: DataFrame, payload: str = "record") -> DataFrame:
    """Add ``missing_fields``, ``issues`` (code, severity, detail) and ``accepted``."""
    read = evaluate_once(records, _record=F.try_parse_json(F.col(payload)))
    record = F.col("_record")
    read = evaluate_once(read, missing_fields=missing_fields(record), _message=record_message(record))
    absent = F.transform(
        "missing_fields",
        lambda name: F.struct(
            F.concat(F.lit("missing_"), name).alias("code"),
            F.lit(SEVERE).alias("severity"),
            F.concat(F.lit("Required field "), name, F.lit(" is missing")).alias("detail"),
        ),
    )
    others = F.array_compact(F.array(*type_issues(record), *text_issues(F.col("_message"))))
    assessed = read.withColumn("issues", F.concat(absent, others))
    severe = F.exists("issues", lambda issue: issue["severity"] == SEVERE)
    return assessed.withColumn("accepted", ~severe).drop("_record", "_message")
