"""Reading loosely typed JSON records through VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON kind -> what its variant schema looks like. A flag counts as an integer, as it does
# for the checks whose results these must equal.
KIND_PATTERNS = {
    "string": r"^STRING$",
    "object": r"^OBJECT<",
    "array": r"^ARRAY<",
    "bool": r"^BOOLEAN$",
    "int": r"^(BIGINT|BOOLEAN|DECIMAL\(\d+,0\))$",
    "float": r"^(DOUBLE|FLOAT|DECIMAL\(\d+,[1-9]\d*\))$",
}


def field(record: Column, name: str) -> Column:
    """One top-level field, still a variant; null when absent."""
    return F.try_variant_get(record, f"$.{name}", "variant")


def kind(record: Column, name: str) -> Column:
    """Variant schema of a field; null when absent, VOID when it holds null."""
    return F.schema_of_variant(field(record, name))


def has(record: Column, name: str) -> Column:
    return field(record, name).isNotNull()


def has_value(record: Column, name: str) -> Column:
    return F.coalesce(kind(record, name) != "VOID", F.lit(False))


def is_kind(record: Column, name: str, expected: str) -> Column:
    return F.coalesce(kind(record, name).rlike(KIND_PATTERNS[expected]), F.lit(False))


def text_of(record: Column, name: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", "string")


def is_filled(record: Column, name: str) -> Column:
    """False for an absent field, null, '', 0, false and empty containers."""
    shape = kind(record, name)
    text = text_of(record, name)
    filled = (
        F.when(shape.isNull() | (shape == "VOID"), False)
        .when(shape == "STRING", F.length(text) > 0)
        .when(shape == "BOOLEAN", text == "true")
        .when(shape.rlike("^(ARRAY|OBJECT)<"), ~text.isin("[]", "{}"))
        .otherwise(text.try_cast("double") != 0)
    )
    return F.coalesce(filled, F.lit(False))
