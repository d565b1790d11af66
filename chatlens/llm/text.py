"""Words as the contracts define them: runs of characters other than space, tab, LF, VT, FF, CR."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Words of a text; an empty array for null, empty or blank text."""
    trimmed = F.trim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", none).otherwise(F.split(trimmed, SPACE_RUN))
