"""Building blocks for text columns. All of them are JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character the contract's helpers treat as white space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def evaluate_once(df: DataFrame, **values: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever reads them later.

    A plain ``withColumn`` is substituted into every filter above it, so an expensive
    expression (JSON parsing, regexes over whole texts) would run again per filter.
    A one-row generator keeps it in one place and stays inside generated code.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select("*", F.inline(F.array(row)))


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends, in linear time."""
    return F.trim(text, F.lit(SPACE_CHARS))


def squeeze(text: Column) -> Column:
    """Strip, and turn each inner run of white space into one space."""
    return F.regexp_replace(strip(text), f"[{SPACE_CLASS}]+", " ")


def blank_to_null(text: Column, lower: bool = False) -> Column:
    """Trim spaces, optionally lower-case, and turn an empty result into null."""
    cleaned = F.trim(text)
    if lower:
        cleaned = F.lower(cleaned)
    return F.nullif(cleaned, F.lit(""))


def words(text: Column) -> Column:
    """White-space separated words; an empty array for null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+")
    return F.filter(parts, lambda part: part != "")


# A long text's first characters hold nearly all the letters it is made of.
LONG_TEXT, HEAD = 256, 256


def char_counts(text: Column) -> Column:
    """How often each distinct character occurs (array<int>, order irrelevant).

    The ASCII characters at the head of a long text are taken out of it one after the other; each was there
    as often as that makes the text shorter. What is left is little, unless it is of another script.
    """
    head = F.regexp_replace(F.substring(text, 1, HEAD), r"[^\x00-\x7F]+", "")

    def take(state: Column, char: Column) -> Column:
        left = F.replace(state["left"], char, F.lit(""))
        return F.struct(left.alias("left"), F.concat(state["sizes"], F.array(F.octet_length(state["left"]))).alias("sizes"))

    def counted(state: Column) -> Column:
        after = F.concat(F.slice(state["sizes"], F.lit(2), F.size(state["sizes"])), F.array(F.octet_length(state["left"])))
        taken = F.zip_with(state["sizes"], after, lambda one, next_one: one - next_one)
        return F.concat(F.filter(taken, lambda n: n > 0), _sorted_counts(state["left"]))

    start = F.struct(text.alias("left"), F.array().cast("array<int>").alias("sizes"))
    by_char = F.aggregate(F.array_distinct(F.split(head, "")), start, take, counted)
    return F.when(F.octet_length(text) < LONG_TEXT, _sorted_counts(text)).otherwise(by_char)


def _sorted_counts(text: Column) -> Column:
    """Sorting the characters makes equal ones adjacent; each run is one character's count."""
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1*"), F.lit(0))
    return F.transform(runs, lambda run: F.length(run))


def longest_run(text: Column) -> Column:
    """Length of the longest run of one character; 0 for empty text."""
    runs = F.regexp_extract_all(text, F.lit(r"(?s)(.)\1+"), F.lit(0))
    longest = F.array_max(F.transform(runs, lambda run: F.length(run)))
    return F.when(F.length(text) == 0, 0).otherwise(F.coalesce(longest, F.lit(1)))


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, null where whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
