"""Text profile of a message: the second, stricter feature set of the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.text import SPACE_CLASS, char_counts, strip

DEFAULT_SPAM_SHARE = 0.35

# Token shapes. A final line feed inside a token does not break the match.
EMOTE_SHAPE = r"^[A-Za-z0-9_]{2,24}\n?\z"
LINK = rf"(?iu)https?://[^{SPACE_CLASS}]"
FOUR_IN_A_ROW = r"([^\n])\1{3,}"


def profile_tokens(text: Column) -> Column:
    """Split on single spaces; other white space stays inside a token."""
    return F.filter(F.split(strip(text), " "), lambda token: token != "")


def contains_link(text: Column) -> Column:
    return F.coalesce(text.rlike(LINK), F.lit(False))


def with_text_profile(
    df: DataFrame, text: str = "message_text", spam_share: float = DEFAULT_SPAM_SHARE
) -> DataFrame:
    """Add the profile columns; null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = df.withColumns({"_whole": whole, "_body": strip(whole)})
    measured = base.withColumns(
        {
            "profile_message_length": F.length("_body"),
            "profile_tokens": profile_tokens(F.col("_body")),
            "_counts": char_counts(F.col("_body")),
            "contains_link": contains_link(F.col("_whole")),
            "_four_in_a_row": F.col("_whole").rlike(FOUR_IN_A_ROW),
        }
    )
    size = F.col("profile_message_length")
    tokens = F.col("profile_tokens")
    frequent = F.aggregate(
        F.filter("_counts", lambda n: n > 2), F.lit(0), lambda acc, n: acc + n
    )
    rated = measured.withColumns(
        {
            "frequent_char_share": F.when(size > 0, F.round(frequent / size, 4)).otherwise(0.0),
            "entropy_proxy": F.when(
                size > 0, F.round(F.log2(F.size("_counts").cast("double")), 4)
            ).otherwise(0.0),
            "profile_emote_count": F.size(
                F.filter(tokens, lambda t: t.rlike(EMOTE_SHAPE) & t.rlike("[A-Z]"))
            ),
            "profile_is_emote_only": (F.size(tokens) > 0)
            & F.forall(tokens, lambda t: t.rlike(EMOTE_SHAPE)),
        }
    )
    return rated.withColumns(
        {
            "profile_spam": F.col("_four_in_a_row") | (F.col("frequent_char_share") >= spam_share),
            "profile_engagement": (size >= 2)
            & (F.col("entropy_proxy") >= 1.0)
            & (F.col("frequent_char_share") < 0.7),
        }
    ).drop("_whole", "_body", "_counts", "_four_in_a_row")
