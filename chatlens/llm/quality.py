"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once; a document's failures
are one long whose bit k is set when rule k fails. Policies are versioned sets of rules, so
applying one, or asking what a rule contributes, is bit arithmetic on the ledger and never
touches the texts again. Only DataFrame functions are used; the ledger needs no shuffle.

Defined cases: a null text has no words; an empty text has no words and no lines; repeated
rows and null ids give one ledger row each; other columns of the input are ignored, whatever
their names; an empty table gives an empty ledger. A text is one row, however long it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.functions.text import evaluate_once
from chatlens.llm.text import WORD_CHAR, words

WINDOW = 8

# name -> failure condition over the measurements; the position is the bit. Append only:
# a bit keeps its meaning in stored ledgers.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("upper_case", "2 * n_upper > word_chars"),
)

# version -> rules whose failure rejects a document. Versions are never edited.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v2": tuple(name for name, _ in RULES),
}
CURRENT = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")


def mask(names: Sequence[str]) -> int:
    """The bits of some rules."""
    position = {name: k for k, (name, _) in enumerate(RULES)}
    return sum(1 << position[name] for name in names)


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _with_partner(hashes: Column, span: int) -> Column:
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + span)))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside windows that occur at least twice.

    A window of eight words gets a 64-bit hash by doubling the hashed span three times; entries
    without a partner lie beyond the last window and are cut. Only texts with a repeated hash sort
    their windows: equal ones then stand side by side, and the gaps between repeated positions,
    eight at most, add up to the words they cover.
    """
    long_enough = F.size("_words") >= WINDOW
    df = evaluate_once(df, _h1=F.when(long_enough, F.transform("_words", lambda w: F.xxhash64(w))))
    for span in (1, 2, 4):
        df = evaluate_once(df, **{f"_h{2 * span}": _with_partner(F.col(f"_h{span}"), span)})
    df = evaluate_once(df, _h=F.slice("_h8", F.lit(1), F.size("_words") - (WINDOW - 1)))
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    indexed = F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = evaluate_once(df, _sorted=F.when(repeated, F.sort_array(indexed)))
    at = F.col("_sorted")

    def is_repeat(x: Column, k: Column) -> Column:
        before, after = F.get(at, k - 1)["h"], F.get(at, k + 1)["h"]
        return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

    positions = F.sort_array(F.transform(F.filter(at, is_repeat), lambda x: x["i"]))
    df = evaluate_once(df, _at=positions)
    covered = F.transform(
        "_at", lambda i, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), i - F.get(F.col("_at"), k - 1)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return evaluate_once(df, n_repeat_words=F.coalesce(total, F.lit(0).cast("long")))


def _measured(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Add the measurements of ``_text`` and ``fail_bits``; the other columns ride along."""
    df = evaluate_once(df.withColumn("_text", F.coalesce("_text", F.lit(""))), _words=words(F.col("_text")))
    df = evaluate_once(df, _lines=F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD_CHAR)))
    df = evaluate_once(
        _repeat_words(df),
        n_words=F.size("_words").cast("long"),
        word_chars=F.length(F.array_join("_words", "")).cast("long"),
        n_symbols=_removed(F.col("_text"), "[#*$%&|<>]+").cast("long"),
        n_upper=_removed(F.col("_text"), r"\p{Lu}+").cast("long"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    )
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, rule) in enumerate(rules)]
    return df.withColumn("fail_bits", reduce(lambda x, y: x.bitwiseOR(y), bits))


def ledger(docs: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row per document: doc_id, the measurements, and the failed rules as ``fail_bits``."""
    measured = _measured(docs.select(docs["doc_id"], docs["text"].alias("_text")), rules)
    return measured.select("doc_id", *MEASURES, "fail_bits")


def apply_policy(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """Add ``kept``: no rule of the policy failed. Reads the bits only."""
    rejecting = F.lit(mask(POLICIES[version])).cast("long")
    return entries.withColumn("kept", F.col("fail_bits").bitwiseAND(rejecting) == 0)


def ablations(entries: DataFrame, version: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: documents it rejects, and those only it rejects.

    The ledger is first counted by bit pattern, at most 2^rules rows, so a hot pattern is summed
    where it lies and the rules are applied to the patterns.
    """
    names = POLICIES[version]
    patterns = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    rejecting = F.lit(mask(names)).cast("long")
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask([n])).cast("long").alias("bit")) for n in names]))
    failed = F.col("fail_bits").bitwiseAND(rejecting)
    rows = patterns.select("n", failed.alias("failed"), rules.alias("r")).select("n", "failed", "r.rule", "r.bit")
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    only = F.col("failed") == F.col("bit")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return rows.groupBy("rule").agg(
        F.sum("n").alias("documents"),
        total(F.col("failed") != 0).alias("rejected_by_policy"),
        total(hit).alias("rejected_by_rule"),
        total(only).alias("rejected_only_by_rule"),
    )


def select_kept(docs: DataFrame, version: str = CURRENT) -> DataFrame:
    """The documents a policy keeps, with all their columns.

    The row travels as one struct beside its measurements, so no name can clash and nothing is joined.
    """
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["text"].alias("_text"))
    return apply_policy(_measured(packed, RULES), version).where("kept").select("_row.*")
