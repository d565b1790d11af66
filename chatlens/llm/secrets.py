"""Secrets by dictionary-primed zstandard novelty.

Patterns find the certain secrets. The method then looks at strings in a sensitive context: behind a
name of a credential vocabulary and a sign of assignment, a string of at least ``MIN_LENGTH``
characters; on the same line within ``WINDOW`` characters of such a name, or as the password of an
address, one of at least ``MIN_TOKEN`` that mixes letters and digits and is more than words with numbers. Each different string of a
document is judged once, by its marginal compressed size: how many more bytes zstandard needs for the
code around its first place with it than without, primed with a dictionary of that code, without
further copies of the string, and of the corpus's identifiers. Names, words and placeholders
compress; a random key does not, so strings that cost nearly their own entropy are reported, at
every place where they stand in such a context.

Identifiers are counted over all documents: words of eight or more letters, so a key that is copied
across documents doesn't become one. The most frequent ``IDENTIFIERS`` are in every dictionary, a
bounded table; besides, the names in each candidate are joined with all counts, and those of
``COMMON`` or more documents are added to its own dictionary, so no name is taken for a secret because
others are more frequent. Only candidates and their surroundings are shuffled.

Defined cases: null texts are empty and have no spans; repeated rows and null ids are handled one by
one; ties in the identifier counts go by code point; other columns are ignored; an empty table gives
an empty dictionary and an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.llm.staging import scratch, stage

KINDS = ("assign", "access", "hex", "novel")
MIN_LENGTH = 16
MIN_TOKEN = 12
WINDOW = 40
CONTEXT = 200
IDENTIFIERS = 2_000
COMMON = 2
IDENTIFIER = r"(?<![A-Za-z0-9_.+/=~$-])[A-Za-z_][A-Za-z_.-]{7,39}(?![A-Za-z0-9_.+/=~$-])"
NAME = re.compile(r"[A-Za-z_][A-Za-z_.-]{7,39}")
NOVELTY = 0.7  # marginal bytes per character; base64 of random bits needs 0.75, hex 0.5

# The contract's patterns. Case is folded for ASCII letters only. The lengths of runs
# that are taken whole are asked for in the pattern, which drops the same matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
HEX_MAP = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))

# A credential word at the start of a name or of a part of it; what follows in the same word is no small letter.
VOCABULARY = r"pwd|pass(?:phrase|code)?|auth(?:orization|entication)?|bearer|basic|cred(?:ential)?s?|private|access|session|sign(?:ature|ing)|salt|key|cookie"
SENSITIVE = re.compile(rf"(?:(?<![A-Za-z])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:{VOCABULARY})(?-i:(?![a-z]))[A-Za-z0-9_]*", re.IGNORECASE | re.ASCII)
ASSIGNED = re.compile(rf"""["']?[\x20\t]*(?:=>|[:=])[\x20\t]*["']?([A-Za-z0-9+/_.=~$-]{{{MIN_LENGTH},}})""")
TOKEN = re.compile(rf"[A-Za-z0-9+/_.=~$-]{{{MIN_TOKEN},}}")
WORD_PART = re.compile(r"[A-Z]?[a-z]{4,}|[A-Z]{5,}|[_.~$/+=-]")
MIN_REST = 8
USER_INFO = re.compile(rf"://[^\s/:@]+:([^\s/@]{{{MIN_TOKEN},}})@")
SENSITIVE_HINTS = ("pwd", "pass", "auth", "bearer", "basic", "cred", "private", "access", "session", "sign", "salt", "key", "cookie", "://")

Span = tuple[int, int, int]  # start, kind, end


def certain_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind."""
    spans: list[Span] = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    if b"1" * 16 in text.encode("utf-8", "surrogatepass").translate(HEX_MAP):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


class Novelty:
    """Marginal compressed size of a string in its surroundings."""

    def __init__(self, identifiers: list[str]) -> None:
        self.known = "\n".join(identifiers).encode("utf-8", "surrogatepass")

    def __call__(self, candidate: str, around: str, names: list[str]) -> float:
        """Bytes per character that the candidate adds to the code around it; ``names``: its own known ones."""
        code, own = around.encode("utf-8", "surrogatepass"), "\n".join(names).encode("utf-8", "surrogatepass")
        primed = zstandard.ZstdCompressionDict(b"\n".join([self.known, own, code]), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False)
        added = candidate.encode("utf-8", "surrogatepass")
        return (len(packer.compress(code + added)) - len(packer.compress(code))) / max(1, len(added))


def _mixed(token: str) -> bool:
    """Letters and digits, and enough left without words and the signs between them: not a numbered name."""
    rest = WORD_PART.sub("", token)
    return len(rest) >= MIN_REST and any(c.isdigit() for c in rest) and any(c.isalpha() for c in rest)


def sensitive_places(text: str, spans: list[Span]) -> dict[str, list[int]]:
    """Strings in a sensitive context that no certain span covers, with their places."""
    lower = text.lower()
    if not any(hint in lower for hint in SENSITIVE_HINTS):
        return {}
    places = {m.span(1) for m in USER_INFO.finditer(text) if _mixed(m[1])}
    for m in SENSITIVE.finditer(text):
        if given := ASSIGNED.match(text, m.end()):
            places.add(given.span(1))
        line = text.find("\n", m.end(), m.end() + WINDOW)
        last = m.end() + WINDOW if line < 0 else line
        at = m.end()
        while (token := TOKEN.search(text, at)) and token.start() < last:
            if _mixed(token[0]):
                places.add(token.span())
            at = token.end()
    found: dict[str, list[int]] = {}
    for start, end in sorted(places):
        if not any(a < end and start < b for a, _, b in spans):
            found.setdefault(text[start:end], []).append(start)
    return found


def surroundings(text: str, start: int, end: int) -> str:
    """The code around a string, without other copies of it."""
    around = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT]
    return around.replace(text[start:end], "")


def _told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def identifier_counts(docs: DataFrame) -> DataFrame:
    """word, n: identifier-like words of all documents that occur in ``COMMON`` or more. Counted in each task before the shuffle."""
    words = F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))
    counts = docs.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= COMMON)


def identifiers(counts: DataFrame, most: int = IDENTIFIERS) -> list[str]:
    """The most frequent identifiers, fewest first, as zstandard weighs the end most. At most ``most``."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(most).collect()
    return [row["word"] for row in reversed(top)]


CANDIDATE = "struct<text: string, around: string, starts: array<bigint>, names: array<string>>"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Certain spans of every text, and what has to be judged."""
    candidate = pa.struct([("text", pa.string()), ("around", pa.string()), ("starts", pa.list_(pa.int64())), ("names", pa.list_(pa.string()))])
    types = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.list_(candidate)]
    for batch in batches:
        columns: list[list] = [[] for _ in types]
        for text in batch.column(1).to_pylist():
            text = text or ""
            base = certain_spans(text)
            open_ = [
                {"text": x, "around": surroundings(text, at[0], at[0] + len(x)), "starts": at, "names": sorted(set(NAME.findall(x)))}
                for x, at in sensitive_places(text, base).items()
            ]
            kinds = [sum(1 for _, k, _ in base if k == kind) for kind in range(3)]
            told = _told(base)
            for column, value in zip(columns, (*kinds, sha256(told.encode()).hexdigest(), told, open_)):
                column.append(value)
        arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "open"])


def _judged(novelty: Novelty):
    @F.pandas_udf("boolean")
    def judge(text: pd.Series, around: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([novelty(t, a, sorted(n)) >= NOVELTY for t, a, n in zip(text, around, names)], dtype="bool")

    return judge


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex (certain spans), base_sha256, spans, n_novel."""
    schema = f"doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base string, open array<{CANDIDATE}>"
    given = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    with scratch(docs.sparkSession):
        scanned = given.mapInArrow(_scanned, schema).withColumn("row", F.monotonically_increasing_id())
        rows = stage(scanned, keep=True)
        counts = stage(identifier_counts(given))
        open_ = stage(rows.select("row", F.inline("open")))
        wanted = open_.select("row", "text", F.explode("names").alias("word")).join(counts.select("word"), "word")
        known = wanted.groupBy("row", "text").agg(F.collect_list("word").alias("known"))
        told = open_.join(known, ["row", "text"], "left")
        names = F.coalesce("known", F.array().cast("array<string>"))
        novel = told.where(_judged(Novelty(identifiers(counts)))("text", "around", names))
        span = F.struct(F.col("start"), F.lit(KINDS[3]).alias("kind"), (F.col("start") + F.length("text")).alias("end"))
        places = novel.select("row", "text", F.explode("starts").alias("start")).select("row", span.alias("span"))
        added = stage(places.groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("added")), keep=True)
    both = rows.join(added, "row", "left")
    spans = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), _as_span)
    everything = F.array_sort(F.concat(spans, F.coalesce("added", F.array().cast("array<struct<start: bigint, kind: string, end: bigint>>"))), _in_order)
    text_of = F.transform(everything, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return both.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(text_of, ",").alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_novel"),
    )


def _as_span(told: Column) -> Column:
    parts = F.split(told, ":")
    return F.struct(parts[1].cast("long").alias("start"), parts[0].alias("kind"), parts[2].cast("long").alias("end"))


def _in_order(a: Column, b: Column) -> Column:
    """By start, then kind as listed."""
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"])
    first = F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
    return F.coalesce(first, F.when(rank(a) < rank(b), -1).when(rank(a) > rank(b), 1).otherwise(0))
