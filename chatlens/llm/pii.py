"""Personal data with a skip-chain conditional random field.

Patterns find the certain spans. The field then labels every word that holds a digit or an ``@``
(others cannot be personal data of these kinds and are fixed to none): neighbouring candidates are
linked in a chain, and words that repeat or resemble each other anywhere in the document (same
digits, or same letters without punctuation) are linked by skip edges. Loopy message passing over
both kinds of edges makes labels agree across the document, with the words of certain spans held
fixed, so a number written with a plus sign once is recognised without it elsewhere.

The weights are trained here, by pseudo-likelihood, on a bounded sample: documents whose hashed id
falls below a threshold that gives about ``TRAIN_DOCS`` documents, and at most ``TRAIN_WORDS`` of
their candidate words; the patterns give the labels. Patterns, message passing and spans cover
every document whole. Documents are independent, so nothing is shuffled.

Defined cases: null texts are empty and have no spans; repeated rows and null ids are handled one by
one; other columns are ignored; an empty table, or one without candidates, trains zero weights,
which add no spans. The work on a document is linear in its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 2_000
TRAIN_WORDS = 40_000
THRESHOLD = 0.5
ROUNDS = 8

# The contract's patterns. A run of digits is only entered at its start; the result
# is the same, since a pattern that fails there fails inside it, and long runs stay linear.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
CANDIDATE = re.compile(r"[0-9@]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = sum(sum(divmod(2 * v, 10)) for v in values[1::2])
    return (sum(values[::2]) + doubled) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches found from each @: its local part is the run of allowed characters before it."""
    taken, at = 0, text.find("@")
    while at >= 0:
        found = DOMAIN.match(text, at + 1)
        end = at + 1
        if found:
            before = text[taken:at]
            start = taken + len(before.rstrip(LOCAL))
            if start < at:
                yield 0, start, found.end()
                taken = end = found.end()
        at = text.find("@", end)


def certain_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind and start."""
    spans = list(_emails(text)) if "@" in text else []
    if not DIGIT.search(text):
        return spans
    if "." in text:
        for m in IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
                spans.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


# --- candidate words -----------------------------------------------------------------------

SLOTS = (997, 997, 96, 32, 16, 1)  # feature families and their sizes
CONTEXT_FAMILIES = [1, 5]  # the word before, and the constant
OFFSETS = np.cumsum((0, *SLOTS[:-1]))
WIDTH = sum(SLOTS)
LABELS = len(KINDS) + 1
EDGE = ",.;:!?()[]{}<>\"'"
MIN_DIGITS = 7  # shorter numbers repeat by chance
SHAPE = ((re.compile(f"[0-9]{{{MIN_DIGITS},}}"), "N"), (re.compile("[0-9]+"), "9"), (re.compile(r"[^\W\dN_]+"), "a"))


@dataclass
class Candidates:
    """The candidate words of one document."""

    start: np.ndarray
    end: np.ndarray
    features: np.ndarray  # words x families
    known: np.ndarray  # label of the certain span, or 0
    chain: np.ndarray  # word is next to the candidate before it
    skip: np.ndarray  # index of the previous similar word, or -1


def _hash(text: str, size: int) -> int:
    return zlib.crc32(text.encode()) % size


def _similar(word: str) -> str:
    """What similar words share: their last digits, or the letters and signs inside an address."""
    if "@" in word:
        return word.lower()
    digits = re.sub("[^0-9]", "", word)
    return digits[-MIN_DIGITS:] if len(digits) >= MIN_DIGITS else ""


def candidates(text: str, spans: list[Span]) -> Candidates | None:
    if not CANDIDATE.search(text):
        return None
    rows: list[tuple] = []
    seen: dict[str, int] = {}
    before, adjacent, position = "", False, 0
    ordered = sorted(spans, key=lambda s: s[1])
    for m in WORD.finditer(text):
        word = m[0]
        if not CANDIDATE.search(word):
            before, adjacent = word, False
            continue
        core = word.strip(EDGE) or word
        start = m.start() + (len(word) - len(word.lstrip(EDGE)) if word.strip(EDGE) else 0)
        end = start + len(core)
        while position < len(ordered) and ordered[position][2] <= start:
            position += 1
        known = next((k + 1 for k, a, b in ordered[position : position + 4] if a < end and start < b), 0)
        digits = len(DIGIT.findall(core))
        shape = core
        for pattern, sign in SHAPE:
            shape = pattern.sub(sign, shape)
        signs = ("@" in core) + 2 * core.startswith("+") + 4 * min(core.count("."), 3) + 16 * ("-" in core)
        if 13 <= digits <= 19:  # a number as long as a card's, and whether its check digit holds
            signs += 64 if luhn("".join(DIGIT.findall(core))) else 32
        key = _similar(core)
        families = (
            _hash(shape[:24], SLOTS[0]), _hash(before.strip(EDGE).lower()[:24], SLOTS[1]), signs,
            min(digits, SLOTS[3] - 1), min(len(core) // 2, SLOTS[4] - 1), 0,
        )
        rows.append((start, end, families, known, adjacent, seen.get(key, -1) if key else -1))
        if key:
            seen[key] = len(rows) - 1
        before, adjacent = word, True
    start, end, features, known, chain, skip = zip(*rows)
    return Candidates(
        np.array(start), np.array(end), np.array(features) + OFFSETS, np.array(known), np.array(chain), np.array(skip)
    )


# --- the field -----------------------------------------------------------------------------


@dataclass
class Field:
    """Log potentials of a word's features, of neighbours, and of similar words."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _tied(gradient: np.ndarray) -> np.ndarray:
    """Skip edges have three weights: both none, the same kind, or different labels."""
    same = np.eye(LABELS, dtype=bool)
    kind = same.copy()
    kind[0, 0] = False
    out = np.empty_like(gradient)
    for cells in (kind, ~same, same & ~kind):
        out[cells] = gradient[cells].sum()
    return out


def train(features: np.ndarray, label: np.ndarray, left: np.ndarray, similar: np.ndarray, rounds: int = 600) -> Field:
    """Pseudo-likelihood: each word's label given its features and the labels it is linked to.

    ``left`` and ``similar`` are the rows linked by chain and skip edges, -1 for none. Words that
    are unlabelled but similar to a labelled one are what the field is to decide; they don't train.
    Every other round hides the word itself, so the edges learn to carry a label on their own.
    """
    field = Field(np.zeros((WIDTH, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    n = len(label)
    if not n:
        return field
    hot = np.eye(LABELS)[label]
    has_left, has_similar = np.flatnonzero(left >= 0), np.flatnonzero(similar >= 0)
    doubtful = np.zeros(n, dtype=bool)
    a, b = has_similar, similar[has_similar]
    doubtful[a[(label[a] == 0) & (label[b] > 0)]] = True
    doubtful[b[(label[b] == 0) & (label[a] > 0)]] = True
    use = ~doubtful
    sums = [np.zeros_like(x) for x in (field.unary, field.chain, field.skip)]
    for turn in range(rounds):
        seen = features if turn % 2 else features[:, CONTEXT_FAMILIES]
        score = field.unary[seen].sum(axis=1)
        np.add.at(score, has_left, field.chain[label[left[has_left]]])
        np.add.at(score, left[has_left], field.chain[:, label[has_left]].T)
        np.add.at(score, a, field.skip[label[b]])
        np.add.at(score, b, field.skip[label[a]])
        error = (hot - _softmax(score)) * use[:, None]
        unary, chain, skip = (np.zeros_like(x) for x in (field.unary, field.chain, field.skip))
        np.add.at(unary, seen, error[:, None, :])
        np.add.at(chain, label[left[has_left]], error[has_left])
        np.add.at(chain.T, label[has_left], error[left[has_left]])
        np.add.at(skip, label[b], error[a])
        np.add.at(skip, label[a], error[b])
        for weights, step, total in zip((field.unary, field.chain, field.skip), (unary, chain, _tied(skip)), sums):
            step = step / n - 1e-5 * weights
            total += step * step
            weights += 0.5 * step / np.sqrt(total + 1e-12)
    return field


def marginals(field: Field, found: Candidates) -> np.ndarray:
    """Label probabilities after loopy message passing over chain and skip edges."""
    n = len(found.start)
    own = field.unary[found.features].sum(axis=1)
    fixed = found.known > 0
    own[fixed] = -50.0
    own[fixed, found.known[fixed]] = 0.0
    chain, skip = np.flatnonzero(found.chain), np.flatnonzero(found.skip >= 0)
    source = np.concatenate([chain - 1, chain, found.skip[skip], skip])
    target = np.concatenate([chain, chain - 1, skip, found.skip[skip]])
    back = np.concatenate([np.arange(len(chain)) + len(chain), np.arange(len(chain)),
                           2 * len(chain) + len(skip) + np.arange(len(skip)), 2 * len(chain) + np.arange(len(skip))])
    table = np.concatenate([
        np.broadcast_to(field.chain, (len(chain), LABELS, LABELS)), np.broadcast_to(field.chain.T, (len(chain), LABELS, LABELS)),
        np.broadcast_to(field.skip, (2 * len(skip), LABELS, LABELS)),
    ])
    message = np.zeros((len(source), LABELS))
    for _ in range(ROUNDS if len(source) else 0):
        belief = own.copy()
        np.add.at(belief, target, message)
        out = (belief[source] - message[back])[:, :, None] + table
        top = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        message = 0.5 * message + 0.5 * new
    np.add.at(own, target, message)
    return _softmax(own) if n else own


def added_spans(field: Field, text: str, spans: list[Span]) -> list[Span]:
    """Spans of words the field labels with confidence and no certain span covers; neighbours merge."""
    found = candidates(text, spans)
    if found is None:
        return []
    probability = marginals(field, found)
    label = np.where(probability.max(axis=1) >= THRESHOLD, probability.argmax(axis=1), 0)
    label[found.known > 0] = 0
    merged: list[Span] = []
    for k in np.flatnonzero(label):
        kind, start, end = int(label[k]) - 1, int(found.start[k]), int(found.end[k])
        if merged and found.chain[k] and label[k - 1] == label[k] and merged[-1][2] == found.end[k - 1]:
            merged[-1] = (kind, merged[-1][1], end)
        else:
            merged.append((kind, start, end))
    return merged


# --- tables --------------------------------------------------------------------------------


def _told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def fit(docs: DataFrame) -> Field:
    """Train the field on the bounded sample."""
    total = docs.count()
    if not total:
        return train(*(np.zeros((0, len(SLOTS)), dtype=int), *(np.zeros(0, dtype=int) for _ in range(3))))
    parts = 1 << 30
    share = min(parts, TRAIN_DOCS * parts // total)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("pii")), F.lit(parts)) < share).where(F.col("text").rlike("[0-9@]"))

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["text"]:
                found = candidates(text, certain_spans(text))
                if found is not None:
                    n = len(found.start)
                    yield pd.DataFrame({
                        "features": list(found.features), "label": found.known,
                        "left": np.where(found.chain, 1, 0), "similar": np.where(found.skip >= 0, np.arange(n) - found.skip, 0),
                    })

    schema = "features array<long>, label long, left long, similar long"
    kept = sample.select("text").mapInPandas(rows, schema).limit(TRAIN_WORDS).toPandas()
    if kept.empty:
        return train(np.zeros((0, len(SLOTS)), dtype=int), *(np.zeros(0, dtype=int) for _ in range(3)))
    at = np.arange(len(kept))
    links = [np.where(kept[c] > 0, at - kept[c], -1).astype(int) for c in ("left", "similar")]
    return train(np.stack(kept["features"].to_numpy()), kept["label"].to_numpy(int), *(np.maximum(x, -1) for x in links))


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (certain spans), base, spans, n_added, base_sha256."""
    field = field or fit(docs)
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(len(KINDS) + 3)]
            for text in batch.column(1).to_pylist():
                base = certain_spans(text or "")
                more = added_spans(field, text or "", base)
                kinds = [sum(1 for k, _, _ in base if k == kind) for kind in range(len(KINDS))]
                row = (*kinds, sha256(_told(base).encode()).hexdigest(), _told(base + more), len(more))
                for column, value in zip(columns, row):
                    column.append(value)
            types = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"]
    schema = f"doc_id long, {counts}, base_sha256 string, spans string, n_added long"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, schema)
