"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over the words of the benchmark; words outside it only add to a
passage's length. A distributed randomised SVD gives a latent space: every task adds up its share
of A'AQ for its passages, the shares meet by term, and two rounds yield the leading directions. The
cosine of every passage with every item is taken through that space, and passages above ``COSINE``
are candidates. Items of which the space holds less than ``HELD`` get directions of their own, so it
tells all items of a block apart. Passages that share ``GRAM`` words in a row with an item are
candidates whatever their cosine, so a copy is never left to the weights of its words; for shorter
items the row is the whole item. A candidate is checked word by word: the longest common subsequence with the item
must cover ``COPY`` of it, or ``PARAPHRASE`` of it and ``COPY`` of its answer, its last sentence.

Passages come in sizes of one and a half times the next power of two above an item's length, half
of that power apart, so each occurrence of an item lies wholly inside one passage of its size.
Document frequencies count all documents; the SVD is an index fitted on a bounded sample, about
``FIT_DOCS`` documents chosen by hashed id, and on all items; retrieval and checks cover every
passage of every document. Items are taken in blocks of ``ITEM_BLOCK``, each a pass over the
documents, so what travels to the tasks is bounded however long the benchmark is. A passage is
projected only for items it shares enough rare words with: both checks allow at most so many of an
item's words to be missing, so some of its rarest words must be there (``Overlap``), which loses
nothing. Nothing is joined or shuffled but sums by term.

Defined cases: null or empty texts and items have no words and match nothing; items under
``MIN_ITEM`` words match only if they occur whole; a document holding several items gives one row
for each; repeated rows and null ids give rows of their own; other columns are ignored, and
``clean`` keeps them all; an empty table or benchmark gives no rows, and ``clean`` keeps everything.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlens.llm.staging import stage

RANK = 192
OVERSAMPLING = 16
FIT_DOCS = 10_000
COMMON = 0.25  # share of the documents above which a term is left out where items can spare it
SMOOTHING = 0.05  # bounds how much rarer a term can look, so items that leak often keep their weight
COSINE = 0.3
COPY = 0.8
PARAPHRASE = 0.6
MIN_ITEM = 8
ITEM_BLOCK = 2 * RANK  # bounds the directions that the items of a block can need besides
HELD = 0.95
GRAM = 4
NEEDED = 0.2  # share of an item's words, of its rarest, that a passage must hold to be projected
GROUP_WORDS = 1 << 16

_PUNCTUATION = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION).split()


def common_words(masks: dict[bytes, int], passage: list[bytes]) -> int:
    """Length of the longest common subsequence; ``masks`` has each word's positions as bits."""
    full = row = (1 << masks[b""]) - 1
    for word in passage:
        if hit := masks.get(word):
            row = (row + (row & hit)) | (row & ~hit)
    return (full & ~row).bit_count()


def position_masks(words: list[bytes]) -> dict[bytes, int]:
    """Words -> bits of their positions; the empty word, which no text has, maps to the length."""
    masks: dict[bytes, int] = {}
    for k, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << k
    masks[b""] = len(words)
    return masks


@dataclass
class Items:
    """One block of the benchmark."""

    ids: list[int | None]
    words: list[list[bytes]]
    masks: list[dict[bytes, int]]
    answers: list[dict[bytes, int]]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        kept = [(i, words_of(t), t or "") for i, t in rows]
        kept = [x for x in kept if x[1]]
        parts = [[w for w in map(words_of, re.split(r"[.!?\n]+", t)) if w] for _, _, t in kept]
        vocabulary: dict[bytes, int] = {}
        for _, words, _ in kept:
            for word in words:
                vocabulary.setdefault(word, len(vocabulary))
        return cls(
            [i for i, _, _ in kept], [w for _, w, _ in kept], [position_masks(w) for _, w, _ in kept],
            [position_masks(p[-1]) for p in parts], vocabulary,
        )

    def check(self, k: int, passage: list[bytes]) -> tuple[int, str | None]:
        """Common words of item k and a passage, and what that makes of it."""
        n = len(self.words[k])
        common = common_words(self.masks[k], passage)
        if n < MIN_ITEM:
            whole = b" ".join([b"", *self.words[k], b""]) in b" ".join([b"", *passage, b""])
            return common, "copy" if whole else None
        if common >= COPY * n:
            return common, "copy"
        answer = self.answers[k]
        if common >= PARAPHRASE * n and common_words(answer, passage) >= COPY * answer[b""]:
            return common, "paraphrase"
        return common, None


def _groups(texts: list[str | None], vocabulary: dict[bytes, int]) -> Iterator[tuple[list[int], list[list[bytes]], np.ndarray, np.ndarray]]:
    """Texts in groups of bounded size: row numbers, words, term ids (-1: other), first word of each text and the end."""
    rows: list[int] = []
    words: list[list[bytes]] = []
    held = 0
    for row, text in enumerate(texts):
        own = words_of(text)
        if own:
            rows.append(row)
            words.append(own)
            held += len(own)
        if held and (held >= GROUP_WORDS or row == len(texts) - 1):
            yield rows, words, *_encoded(words, vocabulary)
            rows, words, held = [], [], 0
    if held:
        yield rows, words, *_encoded(words, vocabulary)


def _encoded(words: list[list[bytes]], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ids = np.concatenate([np.fromiter(map(vocabulary.get, own, repeat(-1)), dtype=np.int32, count=len(own)) for own in words])
    return ids, np.concatenate([[0], np.cumsum(lengths)])


def document_frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """Documents with each term, and documents with any word, over the whole table."""
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            for _, words, ids, bounds in _groups(batch.column(0).to_pylist(), vocabulary):
                total[size] += len(words)
                doc = np.repeat(np.arange(len(words)), np.diff(bounds))
                seen = np.unique(doc[ids >= 0] * np.int64(size) + ids[ids >= 0])
                total[:size] += np.bincount(seen % size, minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "n"])

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(size + 1, dtype=np.int64)
    total[sums["term"].to_numpy(int)] = sums["n"].to_numpy(int)
    return total[:size], int(total[size])


def _normal_product(ids: np.ndarray, row: np.ndarray, n: int, weight: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and rows of A'AQ, where A has one unit vector for each of n passages; row: each word's passage."""
    use = ids >= 0
    use[use] = weight[ids[use]] > 0
    ids, row = ids[use], row[use]
    if not len(ids):
        return np.zeros(0, dtype=np.int64), np.zeros((0, basis.shape[1]))
    key, tf = np.unique(row * np.int64(len(weight)) + ids, return_counts=True)
    row, ids = key // len(weight), key % len(weight)
    value = tf * weight[ids]
    value /= np.sqrt(np.bincount(row, weights=value * value, minlength=n))[row]
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    projected = np.add.reduceat(basis[ids] * value[:, None], starts, axis=0)
    spread = projected[np.cumsum(np.concatenate([[0], row[1:] != row[:-1]]))] * value[:, None]
    order = np.argsort(ids, kind="stable")
    terms = ids[order]
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    return terms[starts], np.add.reduceat(spread[order], starts, axis=0)


def _corpus_product(sample: DataFrame, vocabulary: dict[bytes, int], weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'AQ over the passages of the sample: summed in the tasks, then by term."""
    width = basis.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(basis)
        for batch in batches:
            for _, _, ids, bounds in _groups(batch.column(0).to_pylist(), vocabulary):
                lengths = np.diff(bounds)
                passages = -(-lengths // 64)
                first = np.concatenate([[0], np.cumsum(passages)])
                inside = np.arange(len(ids)) - np.repeat(bounds[:-1], lengths)
                terms, rows = _normal_product(ids, np.repeat(first[:-1], lengths) + inside // 64, int(first[-1]), weight, basis)
                total[terms] += rows
        yield from packed(np.flatnonzero(total.any(axis=1)), total)

    def packed(found: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        vectors = [total[k].tobytes() for k in found]
        yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.int64()), pa.array(vectors, type=pa.binary())], ["term", "vector"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(basis)
        for batch in batches:
            for term, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[term] += np.frombuffer(vector)
        yield from packed(np.flatnonzero(total.any(axis=1)), total)

    shares = sample.select("text").mapInArrow(add, "term long, vector binary")
    sums = shares.repartition("term").mapInArrow(meet, "term long, vector binary").toPandas()
    total = np.zeros((len(vocabulary), width))
    for term, vector in zip(sums["term"], sums["vector"]):
        total[term] = np.frombuffer(vector)
    return total


@dataclass
class Index:
    """Term weights, latent coordinates of terms, and of items."""

    items: Items
    weight: np.ndarray
    other: float  # weight of a word outside the benchmark
    terms: np.ndarray
    latent: np.ndarray
    norms: np.ndarray
    grams: list[tuple[int, np.ndarray, np.ndarray]]  # words in a row: how many, their sorted keys, the item of each
    overlaps: list[Overlap]

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, int, str, int, int]]:
        """row, item, cosine, common words, kind, first and last word (exclusive) of the passage."""
        for rows, words, ids, bounds in _groups(texts, self.items.vocabulary):
            best: dict[tuple[int, int], tuple] = {}
            for doc, item, cosine, start, end in self._candidates(ids, bounds):
                known = best.get((doc, item))
                if known and (known[3] == "copy" or known[3] and known[1] >= cosine):
                    continue
                common, kind = self.items.check(item, words[doc][start:end])
                if kind and (not known or (kind == "copy", common) > (known[3] == "copy", known[2])):
                    best[doc, item] = (item, cosine, common, kind, start, end)
            for doc, item, start, end in self._shared(ids, bounds):
                known = best.get((doc, item))
                if known and known[3] == "copy":
                    continue
                common, kind = self.items.check(item, words[doc][start:end])
                if kind and (not known or (kind == "copy", common) > (known[3] == "copy", known[2])):
                    first = bounds[doc] + start
                    best[doc, item] = (item, self._cosine(ids[first : first + end - start], item), common, kind, start, end)
            for (doc, _), found in sorted(best.items()):
                yield rows[doc], *found

    def _shared(self, ids: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, first and last word of every passage with words in a row that the item has."""
        n = np.diff(bounds)
        doc_of = np.repeat(np.arange(len(n)), n)
        seen: set[tuple[int, int, int]] = set()
        for size, keys, items in self.grams:
            at = _rows_of_words(ids, doc_of, size)
            own = _gram_keys(ids, at, size)
            low, high = np.searchsorted(keys, own), np.searchsorted(keys, own, side="right")
            for k in np.flatnonzero(low < high):
                doc = int(doc_of[at[k]])
                inside = int(at[k] - bounds[doc])
                for item in items[low[k] : high[k]].tolist():
                    step = max(8, 1 << (len(self.items.words[item]) - 1).bit_length()) // 2
                    for block in range(max(0, -(-(inside + size) // step) - 3), inside // step + 1):
                        if (doc, item, block) not in seen:
                            seen.add((doc, item, block))
                            yield doc, item, block * step, min((block + 3) * step, int(n[doc]))

    def _cosine(self, ids: np.ndarray, item: int) -> float:
        """Through the space, as the candidates have it."""
        known = ids[ids >= 0]
        mass = (self.weight[known] ** 2).sum() + (len(ids) - len(known)) * self.other**2
        return float(self.terms[known].sum(axis=0) @ self.latent[item] / max(np.sqrt(mass) * self.norms[item], 1e-9))

    def _candidates(self, ids: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """Text, item, cosine, first and last word of every passage near an item that it may hold by its rare words."""
        n = np.diff(bounds)
        for own in self.overlaps:
            for doc, item, start in own.passages(ids, bounds):
                end = min(start + 3 * own.step, int(n[doc]))
                cosine = self._cosine(ids[bounds[doc] + start : bounds[doc] + end], item)
                if cosine >= COSINE:
                    yield doc, item, cosine, start, end


@dataclass
class Overlap:
    """What a passage must share with an item of one size before it is projected.

    A check passes only if ``least_common`` of the item's words are common, so at most the rest of them are
    missing. Of the item's rarest words, as many as may be missing and ``needed`` more, a passage must
    therefore hold ``needed``: that drops no passage that a check would take.
    """

    step: int  # words of a block; passages are three blocks, or a shorter text
    needed: np.ndarray  # by item
    first: np.ndarray  # term -> its first entry in items
    items: np.ndarray  # the items that have the term among their rarest words, by term

    def passages(self, ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
        """Text, item and first word."""
        n = np.diff(bounds)
        blocks = -(-n // self.step)
        start_of = np.concatenate([[0], np.cumsum(blocks)])
        held = np.diff(self.first)
        at = np.flatnonzero(ids >= 0)
        at = at[held[ids[at]] > 0]
        doc = np.searchsorted(bounds, at, side="right") - 1
        block = start_of[doc] + (at - bounds[doc]) // self.step
        times = held[ids[at]]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item = self.items[np.repeat(self.first[ids[at]], times) + inside]
        key, count = np.unique(np.repeat(block, times) * len(self.needed) + item, return_counts=True)
        block, item = key // len(self.needed), key % len(self.needed)
        doc = np.searchsorted(start_of, block, side="right") - 1
        keys, counts = [], []
        for back in range(3):
            start = block - back
            whole = (start >= start_of[doc]) & ((start == start_of[doc]) | (start + 3 <= start_of[doc + 1]))
            keys.append((start * len(self.needed) + item)[whole])
            counts.append(count[whole])
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate(counts), minlength=len(key))
        found = key[total >= self.needed[key % len(self.needed)]]
        start, item = found // len(self.needed), found % len(self.needed)
        doc = np.searchsorted(start_of, start, side="right") - 1
        return list(zip(doc.tolist(), item.tolist(), ((start - start_of[doc]) * self.step).tolist()))


def least_common(n: int) -> int:
    """Words of an item of n words that a passage must have in common with it to pass a check."""
    return n if n < MIN_ITEM else int(np.ceil(PARAPHRASE * n - 1e-9))


def overlaps(items: Items, frequency: np.ndarray) -> list[Overlap]:
    """One for each size of passages."""
    lengths = np.array([len(w) for w in items.words])
    power = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(int))
    found = []
    for size in np.unique(power):
        needed = np.full(len(lengths), np.iinfo(np.int64).max)
        pairs: list[np.ndarray] = []
        for k in np.flatnonzero(power == size).tolist():
            own = np.array([items.vocabulary[w] for w in items.words[k]])
            needed[k] = max(1, min(least_common(len(own)), int(np.ceil(NEEDED * len(own)))))
            rarest = own[np.argsort(frequency[own], kind="stable")][: len(own) - least_common(len(own)) + needed[k]]
            pairs.append(np.stack([np.unique(rarest), np.full(len(np.unique(rarest)), k)]))
        terms, owners = np.concatenate(pairs, axis=1)
        order = np.argsort(terms, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(items.vocabulary)))])
        found.append(Overlap(int(size) // 2, needed, first, owners[order]))
    return found


def _rows_of_words(ids: np.ndarray, doc_of: np.ndarray, size: int) -> np.ndarray:
    """First words of all runs of so many known words of one text."""
    last = len(ids) - size + 1
    if last <= 0:
        return np.zeros(0, dtype=np.int64)
    fits = doc_of[:last] == doc_of[size - 1 :]
    for k in range(size):
        fits &= ids[k : k + last] >= 0
    return np.flatnonzero(fits)


def _gram_keys(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A number for the words in a row at each place; equal numbers of different words cost a check."""
    keys = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        keys = (keys ^ ids[at + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


def item_grams(items: Items) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of ``GRAM`` words of all items, or of all the words of a shorter item, by their number of words."""
    found: dict[int, list[tuple[np.ndarray, int]]] = {}
    for item, words in enumerate(items.words):
        ids = np.array([items.vocabulary[w] for w in words])
        size = min(GRAM, len(words))
        found.setdefault(size, []).append((np.unique(_gram_keys(ids, np.arange(len(ids) - size + 1), size)), item))
    grams = []
    for size, own in sorted(found.items()):
        keys, owner = np.concatenate([k for k, _ in own]), np.repeat([i for _, i in own], [len(k) for k, _ in own])
        order = np.argsort(keys, kind="stable")
        grams.append((size, keys[order], owner[order]))
    return grams


def completed(directions: np.ndarray, vectors: Iterator[np.ndarray], norms: np.ndarray) -> np.ndarray:
    """The directions, and more for vectors of which they hold less than ``HELD`` of the length."""
    rest = []
    for vector, norm in zip(vectors, norms):
        left = vector - directions @ (directions.T @ vector)
        if norm > 0 and left @ left > (1 - HELD**2) * norm**2:
            rest.append(left)
    if not rest:
        return directions
    more = np.linalg.qr(np.stack(rest, axis=1))[0]
    return np.linalg.qr(np.concatenate([directions, more], axis=1))[0]


def fit(docs: DataFrame, items: Items) -> Index:
    """Frequencies over all documents, the latent space over the sample and the items."""
    lengths = [len(w) for w in items.words]
    ids = np.array([items.vocabulary[w] for own in items.words for w in own])
    row = np.repeat(np.arange(len(lengths)), lengths)
    size = len(items.vocabulary)
    frequency, total = document_frequencies(docs, items.vocabulary)
    share_with = frequency / max(total, 1)
    weight = np.log1p(1 / (share_with + SMOOTHING))
    other = float(np.log1p(1 / SMOOTHING))
    # terms of many documents tell little; they go, but for items that consist of them
    common = share_with > COMMON
    mass = weight[ids] ** 2
    told = np.bincount(row, weights=mass * ~common[ids], minlength=len(lengths)) / np.bincount(row, weights=mass, minlength=len(lengths))
    common[ids[(told < 0.8)[row]]] = False
    weight[common] = 0.0
    parts = 1 << 30
    share = min(parts, FIT_DOCS * parts // max(total, 1))
    sample = stage(docs.where(F.pmod(F.xxhash64("doc_id", F.lit("latent")), F.lit(parts)) < share).select("text"))
    width = min(RANK + OVERSAMPLING, size)
    basis = np.random.default_rng(7).standard_normal((size, width))
    passages = max(1, min(FIT_DOCS, total)) * 8
    balance = passages / len(lengths)  # the items weigh as much as the sample: the space has to tell them apart

    def product(q: np.ndarray) -> np.ndarray:
        out = _corpus_product(sample, items.vocabulary, weight, q)
        terms, rows = _normal_product(ids, row, len(lengths), weight, q)
        out[terms] += balance * rows
        return out

    q = np.linalg.qr(product(basis))[0]
    small = q.T @ product(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    directions = q @ vectors[:, np.argsort(values)[::-1][:RANK]]
    counts = [np.bincount(ids[row == k], minlength=1) for k in range(len(lengths))]
    lengthy = np.array([np.linalg.norm(c * weight[: len(c)]) for c in counts])
    directions = completed(directions, (np.pad(c * weight[: len(c)], (0, size - len(c))) for c in counts), lengthy)
    terms = (weight[:, None] * directions).astype(np.float32)
    latent = np.zeros((len(lengths), terms.shape[1]), dtype=np.float32)
    np.add.at(latent, row, terms[ids])
    # what the space holds of an item is its length there; an item it doesn't hold at all has no score
    norms = np.maximum(np.linalg.norm(latent, axis=1), 1e-6)
    return Index(items, weight, other, terms, latent, norms, item_grams(items), overlaps(items, frequency))


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark, a stated query set, in blocks of bounded size."""
    rows: list[tuple[int | None, str | None]] = []
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        rows.append((row["item_id"], row["text"]))
        if len(rows) == ITEM_BLOCK:
            yield Items.of(rows)
            rows = []
    if rows:
        yield Items.of(rows)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, kind, cosine, common_words, item_words, first_word, last_word for every leak found."""
    schema = "doc_id long, item_id long, kind string, cosine double, common_words long, item_words long, first_word long, last_word long"
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    found: DataFrame | None = None
    for items in _blocks(benchmark):
        if not items.words:
            continue
        index = fit(narrow, items)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [
                    (ids[row], index.items.ids[item], kind, round(cosine, 4), common, len(index.items.words[item]), start, end)
                    for row, item, cosine, common, kind, start, end in index.matches(batch.column(1).to_pylist())
                ]
                columns = list(zip(*rows)) or [()] * 8
                types = [pa.int64(), pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4]
                names = ["doc_id", "item_id", "kind", "cosine", "common_words", "item_words", "first_word", "last_word"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, types)], names)

        block = narrow.mapInArrow(run, schema)
        found = block if found is None else found.unionByName(block)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def _leaked(index: Index):
    @F.pandas_udf("boolean")
    def leaked(texts: pd.Series) -> pd.Series:
        hit = np.zeros(len(texts), dtype=bool)
        hit[[row for row, *_ in index.matches(texts.tolist())]] = True
        return pd.Series(hit)

    return leaked


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, with all their columns; no join, the check runs beside the row."""
    narrow = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    text = docs["text"]
    for items in _blocks(benchmark):
        if not items.words:
            continue
        docs = docs.where(~_leaked(fit(narrow, items))(text))
    return docs
