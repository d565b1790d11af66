"""Spelling variants: words one edit apart, found through pairs of trie nodes, and the form each leads to.

Every prefix of a word is a node of the forward trie, every suffix one of the reversed trie. A node's
number follows from its parent's number and the letter between them, so all executors number the
tries alike without building them. Two words are one edit apart exactly when a pair (prefix node,
suffix node) of one that skips a letter is

* a pair of the other that skips a letter too: the letter there was replaced, or
* a pair of the other that skips nothing: the letter was inserted or deleted.

So a word of L letters gives L pairs that skip a letter and L + 1 that don't, and words meet by
equality of two integers. A pair names one string around one gap, so a group holds the words
that differ in the one letter there, at most one for each letter of the alphabet, and the one word
without it: groups are bounded, whatever the table. Dropping either of two equal neighbouring letters gives
the same word; only the first counts as a deletion, so each near pair meets once and counts add up.
Node numbers have 64 bits, a pair 128, and both halves would have to collide at once.

Each word's near words are summed up inside the groups, so the pairs themselves are never written.
Words are numbered in code-point order, which breaks ties of counts without carrying the words along. A
form has at least twice the count of its variant, so chains end; they are followed by doubling.

Defined cases: null, empty and wordless texts add nothing; a null id counts as an empty one where
letters are dropped; repeated rows count as often as they occur; words of any length are taken; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlens.llm.components import flatten
from chatlens.llm.staging import scratch, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST = 5
LEAST = 3
HELD = 500_000  # different words a task sums up before it sends them on
CELLS = 1 << 18  # letters numbered at a time
SPLIT, SKIP, AGAIN = 0, 1, 2  # nothing left out; a letter; a letter equal to the one before it
FORWARD, REVERSED = 0x243F6A8885A308D3, 0x13198A2E03707344  # numbers of the two roots


def _counted(noise: int | None):
    """Batches of (doc_id, text) -> (word, n), summed up by task."""

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                lowered = text.as_buffer().to_pybytes().lower().decode(errors="replace")  # bytes: A to Z only
                head = b"%d:" % doc.as_py() if doc.is_valid else b":"
                for word, n in Counter(RUN.findall(lowered)).items():
                    if noise and (h := crc32(head + word.encode())) % noise == 0:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                    if len(word) >= SHORTEST:
                        counts[word] += n
                if len(counts) > HELD:
                    yield flush(counts)
                    counts.clear()
        if counts:
            yield flush(counts)

    return run


def word_counts(docs: DataFrame, noise: int | None = None) -> DataFrame:
    """word, n: words of SHORTEST letters that occur LEAST times.

    With ``noise``, a word whose hash with its document's id is a multiple of it loses one letter there.
    """
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"])
    counts = rows.mapInArrow(_counted(noise), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _child(node: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Numbers of the nodes one letter below."""
    x = (node ^ (node >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + letter * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _nodes(letters: np.ndarray, root: int) -> np.ndarray:
    """Numbers of the nodes on the paths of words of one length, root first."""
    nodes = np.empty((letters.shape[1] + 1, letters.shape[0]), dtype=np.uint64)
    nodes[0] = root
    for k in range(letters.shape[1]):
        nodes[k + 1] = _child(nodes[k], letters[:, k])
    return nodes


def _node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id, word, n) -> (prefix, suffix, kind, id, n)."""

    def rows(prefix: np.ndarray, suffix: np.ndarray, kind: np.ndarray, ids: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // len(ids))
        for at in range(0, len(prefix), step):
            part = slice(at, at + step)
            times = len(prefix[part])
            columns = [x[part].ravel() for x in (prefix.view(np.int64), suffix.view(np.int64), kind)]
            arrays = [pa.array(x) for x in (*columns, np.tile(ids, times), np.tile(n, times))]
            yield pa.RecordBatch.from_arrays(arrays, ["prefix", "suffix", "kind", "id", "n"])

    for batch in batches:
        ids, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
        words = batch.column(1).to_pylist()
        lengths = np.array([len(w) for w in words])
        for length in np.unique(lengths).tolist():
            of_length = np.flatnonzero(lengths == length)
            step = max(1, CELLS // length)
            for at in range(0, len(of_length), step):
                here = of_length[at : at + step]
                joined = "".join(words[k] for k in here).encode("utf-32-le")
                letters = np.frombuffer(joined, dtype="<u4").reshape(len(here), length).astype(np.uint64)
                prefix, suffix = _nodes(letters, FORWARD), _nodes(letters[:, ::-1], REVERSED)[::-1]
                again = np.zeros((length, len(here)), dtype=bool)
                again[1:] = (letters[:, 1:] == letters[:, :-1]).T
                kind = np.where(again, AGAIN, SKIP).astype(np.int8)
                yield from rows(prefix[:-1], suffix[1:], kind, ids[here], n[here])
                yield from rows(prefix, suffix, np.full(prefix.shape, SPLIT, dtype=np.int8), ids[here], n[here])


def node_pairs(words: DataFrame) -> DataFrame:
    """(id, word, n) -> one row for each pair of nodes around a skipped letter, or around none."""
    schema = "prefix bigint, suffix bigint, kind tinyint, id bigint, n bigint"
    return words.select("id", "word", "n").mapInArrow(_node_pairs, schema)


def near_words(words: DataFrame) -> DataFrame:
    """(id, word, n) -> id, n_near, near_n, near_id: how many words are one edit away, and the one with the largest count.

    Of equal counts the smallest id wins. Words without a near word have no row.
    """

    def others(member: Column, members: Column) -> Column:
        """What a member is near to: words without the letter only where it counts as dropped."""
        allowed = lambda x: F.when(member["kind"] == SPLIT, x["kind"] == SKIP).otherwise((member["kind"] == SKIP) | (x["kind"] != SPLIT))
        return F.filter(members, lambda x: (x["back"] != member["back"]) & allowed(x))

    member = F.struct(F.col("n"), (-F.col("id")).alias("back"), F.col("kind"))
    groups = node_pairs(words).groupBy("prefix", "suffix").agg(F.collect_list(member).alias("m")).where(F.size("m") > 1)
    ordered = groups.select(F.sort_array("m", asc=False).alias("m"))
    members = ordered.select("m", F.explode("m").alias("x"))
    found = members.select(F.col("x.back").alias("back"), others(F.col("x"), F.col("m")).alias("near"))
    first = F.get("near", F.lit(0))
    best = found.where(F.size("near") > 0).select("back", F.size("near").alias("n_near"), F.struct(first["n"].alias("n"), first["back"].alias("back")).alias("best"))
    summed = best.groupBy("back").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))
    return summed.select(
        (-F.col("back")).alias("id"), F.col("n_near").cast("long").alias("n_near"),
        F.col("best.n").alias("near_n"), (-F.col("best.back")).alias("near_id"),
    )


def variants(docs: DataFrame, noise: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word; see the module for what they are."""
    spark = docs.sparkSession
    with scratch(spark):
        ordered = word_counts(docs, noise).orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n")
        words = stage(ordered, keep=True)
        near = stage(near_words(words), keep=True)
        leads = words.select("id", F.col("n").alias("_n")).join(near, "id").where(F.col("near_n") >= 2 * F.col("_n"))
        forms = stage(leads.select("id", F.col("near_id").alias("form_id"), F.col("near_n").alias("form_n")), keep=True)
        ends = flatten(forms.select(F.col("id").alias("node"), F.col("form_id").alias("parent")))
        roots = stage(ends.select(F.col("node").alias("id"), F.col("parent").alias("root_id")), keep=True)
    named = lambda c: words.select(F.col("id").alias(f"{c}_id"), F.col("word").alias(c))
    told = words.join(near.select("id", "n_near"), "id", "left").join(forms, "id", "left").join(roots, "id", "left")
    told = told.join(named("form"), "form_id", "left").join(named("root"), "root_id", "left")
    return told.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
