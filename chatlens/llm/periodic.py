"""Runs of repeated word sequences, found through minimizers of several scales.

A run is a maximal stretch of words that equals itself ``q`` words on, for its smallest such ``q``,
with at least ``LEAST`` words and ``TURNS`` periods. All runs of a text are found, overlapping ones
of different periods included:

* Periods up to ``SHORT``: a lag scan. A stretch long enough for a run covers a multiple of its least
  number of equal pairs, so only those positions are compared, and the hits are extended.
* Longer periods, a scale for each range ``lo < q <= hi`` with ``hi`` about 1.25 ``lo``: the run has
  ``q`` different sequences of ``hi`` words, which come again ``q`` words on. Its first
  ``2 (lo + 1) - hi + 1`` of them have their repeats inside the run too, so in windows of that many
  the least hash is at the same place one period on, and no equal one lies in between. Positions
  that are least in some window, sorted by hash, give the seeds: neighbours with equal hashes at a
  distance inside the range. Every seed is extended word by word, so a run is never taken on a hash.

Texts of a batch are laid end to end with separators that equal nothing, sorted by length, in pieces
of at most ``PIECE`` words (or one text), so memory is bounded by the longest text and numpy works on
long arrays. There is no shuffle: each text is done where it is read.

Defined cases: null, empty and blank texts have no runs and an empty collapsed text; ids may be null
or repeated, rows are returned as often as they occur; other columns are ignored; an empty table gives
an empty result. Runs are ordered by start, then period.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 24
TURNS = 3
SHORT = 24
PIECE = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _reach(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch of positions around ``at`` whose word equals the one ``lag`` on."""
    end, step, last = at, 64, len(ids) - lag
    while end < last:
        upto = min(last, end + step)
        other = ids[end:upto] != ids[end + lag : upto + lag]
        if other.any():
            end += int(other.argmax())
            break
        end, step = upto, step * 2
    start, step = at, 64
    while start > 0:
        down = max(0, start - step)
        other = ids[down:start] != ids[down + lag : start + lag]
        if other.any():
            start -= int(other[::-1].argmax())
            break
        start, step = down, step * 2
    return start, end


def _prime_factors(n: int) -> Iterator[int]:
    factor = 2
    while factor * factor <= n:
        if n % factor == 0:
            yield factor
            while n % factor == 0:
                n //= factor
        factor += 1
    if n > 1:
        yield n


def _extend(ids: np.ndarray, seeds: np.ndarray, lag: int) -> Iterator[tuple[int, int, int]]:
    """Runs of period ``lag`` around ascending positions that equal the word ``lag`` on."""
    done = -1
    for at in seeds.tolist():
        if at < done:
            continue
        start, done = _reach(ids, at, lag)
        length = done - start + lag
        if length < max(LEAST, TURNS * lag):
            continue
        whole = ids[start : start + length]
        if not any(np.array_equal(whole[lag // p :], whole[: -(lag // p)]) for p in _prime_factors(lag)):
            yield start, length, lag


def _lag_seeds(ids: np.ndarray, lag: int) -> np.ndarray:
    """Some position of every stretch long enough for a run of period ``lag``."""
    need = max(LEAST, TURNS * lag) - lag
    last = len(ids) - lag
    seeds = np.arange(0, last, need)
    seeds = seeds[ids[seeds] == ids[seeds + lag]]
    half = need // 2  # the stretch goes on for so many words on one side at least
    sides = []
    for way in (1, -1):
        left = seeds
        for step in range(1, half + 1):
            if not len(left):
                break
            to = left + way * step
            inside = (to >= 0) & (to < last)
            left, to = left[inside], to[inside]
            left = left[ids[to] == ids[to + lag]]
        sides.append(left)
    return np.union1d(*sides)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order, not linear in either."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every window of ``width`` values."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[:-rest], values[rest:]) if rest else values


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """Ranges of periods (above, up to) for texts of so many words."""
    low = SHORT
    while low < longest // TURNS:
        yield low, low * 5 // 4
        low = low * 5 // 4


def _minimizer_seeds(ids: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(lag, positions): for every run with a period over SHORT one position at least."""
    grams, width = _mixed(ids.view(np.uint64), ids.view(np.uint64)), 1
    for low, high in scales(longest):
        while 2 * width <= high:
            grams, width = _mixed(grams[:-width], grams[width:]), 2 * width
        n, window = len(ids) - high + 1, 2 * (low + 1) - high + 1
        if n < window:
            return
        hashes = _mixed(grams[:n], grams[high - width : high - width + n])
        least = np.zeros(n + window - 1, dtype=np.uint64)
        least[window - 1 : n] = _sliding(hashes, window, np.minimum)
        chosen = np.flatnonzero(_sliding(least, window, np.maximum) == hashes)
        values = hashes[chosen]
        order = np.argsort(values, kind="stable")
        at, values = chosen[order], values[order]
        lags = at[1:] - at[:-1]
        seed = (values[1:] == values[:-1]) & (lags > low) & (lags <= high)
        at, lags = at[:-1][seed], lags[seed]
        for lag in np.unique(lags).tolist():
            here = np.sort(at[lags == lag])
            yield lag, here[ids[here] == ids[here + lag]]


def runs_of(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of word numbers, for texts of at most ``longest`` words."""
    found: set[tuple[int, int, int]] = set()
    for lag in range(1, min(SHORT, longest // TURNS) + 1):
        found.update(_extend(ids, _lag_seeds(ids, lag), lag))
    for lag, seeds in _minimizer_seeds(ids, longest):
        found.update(_extend(ids, seeds, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _piece(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text of a piece."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    ids = np.empty(starts[-1], dtype=np.int64)
    for k, words in enumerate(texts):
        ids[starts[k] : starts[k + 1] - 1] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    ids[starts[1:] - 1] = -1 - np.arange(len(texts))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs_of(ids, max(map(len, texts))):
        k = int(np.searchsorted(starts, start, side="right")) - 1
        found[k].append((start - int(starts[k]), length, period))
    return found


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(words if not runs else [words[k] for k in np.flatnonzero(kept)]).decode()


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = _piece(texts)
        rows = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
        collapsed = [_collapsed(t, r) for t, r in zip(texts, runs)]
        columns = [pa.array(ids, pa.int64()), pa.array(rows, pa.list_(schema)), pa.array(collapsed, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts], dtype=np.int64)
        held: list[int] = []
        words: list[list[bytes]] = []
        total = 0
        for k in np.argsort(sizes, kind="stable").tolist():
            split = texts[k].as_buffer().to_pybytes().split() if sizes[k] else []
            if held and total + len(split) > PIECE:
                yield done([ids[j] for j in held], words)
                held, words, total = [], [], 0
            held.append(k)
            words.append(split)
            total += len(split) + 1
        if held:
            yield done([ids[j] for j in held], words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period), collapsed: the text without the words after a run's first period."""
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"])
    return rows.mapInArrow(_found, f"doc_id bigint, runs {RUNS}, collapsed string")


def most_repeated(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first by start, then period."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    more = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    return F.aggregate(runs, none, lambda best, run: F.when(more(best, run), run).otherwise(best))
