"""Mergeable engagement state against the roll-up of all rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chatlens.plans import engagement, state
from chatlens.schemas import SILVER_FEATURES, SILVER_PARSED
from chatlens.sources import manifest

T0 = datetime(2024, 1, 1, 6, tzinfo=timezone.utc)
COLUMNS = [*SILVER_PARSED.fields, *SILVER_FEATURES.fields[1:]]


def joined(spark, *events):
    """(id, day, channel, chatter, length, ratio or None where features are missing)."""
    rows = []
    for number, day, channel, chatter, length, ratio in events:
        ts = T0 + timedelta(days=day, minutes=number % 3)
        featured = (None,) * 11 if ratio is None else (length // 2, length, 0, 1, 2, ratio, 1 - ratio, 3, ratio > 0.5, None if number % 5 == 0 else ratio < 0.3, ts)
        rows.append((f"e{number}", "t", 0, number, ts, ts, ts, channel, chatter, "x", "x", length, "twitch", *featured))
    return spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in COLUMNS))


def some(first, last, days=3):
    return [(k, k % days, f"#c{k % 2}", f"u{k % 7}", 5 + k, None if k % 4 == 0 else (k % 10) / 10 + 1e-9) for k in range(first, last)]


def same(a, b):
    rounded = lambda df: sorted(map(str, df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()))
    assert a.dtypes == b.dtypes
    assert rounded(a) == rounded(b)


@pytest.mark.parametrize("grain", ["minute", "day"])
def test_folds_equal_the_full_build(spark, tmp_path, grain):
    path = f"{tmp_path}/s"
    first, late = joined(spark, *some(0, 40)), joined(spark, *some(40, 60, days=2))
    assert state.fold(spark, path, grain, first, "a", 0) == [date(2024, 1, d) for d in (1, 2, 3)]
    assert state.fold(spark, path, grain, late, "a", 1) == [date(2024, 1, 1), date(2024, 1, 2)]
    old = [e for e in some(0, 40) if e[1] == 2]
    new = [(*e[:4], e[4] + 100, 0.25) for e in old]
    assert state.fold(spark, path, grain, joined(spark, *new), "b", 0, joined(spark, *old)) == [date(2024, 1, 3)]
    whole = joined(spark, *[e for e in some(0, 40) if e[1] != 2], *new, *some(40, 60, days=2))
    same(state.rollup(state.read_state(spark, path), grain), engagement.engagement_rollup(whole, grain))


def test_repeated_and_failed_folds_change_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/s"
    rows, more = joined(spark, *some(0, 20)), joined(spark, *some(20, 30))
    state.fold(spark, path, "day", rows, "a", 0)
    assert state.fold(spark, path, "day", rows, "a", 0) == []
    commit = manifest.commit
    monkeypatch.setattr(manifest, "commit", lambda *_: (_ for _ in ()).throw(manifest.Conflict("lost")))
    with pytest.raises(manifest.Conflict):
        state.fold(spark, path, "day", more, "a", 1)
    same(state.rollup(state.read_state(spark, path), "day"), engagement.engagement_rollup(rows, "day"))
    monkeypatch.setattr(manifest, "commit", commit)
    state.fold(spark, path, "day", more, "a", 1)
    same(state.rollup(state.read_state(spark, path), "day"), engagement.engagement_rollup(rows.unionByName(more), "day"))


def test_moved_events_build_their_days_anew(spark, tmp_path):
    """A chatter that no longer speaks on a day leaves no bit there."""
    path = f"{tmp_path}/s"
    before = some(0, 20)
    after = [(k, d, c, "renamed" if k == 3 else u, n, r) for k, d, c, u, n, r in before]
    state.fold(spark, path, "day", joined(spark, *before), "a", 0)
    old, new = joined(spark, before[3]), joined(spark, after[3])
    with pytest.raises(ValueError, match="2024-01-01"):
        state.fold(spark, path, "day", new, "b", 0, old)
    rows_of = lambda days: joined(spark, *after).where(F.to_date("event_ts").isin(days))
    assert state.fold(spark, path, "day", new, "b", 0, old, rows_of) == [date(2024, 1, 1)]
    same(state.rollup(state.read_state(spark, path), "day"), engagement.engagement_rollup(joined(spark, *after), "day"))


def test_only_touched_days_are_opened(spark, tmp_path):
    path = f"{tmp_path}/s"
    state.fold(spark, path, "day", joined(spark, *some(0, 20)), "a", 0)
    opened = state.read_state(spark, path, [date(2024, 1, 2), date(2024, 2, 1)]).inputFiles()
    assert opened and all("_day=2024-01-02" in f for f in opened)
    state.fold(spark, path, "day", joined(spark, (90, 1, "#c0", "new", 9, 0.5)), "a", 1)
    versions = {d: v for d, v in manifest.newest(spark, f"{path}_manifest")[1]["days"].items()}
    assert versions == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1}
    assert state.read_state(spark, f"{tmp_path}/nothing") is None


def test_many_chatters_fill_several_buckets(spark, tmp_path):
    path = f"{tmp_path}/s"
    base = joined(spark, (1, 0, "#c", "x", 5, 0.5)).drop("chatter_id")
    crowd = base.crossJoin(spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("chatter_id")))
    half = crowd.where("length(chatter_id) < 6")
    state.fold(spark, path, "day", half, "a", 0)
    state.fold(spark, path, "day", crowd, "a", 1)
    found = state.rollup(state.read_state(spark, path), "day").first()
    assert (found["unique_chatters"], found["total_messages"]) == (70_000, 70_000 + half.count())
    assert state.read_state(spark, path).select("bucket").distinct().count() >= 3
