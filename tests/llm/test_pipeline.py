from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from chatlens.llm import mixing, quality
from chatlens.llm.staging import stage
from tests.llm.tables import awkward, nothing
from tests.llm.test_decontam import brute


def test_every_stage_works_on_what_the_one_before_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    after = [docs]
    for _, step in corpus_pipeline.STAGES:
        after.append(stage(step(spark, after[-1], sf)))
    ids = [Counter(r["doc_id"] for r in df.select("doc_id").collect()) for df in after]
    for df in after[1:-1]:
        assert df.columns == columns
        assert all(rows[r["doc_id"]] == r for r in df.collect())

    kept = quality.apply_policy(quality.ledger(docs)).where("kept")
    assert ids[1] == Counter(r["doc_id"] for r in kept.select("doc_id").collect())
    assert set(ids[2]) < set(ids[1]) and max(ids[2].values()) == 1
    leaked = {doc for doc, _ in brute(after[2].collect(), items)}
    gone = set(ids[2]) - set(ids[3])
    assert gone <= leaked and len(gone) >= 0.9 * len(leaked)
    times = {r["doc_id"]: r["times"] for r in mixing.mix(after[3]).collect() if r["times"]}
    assert ids[4] == Counter(times)
    assert ids[5] == ids[4]
    slots = defaultdict(list)
    for r in after[5].collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_gives_the_last_stage(spark, sf):
    first = corpus_pipeline.run(spark, sf)
    assert first.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "shard", "slot").collect())
    assert key(first) == key(corpus_pipeline.run(spark, sf))


def test_stages_take_awkward_and_empty_tables(spark, sf):
    for docs in (awkward(spark), nothing(spark)):
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = stage(step(spark, docs, sf))
            assert out.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
