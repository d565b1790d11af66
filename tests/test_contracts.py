"""Drift at any depth, contract rules across tables, declared tests, in-row word filter."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatlens.functions.enrich import candidate_tokens, lexicon_scores, word_filter
from chatlens.operators import checks, observe

PAYLOADS = {
    "plain": '{"ingestion_ts":"t","source":{"channel":"c"},"raw":{"message":"m"}}',
    "nested": '{"ingestion_ts":"t","source":{"channel":"c","extra":{"a":{"b":1}}},"raw":{"message":5,"tags":[{"x":1},{"y":null}]}}',
    "names": '{"ingestion_ts":"t","source":{"a.b":1,"c d":"e","x,y: OBJECT<z>":true},"raw":{"message":"OBJECT<a: BIGINT>, b: "}}',
    "wrong": '{"ingestion_ts":3,"source":[1],"raw":null,"metadata":{"event_kind":null}}',
    "array": "[1]",
    "text": '"x"',
    "broken": '{"a":',
    "empty": "{}",
    "null": None,
}


@pytest.fixture(scope="module")
def payloads(spark):
    return spark.createDataFrame(list(PAYLOADS.items()), "id string, raw_payload string")


def test_drift_is_found_at_any_depth(payloads):
    columns = ("missing_required_fields", "unexpected_fields", "type_drift_fields", "action")
    rows = {r["id"]: tuple(r[c] for c in columns) for r in observe.schema_drift_paths(payloads).collect()}
    nothing = (["ingestion_ts", "raw", "source"], [], [], "FAIL_FAST")
    assert rows["plain"] == ([], [], [], "ACCEPT")
    assert rows["nested"] == ([], ["raw.tags", "source.extra"], ["raw.message"], "FAIL_FAST")
    assert rows["names"] == ([], ["source.`a.b`", "source.`c d`", "source.`x,y: OBJECT<z>`"], [], "WARN_AND_CONTINUE")
    assert rows["wrong"] == (["raw"], [], ["ingestion_ts", "source"], "FAIL_FAST")
    for name in ("array", "text", "broken", "empty", "null"):
        assert rows[name] == nothing


def test_top_level_agrees_with_the_flat_check(payloads):
    columns = ["id", "missing_required_fields"]
    flat = observe.schema_drift(payloads).select(*columns, F.filter("unexpected_fields", lambda x: ~x.contains(".")).alias("u"))
    deep = observe.schema_drift_paths(payloads).select(*columns, F.filter("unexpected_fields", lambda x: ~x.contains(".")).alias("u"))
    assert sorted(map(str, flat.collect())) == sorted(map(str, deep.collect()))


def test_each_payload_is_parsed_once(payloads):
    plan = observe.schema_drift_paths(payloads)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1 and "json_object_keys" not in plan


def test_union_of_the_table(payloads):
    found = {(r["path"], r["kind"]): r["records"] for r in observe.schema_union(payloads).collect()}
    assert found["ingestion_ts", "STRING"] == 3 and found["ingestion_ts", "BIGINT"] == 1
    assert found["source.extra.a.b", "BIGINT"] == 1 and found["raw.tags.[].x", "BIGINT"] == 1
    assert found["raw", "VOID"] == 1 and found["source", "ARRAY"] == 1


def test_records_that_agree_are_not_walked(spark):
    """Their type string says so; others are read level by level, down to what the contract knows."""
    agrees = ['{"ingestion_ts":"t","source":{"channel":"c","server":null},"raw":{}}', '{"raw":{"message":"m"},"source":{},"metadata":null,"ingestion_ts":"t"}']
    others = [
        '{"ingestion_ts":null,"source":{},"raw":{}}', '{"ingestion_ts":"t","source":{},"raw":{"message":{"a":1}}}', '{"ingestion_ts":"t","source":{"channel":1},"raw":{}}',
        '{"ingestion_ts":"t","source":{},"raw":{},"more":{"source":{"channel":1}}}', '{"ingestion_ts":"t","source":{},"raw":{"1a":0,"a`b":0}}', "3", None,
    ]
    df = spark.createDataFrame(list(enumerate(agrees + others)), "id int, raw_payload string")
    rows, agreed, nodes = observe._with_known_levels(df, "raw_payload", observe.ENVELOPE, observe.EnvelopeContract().required)
    found = {r["id"]: (r["a"], r["n"]) for r in rows.select("id", agreed.alias("a"), F.size(nodes).alias("n")).collect()}
    assert [found[k] for k in range(len(agrees))] == [(True, 0)] * len(agrees)
    assert not any(found[k][0] for k in range(len(agrees), len(found))) and found[5] == (False, 4)
    drift = {r["id"]: (r["missing_required_fields"], r["unexpected_fields"], r["type_drift_fields"]) for r in observe.schema_drift_paths(df).collect()}
    assert drift[0] == drift[1] == ([], [], []) and drift[2] == (["ingestion_ts"], [], [])
    assert drift[3] == ([], ["raw.message.a"], ["raw.message"]) and drift[4] == ([], [], ["source.channel"])
    assert drift[5] == ([], ["more"], []) and drift[6] == ([], ["raw.`1a`", "raw.`a``b`"], [])
    nested = observe.schema_drift_paths(df, required=("source.channel", "more.source.channel"))
    assert {r["id"]: r["missing_required_fields"] for r in nested.collect()}[5] == ["source.channel"]
    assert {r["id"]: r["missing_required_fields"] for r in nested.collect()}[0] == ["more.source.channel"]


def test_union_walks_a_type_once(spark):
    df = spark.createDataFrame([(f'{{"a":{k},"b":{{"c":"x{k}"}}}}',) for k in range(50)], "raw_payload string")
    found = observe.schema_union(df)
    assert {(r["path"], r["kind"]): r["records"] for r in found.collect()} == {("a", "BIGINT"): 50, ("b", "OBJECT"): 50, ("b.c", "STRING"): 50}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract_all") < plan.rindex("Aggregate")


def test_a_custom_contract():
    contract = StructType.fromDDL("a int, b struct<c: double, d: struct<e: boolean>>")
    assert observe.expected_nodes(contract) == {"a": "BIGINT", "b": "OBJECT", "b.c": "DOUBLE", "b.d": "OBJECT", "b.d.e": "BOOLEAN"}


def test_rules_of_the_parsed_contract(spark):
    columns = "_run_id string, event_id string, channel string, chatter_id string, message_text string, message_length int"
    rows = [
        ("a", "t:0:1", "c", "u", "m", 1), ("a", "t:0:1", "c", "u", "m", 1), ("b", "t:0:1", "c", "u", "m", 1),
        ("a", "t:0:2", None, "u", "m", 1), ("a", "t:0:3", "c", "u", "m", 0), ("a", "t:0:4", "c", "u", None, None),
    ]
    dead = [("a", "CONTRACT_ERROR", "t", 0, 4), ("a", "CONTRACT_ERROR", "t", 0, 4), ("b", "CONTRACT_ERROR", "t", 0, 2), ("a", "PARSE_ERROR", "t", 0, 1)]
    dlq = spark.createDataFrame(dead, "_run_id string, error_category string, source_topic string, source_partition int, source_offset long")
    parsed = spark.createDataFrame(rows, columns)
    found = {r["rule"]: r["violations"] for r in checks.parsed_contract_check(parsed, dlq).collect()}
    assert found == {
        "required_fields_present": 2, "message_length_positive": 2, "event_id_unique_within_contract_output": 1, "contract_failures_routed_to_dlq": 1,
    }
    none = checks.parsed_contract_check(parsed.limit(0), dlq).collect()
    assert [r["violations"] for r in none] == [0, 0, 0, 0]


def test_declared_tests_read_a_model_once(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "k string, v int")
    found = checks.model_tests(df, "m", ("k", "v"), ("k",))
    assert {(r["test"], r["column_name"]): r["violations"] for r in found.collect()} == {("not_null", "k"): 2, ("not_null", "v"): 1, ("unique", "k"): 1}
    assert [r["violations"] for r in checks.model_tests(df.limit(0), "m", ("k",), ("k",)).collect()] == [0, 0]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_words_that_cannot_score_stay_in_their_row(spark):
    texts = [(k, " ".join(f"w{k}x{j}" for j in range(200)) + (" LUL bad" if k % 3 == 0 else "")) for k in range(60)] + [(99, ""), (99, "LUL"), (100, None)]
    df = spark.createDataFrame(texts, "event_id long, message string")
    lexicon = spark.createDataFrame([("LUL", 0.6), ("bad", -1.0), ("meh", 0.0)], "token string, score double")
    rows = candidate_tokens(df, lexicon, "event_id", "message")
    assert rows.where("token IN ('LUL', 'bad')").count() == 41
    assert rows.count() <= 60 + 20 + 3 + 12  # a row per message, one more where two words may score, a few by chance
    assert rows.agg(F.sum("total")).first()[0] == 60 * 200 + 40 + 1
    found = {r["event_id"]: r for r in lexicon_scores(df, lexicon).collect()}
    assert found[0]["neu"] == round(200 / (200 + 1.6 + 2.0), 3) and found[1]["neu"] == 1.0
    assert (found[99]["pos"], found[100]["neu"]) == (1.0, 0.0)


def test_the_filter_never_drops_a_word_it_holds(spark):
    lexicon = spark.range(3000).select(F.concat(F.lit("né"), "id").alias("token"), F.lit(1.0).alias("score"))
    may_hold = word_filter(lexicon, bits=1 << 10)  # far too small, so nearly everything passes
    assert lexicon.where(may_hold(F.col("token"))).count() == 3000
    assert lexicon.limit(0).where(word_filter(lexicon.limit(0))(F.col("token"))).count() == 0
    assert json.loads(json.dumps([0]))  # the filter travels as JSON
