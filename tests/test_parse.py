"""Parsing, routing, quality and drift on literal edge cases."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chatlens.operators import irc, observe, parse, quality
from chatlens.schemas import BRONZE_RAW

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def good(**raw):
    return json.dumps(
        {
            "ingestion_ts": "2024-01-01T00:00:00Z",
            "source": {"platform": "", "channel": " #Room "},
            "raw": {"username": "Bob", "message": " Hi THERE "} | raw,
        }
    )


PAYLOADS = {
    "good": good(),
    "extra": good()[:-1] + ', "x": 1}',
    "null": None,
    "empty": "",
    "blank": "   ",
    "text": "not json",
    "cut": good()[:40],
    "list": "[1,2]",
    "string": '"str"',
    "object": "{}",
    "retyped": '{"raw":5}',
    "no_channel": json.dumps({"raw": {"username": "a", "message": "b"}}),
    "blank_message": good(message="  "),
}


def bronze(spark, payloads=PAYLOADS):
    rows = [("t", 1, i, T0, 0, name, body, T0) for i, (name, body) in enumerate(payloads.items())]
    return spark.createDataFrame(rows, BRONZE_RAW)


def outcomes(spark, **options):
    rows = parse.classify(bronze(spark), **options)
    names = list(PAYLOADS)
    return {names[r["source_offset"]]: r for r in rows.collect()}


def test_routing_follows_the_contract(spark):
    got = {name: row["outcome"] for name, row in outcomes(spark).items()}
    valid, contract = {"good", "extra"}, {"object", "no_channel", "blank_message"}
    for name, outcome in got.items():
        expected = "VALID" if name in valid else "CONTRACT_ERROR" if name in contract else "PARSE_ERROR"
        assert outcome == expected, name


def test_literal_routing_sends_malformed_text_to_contract_errors(spark):
    got = {name: row["outcome"] for name, row in outcomes(spark, literal_routing=True).items()}
    assert got["text"] == got["cut"] == got["list"] == "CONTRACT_ERROR"
    assert got["null"] == got["empty"] == got["blank"] == "PARSE_ERROR"
    assert got["good"] == "VALID"


def test_parsed_columns(spark):
    row = outcomes(spark)["good"]
    assert row["event_id"] == "t:1:0"
    assert (row["channel"], row["chatter_id"]) == ("#room", "bob")
    assert (row["message_text"], row["message_text_normalized"], row["message_length"]) == ("Hi THERE", "hi there", 8)
    assert row["source_platform"] == "twitch"


def test_event_key(spark):
    rows = spark.createDataFrame([("chat", 1, 42), ("t", None, 1)], "t string, p int, o bigint")
    keys = [r[0] for r in rows.select(parse.event_key(F.col("t"), F.col("p"), F.col("o"))).collect()]
    assert keys == ["chat:1:42", None]


def test_dead_letters_keep_every_failure(spark):
    rows = parse.dead_letters(parse.classify(bronze(spark).union(bronze(spark)))).collect()
    assert len(rows) == 2 * (len(PAYLOADS) - 2)
    for row in rows:
        assert row["retryable"] == (row["error_code"] == "JSON_PARSE_FAILURE")


def test_dlq_record_carries_its_fields(spark):
    failed = spark.createDataFrame(
        [('{"bad": "payload"}', "chat_raw", 2, 123)],
        "raw_payload string, source_topic string, source_partition int, source_offset bigint",
    )
    row = parse.dlq_record(failed, F.lit("PARSE_001"), F.lit(False), F.lit("json_parse_error")).first()
    assert row["raw_payload"] and row["error_detail"] == "json_parse_error" and row["retryable"] is False
    assert (row["source_topic"], row["source_partition"], row["source_offset"]) == ("chat_raw", 2, 123)
    assert (row["error_category"], row["error_code"]) == ("UNKNOWN_ERROR", "PARSE_001")
    literal = parse.dlq_record(failed, F.lit("PARSE_001"), F.lit(False), literal_category=True).first()
    assert literal["error_category"] == "PARSE_001"
    known = parse.dlq_record(failed, F.lit("TYPE_ERROR"), F.lit(False)).first()
    assert known["error_category"] == known["error_code"] == "TYPE_ERROR"
    unnamed = parse.dlq_record(failed, F.lit(None).cast("string"), F.lit(False)).first()
    assert (unnamed["error_category"], unnamed["error_detail"]) == ("UNKNOWN_ERROR", "Unknown processing error")


def test_json_object_check(spark):
    cases = {"{}": None, "[1]": "payload_not_object", "5": "payload_not_object", "nope": "invalid_json", "": "invalid_json"}
    rows = spark.createDataFrame([(k,) for k in cases], "p string")
    got = {r[0]: r[1] for r in rows.select("p", parse.json_object_check(F.col("p"))).collect()}
    assert got == cases


def test_text_contract(spark):
    row = parse.text_contract(bronze(spark, {"a": good(username="  Bob\t X ", message="a \n\n b")})).first()
    assert (row["channel"], row["chatter_id"], row["message_text"]) == ("#Room", "bob x", "a b")
    assert row["event_ts"] == datetime(2024, 1, 1) or row["event_ts"].replace(tzinfo=timezone.utc) == T0


LINES = {
    ":demo_user!demo_user@demo PRIVMSG #demo_channel :GG what a play: yes!\r\n": ("demo_user", "GG what a play: yes!"),
    ":a!a@b JOIN #room": (None, None),
    ":a!a@b PRIVMSG #room": (None, None),
    "::x!y PRIVMSG #r :one\ntwo": ("x", "one\ntwo"),
    "noprefix PRIVMSG #r :": ("noprefix PRIVMSG #r :", ""),
}


def test_irc_lines(spark):
    lines = spark.createDataFrame([(k,) for k in [*LINES, "PING :s", "  \r\n"]], "line string")
    got = irc.irc_parse(irc.irc_filter(lines)).collect()
    assert {(r["username"], r["message"]) for r in got} == set(LINES.values())


def test_quality_rules(spark):
    records = {
        '{"user":"abc"}': (["message"], ["missing_message", "message_size_out_of_range"]),
        '{"channel":"c","chatter_id":"u","message_text":"hi","message_length":2}': ([], []),
        '{"channel":"c","chatter_id":"","message_text":null}': (
            ["chatter_id", "message_text"],
            ["missing_chatter_id", "missing_message_text"],
        ),
        '{"channel":0,"chatter_id":[],"message_text":"' + "x" * 501 + '"}': (
            ["channel", "chatter_id"],
            ["missing_channel", "missing_chatter_id", "message_size_out_of_range"],
        ),
        '{"channel":"c","chatter_id":"0","message_text":"a\\u0001","source_offset":"7","source_partition":1.5,"message_length":true}': (
            [],
            ["source_partition_type_invalid", "source_offset_type_invalid", "message_has_control_chars"],
        ),
    }
    rows = quality.assess_records(spark.createDataFrame([(r,) for r in records], "record string")).collect()
    for row in rows:
        missing, codes = records[row["record"]]
        assert row["missing_fields"] == missing
        assert [i["code"] for i in row["issues"]] == codes
        assert row["accepted"] == (not [c for c in codes if c != "message_has_control_chars"])


def test_schema_drift(spark):
    payloads = {
        "ok": good(),
        "extra": good()[:-1] + ', "zz": 1, "aa": 2}',
        "missing": '{"ingestion_ts":"x","raw":null}',
        "retyped": '{"ingestion_ts":5,"source":{},"raw":{"a":1}}',
        "broken": "nope",
    }
    rows = observe.schema_drift(bronze(spark, payloads)).collect()
    got = {r["raw_key"]: r for r in rows}
    assert got["ok"]["action"] == "ACCEPT"
    assert (got["extra"]["unexpected_fields"], got["extra"]["action"]) == (["aa", "zz"], "WARN_AND_CONTINUE")
    assert (got["missing"]["missing_required_fields"], got["missing"]["action"]) == (["raw", "source"], "FAIL_FAST")
    assert got["retyped"]["type_drift_fields"] == ["ingestion_ts"]
    assert got["broken"]["missing_required_fields"] == ["ingestion_ts", "raw", "source"]


def test_service_level_values(spark):
    one = spark.range(1)
    row = one.select(
        observe.slo_breached(F.lit(0.02)).alias("breached"),
        observe.success_percent(F.lit(95), F.lit(100)).alias("uptime"),
        observe.success_percent(F.lit(5), F.lit(0)).alias("none"),
        observe.success_ratio(F.lit(1), F.lit(3)).alias("ratio"),
        observe.is_spike_or_drop(F.lit(1000), F.lit(1085), 0.05).alias("spike"),
        observe.is_spike_or_drop(F.lit(0), F.lit(5)).alias("no_expectation"),
        observe.seconds_between(F.timestamp_seconds(F.lit(12)), F.timestamp_seconds(F.lit(10))).alias("never_negative"),
    ).first()
    assert tuple(row) == (True, 95.0, 0.0, 0.3333, True, False, 0.0)


@pytest.mark.parametrize("fail_fast, action", [(True, "FAIL_FAST"), (False, "DLQ")])
def test_drift_action_switch(spark, fail_fast, action):
    row = observe.schema_drift(bronze(spark, {"a": "{}"}), fail_fast=fail_fast).first()
    assert row["action"] == action
