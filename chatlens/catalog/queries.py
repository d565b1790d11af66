"""Queries over the given tables, one per operator."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from chatlens.functions.enrich import (
    alpha_ratio,
    dict_emote_count,
    dict_is_emote_only,
    emote_sentiment,
    emote_tokens,
    lexicon_scores,
    max_run_ratio,
    shannon_entropy,
)
from chatlens.functions.message import message_features
from chatlens.functions.profile import with_text_profile
from chatlens.functions.text import blank_to_null
from chatlens.operators import checks, irc, merge, observe, parse, quality, v1, versions
from chatlens.plans import engagement, health, messages, refresh, state, triage
from chatlens.schemas import (
    BATCH_LEDGER,
    BATCH_METRICS,
    BRONZE_RAW,
    DLQ,
    DLQ_CATEGORIES,
    EMOTE_SENTIMENT,
    LOG_KEY,
    LOG_RECORD,
    PARSE_STAGE,
    SILVER_FEATURES,
    SILVER_PARSED,
    V1_SILVER,
    with_write_metadata,
)
from chatlens.session import checkpoint_root, configure
from chatlens.sources import derived, evolution, layout, log, tables
from chatlens.streaming import jobs, ledger, sinks

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 3, 15, tzinfo=timezone.utc)
RUNS = ("run_a", "run_b")
CLOSED = datetime(2024, 1, 16).date()

QUERIES: dict[str, Query] = {}


def as_of() -> Column:
    return F.lit(AS_OF)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to a precision that does not depend on the order of summation."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            configure(spark)
            return rounded(build(spark, sf))

        QUERIES[name] = run
        return build

    return register


# --- sources -------------------------------------------------------------------------------


@query("bronze_projection")
def _(spark, sf):
    return derived.bronze(spark, sf)


@query("staging_scan")
def _(spark, sf):
    return tables.staging_scan(derived.batch_metrics(spark, sf), BATCH_METRICS)


@query("staging_scan_parsed")
def _(spark, sf):
    return tables.staging_scan(derived.parsed(spark, sf), with_write_metadata(SILVER_PARSED))


@query("staging_scan_features")
def _(spark, sf):
    return tables.staging_scan(derived.features(spark, sf), with_write_metadata(SILVER_FEATURES))


@query("staging_scan_dlq")
def _(spark, sf):
    return tables.staging_scan(derived.dlq(spark, sf), with_write_metadata(DLQ))


@query("v1_raw_projection")
def _(spark, sf):
    return log.v1_raw_projection(derived.v1_log(spark, sf), F.col("_arrival"))


# --- sinks and merges ----------------------------------------------------------------------


def _batches(spark, sf, target, second: Callable[[DataFrame], DataFrame] = lambda df: df):
    """Raw rows through the sink: days before the 16th as batch 0, the others as batch 1."""
    rows = derived.bronze(spark, sf)
    late = F.dayofmonth("kafka_timestamp") >= 16
    for batch_id, batch in enumerate((rows.filter(~late), second(rows.filter(late)))):
        sinks.append_with_batch_metadata(batch, batch_id, target, "run_a", "bronze_ingest", clock=lambda: AS_OF)


@query("append_with_batch_metadata")
def _(spark, sf):
    target = f"{_folder(spark)}/bronze"
    _batches(spark, sf, target)
    return sinks.read_batches(spark, target, BRONZE_RAW)


@query("schema_evolution_append")
def _(spark, sf):
    """The second batch brings a column; rows of the first have nulls there."""
    target = f"{_folder(spark)}/bronze"
    _batches(spark, sf, target, lambda df: df.withColumn("payload_length", F.length("raw_payload")))
    return evolution.read_evolved(spark, target)


@query("batch_metrics_row")
def _(spark, sf):
    """Two batches through the sink, one of them repeated; its metrics rows."""
    folder = _folder(spark)
    rows = derived.bronze(spark, sf)
    late = F.dayofmonth("kafka_timestamp") >= 16
    for batch_id, batch in ((0, rows.filter(~late)), (1, rows.filter(late)), (1, rows.filter(late))):
        sinks.append_with_batch_metadata(
            batch, batch_id, f"{folder}/bronze", "run_a", "bronze_ingest", f"{folder}/metrics", clock=lambda: AS_OF
        )
    return tables.read_table(spark, f"{folder}/metrics", BATCH_METRICS).drop("target_table")


def _v1_tables(spark, sf):
    """A raw target holding all days before the 16th, and a batch that overlaps it."""
    rows = log.v1_raw_projection(derived.v1_log(spark, sf), F.col("_arrival"))
    day = F.to_date("kafka_timestamp")
    target = merge.first_per_key(rows.filter(day < F.lit("2024-01-16").cast("date")), LOG_KEY, ["ingest_ts"])
    return target, rows.filter(day >= F.lit("2024-01-14").cast("date"))


@query("stream_append")
def _(spark, sf):
    folder = _folder(spark)
    raw = log.bronze_projection(_log_stream(spark, derived.log_rows(spark, sf), folder), F.col("timestamp"))
    jobs.await_all(
        sinks.stream_append(raw, f"{folder}/bronze", f"{folder}/cp", "run_a", "bronze_ingest", f"{folder}/metrics")
    )
    counted = health.distinct_batches(tables.read_table(spark, f"{folder}/metrics", BATCH_METRICS))
    written = tables.read_table(spark, f"{folder}/bronze", with_write_metadata(BRONZE_RAW)).drop("_batch_processed_ts")
    return written.join(counted.select(F.col("batch_id").alias("_batch_id"), "row_count"), "_batch_id")


@query("dlq_sink")
def _(spark, sf):
    folder = _folder(spark)
    stream = _log_stream(spark, derived.log_rows(spark, sf), folder)
    dead = parse.dead_letters(parse.classify(log.bronze_projection(stream)), as_of())
    jobs.await_all(sinks.dlq_sink(dead, f"{folder}/dlq", f"{folder}/cp", available_now=True))
    return tables.read_table(spark, f"{folder}/dlq", DLQ)


@query("idempotent_batch_write")
def _(spark, sf):
    """A batch, compaction of its closed days, and the batch once more."""
    target = f"{_folder(spark)}/bronze"
    rows = _stored(spark, target.removesuffix("/bronze"), "batch", derived.bronze(spark, sf))
    for _attempt in ("first", "repeated"):
        sinks.append_with_batch_metadata(rows, 3, target, "run_a", "bronze_ingest")
        sinks.compact_days(spark, target, BRONZE_RAW, CLOSED)
    sinks.append_with_batch_metadata(rows.filter(F.dayofmonth("kafka_timestamp") < 5), 3, target, "run_a", "bronze_ingest")
    return sinks.read_batches(spark, target, BRONZE_RAW).drop("_batch_processed_ts")


@query("skip_empty_batch")
def _(spark, sf):
    folder = _folder(spark)
    dead = parse.dead_letters(derived.classified(spark, sf), as_of())
    batches = (dead.filter("error_category = 'TYPE_ERROR'"), dead)
    for batch_id, batch in enumerate(batches):
        sinks.append_with_batch_metadata(
            batch, batch_id, f"{folder}/dlq", "run_a", "dlq_router", f"{folder}/metrics", skip_empty=True
        )
    written = tables.read_table(spark, f"{folder}/metrics", BATCH_METRICS)
    return written.select("run_id", "job_name", "batch_id", "row_count")


@query("merge_insert_new")
def _(spark, sf):
    target, batch = _v1_tables(spark, sf)
    return merge.merge_insert_new(target, batch, LOG_KEY, ["ingest_ts"])


@query("merge_update_status")
def _(spark, sf):
    rows = log.v1_raw_projection(derived.v1_log(spark, sf), F.col("_arrival"))
    target = merge.first_per_key(rows, LOG_KEY, ["ingest_ts"])
    updates = v1.parse_status(v1.v1_parse(derived.v1_log(spark, sf)))
    return merge.merge_update_status(target, updates, LOG_KEY)


def _v1_silver(spark, sf):
    rows = v1.v1_parse(derived.v1_log(spark, sf).withColumn("_order", F.col("_arrival")))
    return v1.v1_enrich(merge.first_per_key(rows, LOG_KEY, ["kafka_timestamp", "user", "message"]), F.col("kafka_timestamp"))


@query("enriched_topic_sink")
def _(spark, sf):
    published = v1.enriched_message(_v1_silver(spark, sf))
    return published.select(
        F.get_json_object("value", "$.user").alias("user"),
        F.get_json_object("value", "$.message").alias("message"),
        *[F.get_json_object("value", f"$.sentiment.{s}").cast("double").alias(s) for s in ("neg", "neu", "pos", "compound")],
        F.array_join(F.json_object_keys("value"), ",").alias("fields"),
    )


@query("warehouse_sink_projection")
def _(spark, sf):
    rows = v1.warehouse_rows(_v1_silver(spark, sf))
    return rows.select(
        "USERNAME",
        "MESSAGE",
        "COMPOUND_SCORE",
        *[
            F.get_json_object("SENTIMENT_JSON", f"$.{s}").cast("double").alias(f"SENTIMENT_{s.upper()}")
            for s in ("neg", "neu", "pos", "compound")
        ],
    )


@query("materialize")
def _(spark, sf):
    view = tables.materialize(derived.batch_metrics(spark, sf), "streaming_batch_metrics_view", kind="view")
    return view.groupBy("run_id", "target_table").agg(F.sum("row_count").alias("row_count"))


# One task reads a bucket whole, so their number grows with the given tables.
BUCKETS, BUCKET_BYTES = 8, 32 << 20


@query("materialize_table")
def _(spark, sf):
    """Parsed and features as bucketed tables, joined in place."""
    name = f"chatlens_{uuid4().hex}"
    given = layout.stored_bytes(spark, f"{sf}/documents.parquet", f"{sf}/events.parquet")
    buckets = max(BUCKETS, math.ceil(given / BUCKET_BYTES))
    for part in ("parsed", "features"):
        rows = getattr(derived, part)(spark, sf)
        tables.materialize(rows, f"{name}_{part}", bucket_by=["event_id"], buckets=buckets)
    return versions.parsed_left_features(spark.table(f"{name}_parsed"), spark.table(f"{name}_features"))


@query("materialize_ephemeral")
def _(spark, sf):
    rows = tables.materialize(derived.batch_metrics(spark, sf), "unused", kind="ephemeral")
    return rows.groupBy("run_id", "job_name").agg(F.sum("row_count").alias("row_count"))


# --- chat lines ----------------------------------------------------------------------------


@query("irc_filter")
def _(spark, sf):
    return irc.irc_filter(derived.chat_lines(spark, sf)).select("event_id", "line")


@query("irc_parse")
def _(spark, sf):
    lines = irc.irc_parse(irc.irc_filter(derived.chat_lines(spark, sf)))
    return lines.select("event_id", "username", "message")


@query("envelope_build")
def _(spark, sf):
    lines = irc.irc_parse(irc.irc_filter(derived.chat_lines(spark, sf)))
    built = irc.envelope_build(
        lines, F.lit("irc.example.org"), F.col("channel"), F.lit("test"), irc.iso_instant(F.col("ts"))
    )
    read = built.withColumn("_v", F.parse_json("value"))

    def part(path: str, name: str) -> Column:
        return F.variant_get("_v", f"$.{path}", "string").alias(name)

    return read.select(
        "event_id",
        part("ingestion_ts", "ingestion_ts"),
        part("source.platform", "platform"),
        part("source.channel", "channel"),
        part("raw.irc_line", "irc_line"),
        part("raw.username", "username"),
        part("raw.message", "message"),
        part("metadata.event_kind", "event_kind"),
        part("metadata.schema_version", "schema_version"),
    )


# --- parse, validate, route ----------------------------------------------------------------


ENVELOPE_PATHS = (
    "ingestion_ts",
    *[f"source.{name}" for name in ("platform", "protocol", "server", "channel")],
    *[f"raw.{name}" for name in ("irc_line", "username", "message")],
    *[f"metadata.{name}" for name in ("event_kind", "producer_env", "schema_version")],
)


@query("envelope_parse")
def _(spark, sf):
    rows = parse.envelope_parse(derived.bronze(spark, sf))
    return rows.select(
        "source_partition",
        "source_offset",
        "bronze_ingestion_ts",
        "parse_ok",
        *[F.when(F.col("parse_ok"), F.col(f"envelope.{path}")).alias(path.rsplit(".")[-1]) for path in ENVELOPE_PATHS],
    )


@query("parse_split")
def _(spark, sf):
    good, bad = parse.parse_split(parse.envelope_parse(derived.bronze(spark, sf)))
    tagged = good.withColumn("branch", F.lit("parseable")).unionByName(bad.withColumn("branch", F.lit("failed")))
    return tagged.groupBy("branch", "source_partition").agg(F.count(F.lit(1)).alias("row_count"))


@query("blank_to_null")
def _(spark, sf):
    rows = derived.messages(spark, sf)
    return rows.select(
        "event_id",
        blank_to_null(F.col("message")).alias("message_text"),
        blank_to_null(F.concat(F.lit(" "), "event_type"), lower=True).alias("kind"),
    )


@query("parsed_projection")
def _(spark, sf):
    return derived.classified(spark, sf).drop("raw_payload")


@query("event_key")
def _(spark, sf):
    rows = derived.log_rows(spark, sf)
    key = parse.event_key(F.col("topic"), F.col("partition"), F.col("offset"))
    return rows.select(key.alias("event_id"), "topic", "partition", "offset")


@query("valid_filter")
def _(spark, sf):
    return parse.valid_events(derived.classified(spark, sf))


@query("contract_failures")
def _(spark, sf):
    rows = derived.classified(spark, sf)
    return parse.contract_failures(rows, F.col("silver_processed_ts")).drop("raw_payload")


@query("parse_failures")
def _(spark, sf):
    rows = derived.classified(spark, sf)
    return parse.parse_failures(rows, F.col("silver_processed_ts")).drop("raw_payload")


@query("dlq_union")
def _(spark, sf):
    return parse.dead_letters(derived.classified(spark, sf), F.col("silver_processed_ts"))


@query("dlq_union_literal")
def _(spark, sf):
    hour = derived.batch_of(F.col("kafka_timestamp"))
    rows = parse.classify(
        derived.bronze(spark, sf), derived.batch_time(F.lit("run_a"), hour, -5), literal_routing=True
    )
    return parse.dead_letters(rows, F.col("silver_processed_ts"))


@query("dlq_record")
def _(spark, sf):
    checked = quality.assess_records(derived.quality_records(spark, sf)).filter("not accepted")
    failed = checked.select(F.col("record").alias("raw_payload"), "issues", "event_id")
    code = F.when(F.exists("issues", lambda i: i["code"].endswith("type_invalid")), "TYPE_ERROR").when(
        F.exists("issues", lambda i: i["code"].startswith("missing_")), "CONTRACT_ERROR"
    )
    details = F.array_join(F.transform("issues", lambda i: i["detail"]), "; ")
    rows = parse.dlq_record(
        failed.withColumn("source_offset", F.col("event_id")),
        code,
        F.lit(False),
        F.when(code != "CONTRACT_ERROR", details),
        as_of(),
    )
    return rows.drop("raw_payload")


@query("stream_dedupe")
def _(spark, sf):
    return parse.dedupe(parse.valid_events(derived.classified(spark, sf)))


@query("text_contract")
def _(spark, sf):
    return parse.text_contract(derived.bronze(spark, sf), as_of())


@query("json_object_check")
def _(spark, sf):
    rows = derived.bronze(spark, sf)
    code = parse.json_object_check(F.col("raw_payload"))
    listed = parse.json_object_check(F.concat(F.lit("["), "raw_payload", F.lit("]")))
    return rows.select(
        "source_offset", "bronze_ingestion_ts", code.alias("failure_code"), listed.alias("failure_code_in_list")
    )


@query("v1_parse")
def _(spark, sf):
    rows = v1.v1_parse(derived.v1_log(spark, sf))
    kept = [F.when(F.col("parse_ok"), F.col(c)).alias(c) for c in rows.columns[:6]]
    return rows.select(*kept, *rows.columns[6:])


# --- scalar features -----------------------------------------------------------------------


def _features(spark, sf, **options):
    rows = parse.dedupe(parse.valid_events(derived.classified(spark, sf)))
    return message_features(rows, F.col("silver_processed_ts") + derived.seconds(64), **options)


@query("message_features")
def _(spark, sf):
    return _features(spark, sf)


@query("message_features_literal")
def _(spark, sf):
    return _features(spark, sf, literal_patterns=True)


def _single(name: str, build: Query, key: str = "event_id") -> None:
    query(name)(lambda spark, sf: build(spark, sf).select(key, name))


MESSAGE_COLUMNS = SILVER_FEATURES.fieldNames()[1:]
for _name in MESSAGE_COLUMNS:
    _single(_name, _features)


PROFILE_COLUMNS = (
    "profile_message_length",
    "profile_tokens",
    "profile_emote_count",
    "profile_is_emote_only",
    "frequent_char_share",
    "entropy_proxy",
    "contains_link",
    "profile_spam",
    "profile_engagement",
)


def _profile(spark, sf):
    rows = with_text_profile(derived.messages(spark, sf), "message")
    return rows.select("event_id", *PROFILE_COLUMNS).withColumn("profile_tokens", F.size("profile_tokens"))


@query("text_profile")
def _(spark, sf):
    return _profile(spark, sf)


for _name in PROFILE_COLUMNS:
    if _name != "profile_tokens":
        _single(_name, _profile)


@query("profile_tokens")
def _(spark, sf):
    """The tokens themselves, with a separator that no text has."""
    rows = with_text_profile(derived.messages(spark, sf), "message")
    return rows.select("event_id", F.array_join("profile_tokens", "\x1f").alias("profile_tokens"))


@query("v1_enrich")
def _(spark, sf):
    return _v1_silver(spark, sf)


def _enrich_column(name: str, expression: Callable[[Column], Column]) -> None:
    query(name)(
        lambda spark, sf: derived.messages(spark, sf).select("event_id", expression(F.col("message")).alias(name))
    )


_enrich_column("shannon_entropy", shannon_entropy)
_enrich_column("max_run_ratio", max_run_ratio)
_enrich_column("alpha_ratio", alpha_ratio)
_enrich_column("emote_tokens", lambda m: F.array_join(emote_tokens(m), "|"))
_enrich_column("dict_is_emote_only", lambda m: dict_is_emote_only(emote_tokens(m)))
_enrich_column("dict_emote_count", lambda m: dict_emote_count(emote_tokens(m)))
_enrich_column("emote_sentiment", lambda m: emote_sentiment(emote_tokens(m)))


@query("engagement_flag")
def _(spark, sf):
    return _v1_silver(spark, sf).select(*LOG_KEY, "engagement_flag")


@query("lexicon_sentiment")
def _(spark, sf):
    lexicon = tables.literal_table(
        spark, {"token": list(EMOTE_SENTIMENT), "score": list(EMOTE_SENTIMENT.values())}
    )
    return lexicon_scores(derived.messages(spark, sf), lexicon)


# --- versions and joins --------------------------------------------------------------------


@query("latest_parsed")
def _(spark, sf):
    return versions.latest_parsed(derived.parsed(spark, sf))


@query("latest_features")
def _(spark, sf):
    return versions.latest_features(derived.features(spark, sf))


def _joined(spark, sf):
    return versions.parsed_left_features(derived.parsed(spark, sf), derived.features(spark, sf))


@query("parsed_left_features")
def _(spark, sf):
    return _joined(spark, sf)


def _health_inputs(parsed, features, dlq, metrics):
    return health.ops_metrics_minute(metrics), health.freshness_minute(parsed, features), health.dlq_minute(dlq)


def _health_tables(spark, sf):
    return _health_inputs(*(getattr(derived, name)(spark, sf) for name in ("parsed", "features", "dlq", "batch_metrics")))


@query("ops_left_freshness_dlq")
def _(spark, sf):
    return health.ops_left_freshness_dlq(*_health_tables(spark, sf)).select(
        *health.HEALTH_KEY, "batch_count", "dlq_count", "avg_bronze_to_silver_latency_seconds"
    )


@query("message_type_dim_join")
def _(spark, sf):
    fact = messages.chat_messages_fact(_v1_silver(spark, sf))
    joined = messages.message_type_dim_join(fact, messages.message_type_dim(spark))
    return joined.select("message_id", "message_type", "description")


@query("message_type_dim")
def _(spark, sf):
    fact = messages.chat_messages_fact(_v1_silver(spark, sf))
    counted = fact.groupBy("message_type").agg(F.count(F.lit(1)).alias("message_count"))
    return messages.message_type_dim(spark).join(counted, "message_type", "left").fillna(0)


# --- roll-ups and marts --------------------------------------------------------------------


@query("engagement_minute")
def _(spark, sf):
    return engagement.engagement_rollup(_joined(spark, sf), "minute")


@query("engagement_daily")
def _(spark, sf):
    return engagement.engagement_rollup(_joined(spark, sf), "day")


def channel_engagement_minute(spark, sf):
    return engagement.engagement_mart(engagement.engagement_rollup(_joined(spark, sf), "minute"), "minute")


query("channel_engagement_minute")(channel_engagement_minute)


@query("channel_engagement_daily")
def _(spark, sf):
    return engagement.engagement_mart(engagement.engagement_rollup(_joined(spark, sf), "day"), "day")


def _stored(spark, folder, name, rows, columns=None):
    """A table written once, for queries whose branches all read it.

    Of wide rows only the columns are written that the branches read; the others are null.
    """
    rows.select(*(columns or rows.columns)).write.option("compression", layout.COMPRESSION).parquet(f"{folder}/{name}")
    return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")


# Classified rows without their texts.
CLASSIFIED_COLUMNS = (
    "event_id", "source_topic", "source_partition", "source_offset", "event_ts", "bronze_ingestion_ts", "silver_processed_ts",
    "channel", "chatter_id", "message_length", "outcome",
)
WRITE_COLUMNS = ("_run_id", "_job_name", "_batch_id", "_batch_processed_ts")
# What versions and roll-ups read of parsed rows, and the partition, by which features were lost.
ROLLUP_COLUMNS = ("event_id", "event_ts", "channel", "chatter_id", "message_length", "source_partition", "silver_processed_ts", *WRITE_COLUMNS)


def _stored_models(spark, folder, sf):
    """Parsed and feature rows of one pass over the log, without texts: the roll-ups read none."""
    rows = derived.measured(derived.parsed(spark, sf))
    stored = _stored(spark, folder, "measured", rows, [*ROLLUP_COLUMNS, *SILVER_FEATURES.fieldNames()[1:]])
    return stored.select(*with_write_metadata(SILVER_PARSED).fieldNames()), derived.features_of(stored)


def _held(columns, kept):
    """Those of the columns that have values where only ``kept`` ones are stored."""
    return [c for c in columns if c in kept]


def _folded(spark, sf, grain):
    """State of the first run's days before the 20th; its later days and then the second run folded in."""
    stored = _folder(spark)
    folder = f"{stored}/engagement"
    parsed, features = _stored_models(spark, stored, sf)
    first = F.col("_run_id") == RUNS[0]
    held = {*ROLLUP_COLUMNS, *SILVER_FEATURES.fieldNames()}
    before = versions.parsed_left_features(parsed.filter(first), features.filter(first))
    before = _stored(spark, stored, "before", before, _held(before.columns, held))
    cut = F.lit("2024-01-20").cast("timestamp")
    state.fold(spark, folder, grain, before.filter(F.col("event_ts") < cut), RUNS[0], 0)
    state.fold(spark, folder, grain, before.filter(F.col("event_ts") >= cut), RUNS[0], 1)
    again = parsed.filter(F.col("_run_id") == RUNS[1]).select("event_id").distinct()
    now = versions.parsed_left_features(parsed, features)
    now = _stored(spark, stored, "now", now, _held(now.columns, held))
    old, new = (rows.join(again, "event_id", "left_semi") for rows in (before, now))
    state.fold(spark, folder, grain, new, RUNS[1], 0, old)
    return state.rollup(state.read_state(spark, folder), grain)


@query("engagement_minute_state")
def _(spark, sf):
    return _folded(spark, sf, "minute")


@query("engagement_daily_state")
def _(spark, sf):
    return _folded(spark, sf, "day")


def _refresh(spark, sf, grain):
    """The mart of the first run, brought up to date for the days the second run wrote."""
    parsed, features = _stored_models(spark, _folder(spark), sf)
    build = lambda joined: engagement.engagement_mart(engagement.engagement_rollup(joined, grain), grain)
    first = F.col("_run_id") == RUNS[0]
    mart = build(versions.parsed_left_features(parsed.filter(first), features.filter(first)))
    days = refresh.touched_days(parsed.filter(~first))
    return refresh.refreshed(mart, engagement.GRAIN_COLUMNS[grain][1], parsed, features, days, build)


@query("channel_engagement_daily_refresh")
def _(spark, sf):
    return _refresh(spark, sf, "day")


@query("channel_engagement_minute_refresh")
def _(spark, sf):
    return _refresh(spark, sf, "minute")


@query("ops_metrics_minute")
def _(spark, sf):
    return health.ops_metrics_minute(derived.batch_metrics(spark, sf))


@query("dlq_minute")
def _(spark, sf):
    return health.dlq_minute(derived.dlq(spark, sf))


@query("freshness_minute")
def _(spark, sf):
    return health.freshness_minute(derived.parsed(spark, sf), derived.features(spark, sf))


def _health(spark, sf):
    return health.health_minute(*_health_tables(spark, sf))


@query("health_minute")
def _(spark, sf):
    return _health(spark, sf)


@query("chat_metrics_minute")
def _(spark, sf):
    return messages.chat_metrics_minute(_v1_silver(spark, sf))


@query("sentiment_summary")
def _(spark, sf):
    return messages.sentiment_summary(messages.chat_messages_fact(_v1_silver(spark, sf)))


@query("chat_messages_fact")
def _(spark, sf):
    return messages.chat_messages_fact(_v1_silver(spark, sf))


# --- streams -------------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder of its own below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/stream-{uuid4().hex}"


# The log arrives in deliveries of eight days, by time of capture; what was captured an hour late or
# more waits ten days longer. Each is written as so many files, the limit of a trigger, so it becomes
# one micro-batch.
# The number grows with the log, so that no file, and no task that writes one, does.
DELIVERIES, DELIVERY_DAYS, DELIVERY_FILES = 4, 8, 4
LOG_FILE_BYTES = 16 << 20
STREAM_WATERMARK = "10 minutes"


def _log_files(spark, rows: DataFrame, folder: str, deliveries: range = range(DELIVERIES)) -> tuple[str, int]:
    """Log records as files, delivery after delivery, as a connector would hand them on; and the files of each."""
    staged = f"{folder}/staged"
    if deliveries.start == 0:
        waits = F.when(F.unix_timestamp("_arrival") - F.unix_timestamp("timestamp") > derived.HOUR, 10).otherwise(0)
        day = F.datediff("_arrival", F.lit("2024-01-01").cast("date")) + waits
        number = F.least(F.floor(day / DELIVERY_DAYS), F.lit(DELIVERIES - 1)).cast("int")
        records = rows.select(F.col("key").cast("binary"), F.col("value").cast("binary"), *LOG_KEY, "timestamp", "timestampType", number.alias("_delivery"))
        records.write.option("compression", layout.COMPRESSION).partitionBy("_delivery").parquet(staged)
    largest = max(layout.group_bytes(spark, staged, "_delivery").values(), default=0)
    files = max(DELIVERY_FILES, math.ceil(largest / LOG_FILE_BYTES))
    for k in deliveries:
        part = spark.read.parquet(staged).where(F.col("_delivery") == k).drop("_delivery")
        part.repartition(files).write.option("compression", layout.COMPRESSION).parquet(f"{folder}/log/{k}")
    return f"{folder}/log/*", files


def _log_stream(spark, rows: DataFrame, folder: str, deliveries: range = range(DELIVERIES)) -> DataFrame:
    path, files = _log_files(spark, rows, folder, deliveries)
    return log.file_log_stream(spark, path, max_files_per_trigger=files)


def _bronze_stream(spark, sf, folder):
    stream = _log_stream(spark, derived.log_rows(spark, sf), folder)
    capture = jobs.kafka_to_bronze_stream(
        stream, f"{folder}/bronze", f"{folder}/cp_bronze", "run_a", as_of=F.col("timestamp")
    )
    jobs.await_all(capture)
    return tables.stream_table_scan(spark, f"{folder}/bronze", with_write_metadata(BRONZE_RAW))


def _silver_stream(spark, sf, folder):
    """Two deliveries, a restart, two more; batch by batch into parsed, dlq, ledger and progress."""
    rows = derived.log_rows(spark, sf)
    for part in (range(2), range(2, DELIVERIES)):
        raw = log.bronze_projection(_log_stream(spark, rows, folder, part), F.col("timestamp"))
        with jobs.state_settings(spark, spark.sparkContext.defaultParallelism):
            query = jobs.bronze_to_silver_stream(
                raw,
                f"{folder}/parsed",
                f"{folder}/dlq",
                f"{folder}/cp_silver",
                "run_a",
                watermark=STREAM_WATERMARK,
                as_of=F.col("bronze_ingestion_ts"),
                ledger=f"{folder}/ledger",
            )
        jobs.await_all(query)
        ledger.record_progress(query, f"{folder}/progress", "run_a", PARSE_STAGE)


@query("kafka_to_bronze_stream")
def _(spark, sf):
    folder = _folder(spark)
    _bronze_stream(spark, sf, folder)
    return tables.read_table(spark, f"{folder}/bronze", with_write_metadata(BRONZE_RAW)).drop("_batch_processed_ts")


@query("stream_table_scan")
def _(spark, sf):
    folder = _folder(spark)
    scan = sinks.stream_append(
        _bronze_stream(spark, sf, folder).select(*BRONZE_RAW.fieldNames()), f"{folder}/copy", f"{folder}/cp_copy", "run_a", "copy"
    )
    jobs.await_all(scan)
    return tables.read_table(spark, f"{folder}/copy", BRONZE_RAW)


def _committed(spark, folder, name, schema):
    """A target of the parse stream: whole batches only."""
    book = tables.read_table(spark, f"{folder}/ledger", BATCH_LEDGER)
    rows = tables.read_table(spark, f"{folder}/{name}", with_write_metadata(schema))
    return ledger.committed(rows, book).select(*schema.fieldNames(), "_run_id", "_job_name", "_batch_id")


@query("bronze_to_silver_stream")
def _(spark, sf):
    folder = _folder(spark)
    _silver_stream(spark, sf, folder)
    place = ("target", "source_topic", "source_partition", "source_offset", "_batch_id")
    good = _committed(spark, folder, "parsed", SILVER_PARSED).withColumn("target", F.lit("parsed"))
    bad = _committed(spark, folder, "dlq", DLQ).withColumn("target", F.lit("dlq"))
    return good.select(*place, "message_text").unionByName(
        bad.select(*place, "error_code", "raw_payload"), allowMissingColumns=True
    )


@query("watermark_dedupe_stream")
def _(spark, sf):
    folder = _folder(spark)
    _silver_stream(spark, sf, folder)
    return _committed(spark, folder, "parsed", SILVER_PARSED)


FEATURE_FILES = 100


@query("silver_to_features_stream")
def _(spark, sf):
    folder = _folder(spark)
    _silver_stream(spark, sf, folder)
    parsed = tables.stream_table_scan(
        spark, f"{folder}/parsed", with_write_metadata(SILVER_PARSED), max_files_per_trigger=FEATURE_FILES
    )
    jobs.await_all(
        jobs.silver_to_features_stream(
            parsed, f"{folder}/features", f"{folder}/cp_features", "run_a", as_of=F.col("silver_processed_ts")
        )
    )
    return tables.read_table(spark, f"{folder}/features", SILVER_FEATURES)


@query("v1_foreach_batch")
def _(spark, sf):
    folder = _folder(spark)
    stream = _log_stream(spark, derived.v1_log(spark, sf), folder)
    jobs.await_all(
        jobs.v1_foreach_batch(
            stream, f"{folder}/bronze", f"{folder}/silver", f"{folder}/cp", as_of=F.col("kafka_timestamp")
        )
    )
    jobs.compact_statuses(spark, f"{folder}/bronze", least_files=2)
    raw = jobs.v1_bronze(spark, f"{folder}/bronze")
    silver = tables.read_table(spark, f"{folder}/silver", V1_SILVER)
    return raw.join(silver.drop("kafka_timestamp", "ingest_ts"), list(LOG_KEY), "left").select(
        *LOG_KEY, "json_payload", "parse_status", "parse_error", "user", "message_length", "emote_count", "engagement_flag"
    )


@query("replay")
def _(spark, sf):
    """Some days of a table that lies by day, of which the closed ones are compacted."""
    target = f"{_folder(spark)}/bronze"
    _batches(spark, sf, target)
    sinks.compact_days(spark, target, BRONZE_RAW, datetime(2024, 1, 23).date())
    start, end = datetime(2024, 1, 20, tzinfo=timezone.utc), datetime(2024, 1, 25, tzinfo=timezone.utc)
    scope = jobs.replay_scope(sinks.read_batches(spark, target, BRONZE_RAW), start, end)
    valid, _dead = jobs.replay(scope, "run_b", 0, as_of(), F.col("bronze_ingestion_ts"))
    return valid


@query("late_row_audit")
def _(spark, sf):
    folder = _folder(spark)
    _silver_stream(spark, sf, folder)
    raw = log.bronze_projection(spark.read.schema(LOG_RECORD).parquet(f"{folder}/log/*"), F.col("timestamp"))
    return triage.stream_audit(
        parse.classify(raw, F.col("bronze_ingestion_ts")),
        _committed(spark, folder, "parsed", SILVER_PARSED),
        _committed(spark, folder, "dlq", DLQ),
        ledger.progress(spark, f"{folder}/progress"),
        ledger.remembered_keys(spark, f"{folder}/cp_silver"),
    )


@query("late_row_audit_of_tables")
def _(spark, sf):
    rows = derived.classified(spark, sf)
    on_time = F.unix_timestamp("bronze_ingestion_ts") - F.unix_timestamp("event_ts") <= 2 * derived.HOUR
    kept = parse.dedupe(parse.valid_events(rows.filter(on_time)))
    return triage.late_row_audit(rows, kept)


# --- observability -------------------------------------------------------------------------


@query("event_ingest_lag")
def _(spark, sf):
    rows = observe.event_ingest_lag(derived.parsed(spark, sf))
    return rows.select("event_id", "_run_id", "event_time_to_ingest_lag_seconds")


@query("bronze_silver_latency")
def _(spark, sf):
    rows = observe.bronze_silver_latency(derived.parsed(spark, sf))
    return rows.select("event_id", "_run_id", "bronze_to_silver_latency_seconds")


@query("last_batch_age")
def _(spark, sf):
    return observe.last_batch_age(derived.batch_metrics(spark, sf), as_of())


def _freshness(spark, sf):
    return observe.freshness_snapshot(derived.parsed(spark, sf), derived.batch_metrics(spark, sf), as_of())


@query("freshness_snapshot")
def _(spark, sf):
    return _freshness(spark, sf)


@query("volume_snapshot")
def _(spark, sf):
    return observe.volume_snapshot(derived.batch_metrics(spark, sf))


DRIFT_COLUMNS = ("missing_required_fields", "unexpected_fields", "type_drift_fields")


@query("schema_drift")
def _(spark, sf):
    rows = observe.schema_drift(derived.bronze(spark, sf))
    joined = [F.array_join(c, ",").alias(c) for c in DRIFT_COLUMNS]
    return rows.select("source_offset", "bronze_ingestion_ts", *joined, "action")


@query("schema_drift_summary")
def _(spark, sf):
    return observe.schema_drift_summary(observe.schema_drift(derived.bronze(spark, sf), fail_fast=False))


def _drifting(spark, sf):
    """Raw rows of which every fifth has an object that is not expected, and every seventh a number for a text."""
    rows = derived.bronze(spark, sf)
    badges = F.replace("raw_payload", F.lit('"raw":{'), F.lit('"raw":{"badges":{"vip":true,"level":3},'))
    rows = rows.withColumn("raw_payload", F.when(F.col("source_offset") % 5 == 0, badges).otherwise(F.col("raw_payload")))
    number = F.replace("raw_payload", F.lit('"protocol":"irc"'), F.lit('"protocol":6667'))
    return rows.withColumn("raw_payload", F.when(F.col("source_offset") % 7 == 0, number).otherwise(F.col("raw_payload")))


@query("schema_drift_paths")
def _(spark, sf):
    rows = observe.schema_drift_paths(_drifting(spark, sf))
    joined = [F.array_join(c, ",").alias(c) for c in DRIFT_COLUMNS]
    return rows.select("source_offset", "bronze_ingestion_ts", *joined, "action")


@query("schema_drift_paths_summary")
def _(spark, sf):
    return observe.schema_drift_summary(observe.schema_drift_paths(_drifting(spark, sf), fail_fast=False))


@query("schema_union")
def _(spark, sf):
    return observe.schema_union(_drifting(spark, sf))


@query("slo_breached")
def _(spark, sf):
    rows = _health(spark, sf)
    return rows.select(
        "run_id", "minute_ts", "pipeline_stage", "dlq_rate", observe.slo_breached(F.col("dlq_rate")).alias("slo_breached")
    )


@query("micro_batch_success_ratio")
def _(spark, sf):
    return observe.micro_batch_success_ratio(derived.batch_metrics(spark, sf))


@query("healthy_run_pct")
def _(spark, sf):
    return observe.healthy_run_pct(triage.run_summary(derived.batch_metrics(spark, sf)))


@query("uptime_proxy_pct")
def _(spark, sf):
    return observe.uptime_proxy_pct(derived.batch_metrics(spark, sf))


@query("healthy_interval_pct")
def _(spark, sf):
    return observe.healthy_interval_pct(_health(spark, sf))


# --- quality and contracts -----------------------------------------------------------------


def _assessed(spark, sf):
    return quality.assess_records(derived.quality_records(spark, sf))


def _codes(predicate) -> Column:
    return F.array_join(F.transform(F.filter("issues", predicate), lambda i: i["code"]), ",")


@query("required_fields_check")
def _(spark, sf):
    return _assessed(spark, sf).select(
        "event_id", F.array_join("missing_fields", ",").alias("missing_fields")
    )


@query("message_size_check")
def _(spark, sf):
    rows = derived.messages(spark, sf)
    return rows.select("event_id", quality.message_size_ok(F.col("message")).alias("size_ok"))


@query("type_sanity_check")
def _(spark, sf):
    codes = _codes(lambda i: i["code"].endswith("type_invalid"))
    return _assessed(spark, sf).select("event_id", codes.alias("type_issues"))


@query("suspicious_chars_check")
def _(spark, sf):
    return _assessed(spark, sf).select(
        "event_id", _codes(lambda i: i["severity"] == quality.WARNING).alias("warnings")
    )


@query("assess_records")
def _(spark, sf):
    return _assessed(spark, sf).select("event_id", "accepted", _codes(lambda i: F.lit(True)).alias("issue_codes"))


@query("contract_check")
def _(spark, sf):
    checked = [
        checks.contract_check(df, dataset)
        for dataset, df in (
            ("silver_chat_parsed", derived.classified(spark, sf)),
            ("chat_dlq", derived.dlq(spark, sf)),
            ("streaming_batch_metrics", derived.batch_metrics(spark, sf)),
        )
    ]
    return checked[0].unionByName(checked[1]).unionByName(checked[2])


def _published(parsed, dlq):
    """The parsed table, and a copy with known faults: rows twice, nulls, no length, and a failure among the events."""
    number = F.col("source_offset")
    twice = F.when(number % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    broken = parsed.withColumns(
        {
            "channel": F.when(number % 70 != 0, F.col("channel")),
            "message_length": F.when(number % 90 == 0, 0).otherwise(F.col("message_length")),
        }
    )
    broken = broken.select("*", F.explode(twice).alias("_copy")).drop("_copy")
    failed = dlq.where("error_category = 'CONTRACT_ERROR' and source_offset % 3 = 0")
    event_id = parse.event_key(F.col("source_topic"), F.col("source_partition"), F.col("source_offset"))
    landed = failed.select("_run_id", event_id.alias("event_id"), F.lit("late").alias("message_text"), F.lit(4).alias("message_length"))
    return {"published": parsed, "broken": broken.unionByName(landed, allowMissingColumns=True)}


@query("parsed_contract_check")
def _(spark, sf):
    dlq = derived.dlq(spark, sf)
    parts = [
        checks.parsed_contract_check(rows, dlq).withColumn("relation", F.lit(name))
        for name, rows in _published(derived.parsed(spark, sf), dlq).items()
    ]
    return parts[0].unionByName(parts[1])


@query("schema_contract_check_published")
def _(spark, sf):
    """Three contract tables as published."""
    result = None
    for dataset, rows, schema in (
        ("silver_chat_parsed", derived.parsed(spark, sf), SILVER_PARSED),
        ("chat_dlq", derived.dlq(spark, sf), DLQ),
        ("streaming_batch_metrics", derived.batch_metrics(spark, sf), BATCH_METRICS),
    ):
        checked = checks.schema_contract_check(rows, schema).withColumn("dataset", F.lit(dataset))
        result = checked if result is None else result.unionByName(checked)
    return result


# Columns with declared tests (not null; unique).
MODEL_TESTS = {
    "parsed": (("event_id", "channel", "chatter_id"), ()),
    "features": (("event_id",), ()),
    "parsed_left_features": (("event_id",), ("event_id",)),
    "batch_metrics": (("run_id", "job_name", "batch_id"), ()),
    "engagement_minute": (("event_minute", "channel"), ()),
    "engagement_daily": (("event_date", "channel"), ()),
    "ops_metrics_minute": (("pipeline_stage", "event_minute"), ()),
    "dlq_minute": (("pipeline_stage", "event_minute"), ()),
    "freshness_minute": (("pipeline_stage", "event_minute"), ()),
    "channel_engagement_minute": (("minute_ts", "channel"), ()),
    "channel_engagement_daily": (("date_day", "channel"), ()),
    "health_minute": (("minute_ts", "pipeline_stage"), ()),
}


@query("model_tests")
def _(spark, sf):
    """Every declared test, on the published models and on the broken copy of the parsed table."""
    folder = _folder(spark)
    rows = _stored(spark, folder, "classified", derived.classified(spark, sf), CLASSIFIED_COLUMNS)
    parsed = derived.parsed(spark, sf, rows)
    parsed = _stored(spark, folder, "parsed", parsed, _held(parsed.columns, {*CLASSIFIED_COLUMNS, *WRITE_COLUMNS}))
    features = derived.features_of(derived.measured(parsed))
    dlq = derived.dlq(spark, sf, rows)
    metrics = _stored(spark, folder, "metrics", derived.batch_metrics(spark, sf, rows))
    joined = versions.parsed_left_features(parsed, features)
    rollups = {grain: engagement.engagement_rollup(joined, grain) for grain in engagement.GRAIN_COLUMNS}
    health_inputs = _health_inputs(parsed, features, dlq, metrics)
    models = {
        "parsed": parsed,
        "features": features,
        "parsed_left_features": joined,
        "batch_metrics": metrics,
        "engagement_minute": rollups["minute"],
        "engagement_daily": rollups["day"],
        **dict(zip(("ops_metrics_minute", "freshness_minute", "dlq_minute"), health_inputs)),
        "channel_engagement_minute": engagement.engagement_mart(rollups["minute"], "minute"),
        "channel_engagement_daily": engagement.engagement_mart(rollups["day"], "day"),
        "health_minute": health.health_minute(*health_inputs),
    }
    result = checks.model_tests(_published(parsed, dlq)["broken"], "parsed_broken", *MODEL_TESTS["parsed"][:1], ("event_id",))
    for model, tests in MODEL_TESTS.items():
        result = result.unionByName(checks.model_tests(models[model], model, *tests))
    return result


@query("schema_contract_check")
def _(spark, sf):
    return checks.schema_contract_check(derived.classified(spark, sf), SILVER_PARSED)


@query("check_not_null")
def _(spark, sf):
    return checks.check_not_null(derived.classified(spark, sf), SILVER_PARSED.fieldNames())


@query("check_unique")
def _(spark, sf):
    rows = derived.parsed(spark, sf)
    appended = checks.check_unique(rows, "event_id").withColumn("relation", F.lit("appended"))
    newest = checks.check_unique(versions.latest_parsed(rows), "event_id").withColumn("relation", F.lit("latest"))
    return appended.unionByName(newest)


@query("check_unique_combination")
def _(spark, sf):
    return checks.check_unique(derived.v1_log(spark, sf), *LOG_KEY)


V1_EXPRESSIONS = {
    "sent_compound_range": "sent_compound between -1.0 and 1.0",
    "sent_pos_range": "sent_pos between 0.0 and 1.0",
    "sent_neg_range": "sent_neg between 0.0 and 1.0",
    "sent_neu_range": "sent_neu between 0.0 and 1.0",
    "message_length_positive": "message_length > 0",
}


@query("check_expression")
def _(spark, sf):
    return checks.check_expression(_v1_silver(spark, sf), V1_EXPRESSIONS)


@query("check_accepted_values")
def _(spark, sf):
    rows = derived.classified(spark, sf)
    known = checks.check_accepted_values(derived.dlq(spark, sf), "error_category", DLQ_CATEGORIES)
    return known.unionByName(checks.check_accepted_values(rows, "outcome", DLQ_CATEGORIES))


# --- operational analyses ------------------------------------------------------------------


@query("dlq_triage")
def _(spark, sf):
    window = triage.in_window(
        derived.dlq(spark, sf), "dlq_ingestion_ts", datetime(2024, 1, 10, tzinfo=timezone.utc)
    )
    return triage.dlq_triage(window)


@query("dlq_hotspots")
def _(spark, sf):
    return triage.dlq_hotspots(derived.dlq(spark, sf))


@query("dlq_vs_batches")
def _(spark, sf):
    return triage.dlq_vs_batches(derived.dlq(spark, sf), derived.batch_metrics(spark, sf))


@query("latest_batch_by_job")
def _(spark, sf):
    return triage.latest_batch_by_job(derived.batch_metrics(spark, sf), as_of(), 20 * 86400.0)


@query("row_count_by_job")
def _(spark, sf):
    return triage.row_count_by_job(derived.batch_metrics(spark, sf))


@query("batch_shape")
def _(spark, sf):
    return triage.batch_shape(derived.batch_metrics(spark, sf))


@query("run_comparison")
def _(spark, sf):
    return triage.run_comparison(derived.batch_metrics(spark, sf), RUNS)


@query("run_reconciliation")
def _(spark, sf):
    raw = derived.bronze(spark, sf).withColumn("_run_id", F.lit("run_a"))
    run_a = F.col("_run_id") == "run_a"
    return triage.run_reconciliation(
        raw,
        derived.parsed(spark, sf).filter(run_a),
        derived.features(spark, sf).filter(run_a),
        derived.dlq(spark, sf).filter(run_a),
    )


@query("cost_per_million")
def _(spark, sf):
    summary = triage.run_summary(derived.batch_metrics(spark, sf))
    costs = summary.select("run_id", (F.col("batch_count") * 0.05).alias("total_cost_usd"))
    return triage.cost_per_million(summary, costs)


@query("metric_long_format")
def _(spark, sf):
    folder = _folder(spark)
    rows = _stored(spark, folder, "classified", derived.classified(spark, sf), CLASSIFIED_COLUMNS)
    metrics = _stored(spark, folder, "metrics", derived.batch_metrics(spark, sf, rows))
    parsed, dlq = derived.parsed(spark, sf, rows), derived.dlq(spark, sf, rows)
    volumes = observe.volume_snapshot(metrics).groupBy("run_id", "job_name").agg(
        F.avg("records_in_micro_batch").alias("avg_records"), F.sum("delta_records").alias("total_delta")
    )
    drift = observe.schema_drift_summary(observe.schema_drift(derived.bronze(spark, sf)))
    labelled = drift.select(F.concat_ws(":", "drift_kind", "field").alias("label"), "records")
    return triage.metric_long_format(
        observe.freshness_snapshot(parsed, metrics, as_of()),
        volumes,
        triage.dlq_triage(dlq),
        labelled,
        observe.uptime_proxy_pct(metrics),
    )
