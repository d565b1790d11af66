"""Chat-shaped inputs that Spark derives from the given tables.

Every event becomes one log record. Its message is the whole text of the document with the
same id, or a short line made from the event itself. Irregular records come from the
events' own values: see the predicates below.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlens.functions.message import with_message_features
from chatlens.operators.irc import iso_instant
from chatlens.operators.parse import VALID, classify, dead_letters, dedupe, valid_events
from chatlens.schemas import BRONZE_STAGE, FEATURE_STAGE, PARSE_STAGE, SILVER_FEATURES
from chatlens.sources import layout
from chatlens.sources.log import bronze_projection
from chatlens.streaming.sinks import with_batch_metadata

TRUNCATED = "event_type = 'error' and value < 10"
BLANK = "event_type = 'signup' and value < 10"
NO_SOURCE = "event_type = 'view' and value < 5"
NUMERIC_TIME = "event_type = 'click' and value < 5"
EXTRA_FIELD = "event_type = 'purchase' and value >= 100"
CAPTURED_TWICE = "event_type = 'purchase' and value >= 100"
LATE = "event_type = 'click' and value >= 100"
REPLAYED = "event_ts >= timestamp'2024-01-20 00:00:00'"
FEATURES_LOST = "_run_id = 'run_a' and channel = '#click' and source_partition = 3"

TARGETS = {
    "bronze": "lake.bronze.bronze_chat_raw",
    "parsed": "lake.silver.silver_chat_parsed",
    "features": "lake.silver.silver_chat_features",
    "dlq": "lake.silver.chat_dlq",
}
JOIN_BYTES = 32 << 20  # of the stored tables, for each partition of their join
HOUR = 3600
FIRST_HOUR = 473352  # hours from the epoch to 2024-01-01


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def seconds(n: Column | int) -> Column:
    return F.make_dt_interval(secs=(n if isinstance(n, Column) else F.lit(n)).cast("decimal(18,6)"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def short_line() -> Column:
    kind = F.col("event_type")
    run = F.repeat(F.lit("W"), F.floor(F.col("value") / 20).cast("int"))
    return (
        F.when(kind == "view", F.concat(F.lit("check http://shop.example/u"), "user_id", F.lit(" now")))
        .when(kind == "click", F.concat(F.lit("Kappa "), "props"))
        .when(kind == "purchase", F.concat(run, F.lit(" LUL")))
        .when(kind == "error", F.when(F.col("value") < 100, "FeelsBadMan 4Head!").otherwise("broken :("))
        .otherwise(F.concat(F.lit("Hello\nñandú "), "user_id"))
    )


def join_partitions(spark: SparkSession, sf: str) -> int:
    """Partitions of a join of events and texts: the session's number, or more, so that none grows with the tables."""
    given = layout.stored_bytes(spark, f"{sf}/documents.parquet", f"{sf}/events.parquet")
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(given / JOIN_BYTES))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    # Whole texts are no broadcast side at any size: both inputs are placed by id, which also
    # spreads the text work over the cluster however few files the tables come in.
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("event_id"), "text")
    said = events(spark, sf)
    parts = join_partitions(spark, sf)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        said, texts = said.repartition(parts, "event_id"), texts.repartition(parts, "event_id")
    joined = said.join(texts.hint("merge"), "event_id", "left")
    return joined.withColumn(
        "message", F.when(F.expr(BLANK), F.lit("   ")).otherwise(F.coalesce("text", short_line()))
    ).drop("text")


def _payload() -> Column:
    chat = F.struct(
        F.lit("Twitch").alias("platform"),
        F.lit("irc").alias("protocol"),
        F.lit("irc.example.org").alias("server"),
        F.concat(F.lit("#"), F.upper("event_type")).alias("channel"),
    )
    parts = [
        F.when(~F.expr(NO_SOURCE), chat).alias("source"),
        F.struct(
            F.concat(F.lit("  User"), "user_id").alias("username"), F.col("message").alias("message")
        ).alias("raw"),
        F.struct(
            F.lit("chat_message").alias("event_kind"),
            F.lit("test").alias("producer_env"),
            F.lit("1.0.0").alias("schema_version"),
        ).alias("metadata"),
        F.when(F.expr(EXTRA_FIELD), F.col("props")).alias("client_info"),
    ]
    by_text = F.to_json(F.struct(iso_instant(F.col("ts")).alias("ingestion_ts"), *parts))
    by_number = F.to_json(F.struct(F.unix_timestamp("ts").alias("ingestion_ts"), *parts))
    return F.when(F.expr(NUMERIC_TIME), by_number).otherwise(by_text)


def _cut(whole: Column) -> Column:
    """The first half of a record: what a broken connection leaves."""
    half = F.floor(F.length(whole) / 2).cast("int")
    return F.when(F.expr(TRUNCATED), F.substring(whole, F.lit(1), half)).otherwise(whole)


def _as_log(source: DataFrame, topic: str, payload: Column) -> DataFrame:
    """Log records keyed by chatter; some are captured a second time a minute later."""
    arrival = F.col("ts") + seconds(F.when(F.expr(LATE), 3 * HOUR).otherwise(2))
    captures = F.when(F.expr(CAPTURED_TWICE), F.array(F.lit(0), F.lit(60))).otherwise(F.array(F.lit(0)))
    return (
        source.withColumn("_whole", payload)
        .select(
            F.col("user_id").cast("string").alias("key"),
            _cut(F.col("_whole")).alias("value"),
            F.lit(topic).alias("topic"),
            (F.col("user_id") % 4).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").alias("timestamp"),
            F.lit(0).alias("timestampType"),
            arrival.alias("_first_capture"),
            F.explode(captures).alias("_delay"),
        )
        .withColumn("_arrival", F.col("_first_capture") + seconds(F.col("_delay")))
        .drop("_first_capture", "_delay")
    )


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _as_log(messages(spark, sf), "chat_raw", _payload())


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_projection(log_rows(spark, sf), F.col("_arrival"))


def batch_of(ts: Column) -> Column:
    """Hourly micro-batches."""
    return F.floor(F.unix_timestamp(ts) / HOUR) - FIRST_HOUR


def batch_time(run_id: Column, batch_id: Column, lag: int) -> Column:
    """Forty seconds after the hour, plus the stage's lag; the replay runs thirty days later."""
    later = F.when(run_id == "run_b", 30 * 24 * HOUR).otherwise(0)
    return F.timestamp_seconds((batch_id + FIRST_HOUR + 1) * HOUR + 40 + lag + later)


def classified(spark: SparkSession, sf: str) -> DataFrame:
    hour = batch_of(F.col("kafka_timestamp"))
    return classify(bronze(spark, sf), as_of=batch_time(F.lit("run_a"), hour, -5))


def _runs(df: DataFrame, event_ts: str) -> DataFrame:
    """Every row in run_a; rows of the replay window in run_b as well."""
    replayed = F.expr(REPLAYED.replace("event_ts", event_ts))
    runs = F.when(replayed, F.array(F.lit("run_a"), F.lit("run_b"))).otherwise(F.array(F.lit("run_a")))
    return df.select("*", F.explode(runs).alias("_run"))


def _stamp(df: DataFrame, event_ts: str, job: str, lag: int = 0) -> DataFrame:
    batch_id = batch_of(F.col(event_ts))
    stamped = with_batch_metadata(df, F.col("_run"), job, batch_id, batch_time(F.col("_run"), batch_id, lag))
    return stamped.drop("_run")


def parsed(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Append-only parsed table of two runs; ``rows`` are classified rows that are stored already."""
    rows = classified(spark, sf) if rows is None else rows
    rows = _stamp(_runs(dedupe(valid_events(rows)), "event_ts"), "event_ts", PARSE_STAGE)
    return rows.withColumn("silver_processed_ts", F.col("_batch_processed_ts") - seconds(5))


def measured(parsed_rows: DataFrame) -> DataFrame:
    """Parsed rows with the values their feature rows have."""
    when = F.col("_batch_processed_ts") + seconds(58)
    return with_message_features(parsed_rows.withColumn("_when", when), as_of=F.col("_when")).drop("_when")


def features_of(measured_rows: DataFrame) -> DataFrame:
    """Append-only feature table; some features of run_a were never written."""
    rows = measured_rows.filter(f"not ({FEATURES_LOST})")
    narrow = rows.select(*SILVER_FEATURES.fieldNames(), F.col("_run_id").alias("_run"), F.col("event_ts").alias("_event_ts"))
    return _stamp(narrow, "_event_ts", FEATURE_STAGE, 60).drop("_event_ts")


def features(spark: SparkSession, sf: str) -> DataFrame:
    return features_of(measured(parsed(spark, sf)))


def dlq(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Dead letters of two runs."""
    rows = classified(spark, sf) if rows is None else rows
    rows = _stamp(_runs(dead_letters(rows), "source_event_ts"), "source_event_ts", PARSE_STAGE)
    return rows.withColumn("dlq_ingestion_ts", F.col("_batch_processed_ts") - seconds(3))


def batch_metrics(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """One row per run, batch and target, counted in one pass over classified rows.

    Copies are counted per event before rows gather by batch; run_b re-reads raw rows, so it
    has no capture rows of its own.
    """
    rows = _runs(classified(spark, sf) if rows is None else rows, "event_ts")
    lost = F.expr(FEATURES_LOST.replace("_run_id", "_run"))
    good = F.col("outcome") == VALID
    per_event = rows.groupBy("_run", batch_of(F.col("event_ts")).alias("batch_id"), "event_id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max(good.cast("int")).alias("valid"),
        F.count_if(~good).alias("dead"),
        F.max((good & ~F.coalesce(lost, F.lit(False))).cast("int")).alias("featured"),
    )
    per_batch = per_event.groupBy("_run", "batch_id").agg(
        *[F.sum(c).alias(c) for c in ("copies", "valid", "dead", "featured")]
    )

    def row(job: str, count: str, target: str, lag: int) -> Column:
        return F.struct(
            F.lit(job).alias("job_name"),
            batch_time(F.col("_run"), F.col("batch_id"), lag).alias("batch_processed_ts"),
            F.col(count).alias("row_count"),
            F.lit(TARGETS[target]).alias("target_table"),
        )

    silver = [
        row(PARSE_STAGE, "valid", "parsed", 0),
        row(PARSE_STAGE, "dead", "dlq", 0),
        row(FEATURE_STAGE, "featured", "features", 60),
    ]
    capture = row(BRONZE_STAGE, "copies", "bronze", -30)
    written = F.when(F.col("_run") == "run_a", F.array(capture, *silver)).otherwise(F.array(*silver))
    return per_batch.select(F.col("_run").alias("run_id"), "batch_id", F.inline(written)).select(
        "run_id", "job_name", "batch_id", "batch_processed_ts", "row_count", "target_table"
    )


def chat_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Chat-protocol lines: messages, joins, keep-alives and blanks, by event type."""
    kind = F.col("event_type")
    who = F.concat(F.lit(":User"), "user_id", F.lit("!user"), "user_id", F.lit("@host "))
    room = F.concat(F.lit("#room"), (F.col("user_id") % 4).cast("string"))
    line = (
        F.when(kind == "error", F.when(F.col("value") < 100, "PING :server").otherwise("  \r\n"))
        .when(kind == "signup", F.concat(who, F.lit("JOIN "), room))
        .when(kind == "view", F.concat(who, F.lit("PRIVMSG "), room))
        .otherwise(F.concat(who, F.lit("PRIVMSG "), room, F.lit(" :"), "message", F.lit("\r\n")))
    )
    return messages(spark, sf).select("event_id", "ts", room.alias("channel"), line.alias("line"))


def v1_log(spark: SparkSession, sf: str) -> DataFrame:
    """First-generation payloads {user, message, sentiment}."""
    score = F.round(F.least(F.col("value") / 245 - 1, F.lit(1.0)), 4)
    scores = {
        "neg": F.greatest(-score, F.lit(0.0)),
        "neu": 1 - F.abs(score),
        "pos": F.greatest(score, F.lit(0.0)),
        "compound": score,
    }
    sentiment = F.struct(*[c.cast("decimal(6,4)").alias(name) for name, c in scores.items()])
    payload = F.to_json(
        F.struct(F.concat(F.lit("user"), "user_id").alias("user"), "message", sentiment.alias("sentiment"))
    )
    return _as_log(messages(spark, sf), "chat_enriched", payload)


def quality_records(spark: SparkSession, sf: str) -> DataFrame:
    """Loosely typed JSON records of both generations, with faults taken from the events."""
    kind, value = F.col("event_type"), F.col("value")
    said = F.when(value >= 20, F.col("message"))
    v1 = F.to_json(F.struct(F.concat(F.lit("u"), "user_id").alias("user"), said.alias("message")))
    body = F.when((kind == "error") & (value >= 100), F.concat(F.lit("\x07"), "message")).otherwise(F.col("message"))

    def current(length: Column) -> Column:
        return F.to_json(
            F.struct(
                F.when(~((kind == "view") & (value < 5)), F.concat(F.lit("#"), kind)).alias("channel"),
                F.concat(F.lit("user"), "user_id").alias("chatter_id"),
                body.alias("message_text"),
                length.alias("message_length"),
                (F.col("user_id") % 4).alias("source_partition"),
                F.col("event_id").alias("source_offset"),
            )
        )

    wrong_type = (kind == "click") & (value < 20)
    record = (
        F.when(kind == "signup", v1)
        .when(wrong_type, current(F.length(body).cast("string")))
        .otherwise(current(F.length(body)))
    )
    return messages(spark, sf).select("event_id", "message", record.alias("record"))
