"""The message log: connector options and raw projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlens.schemas import LOG_RECORD

# The connector's login module and option names.
PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"
BOOTSTRAP_SERVERS = "kafka.bootstrap.servers"
SUBSCRIBE = "subscribe"
STARTING_OFFSETS = "startingOffsets"
MAX_OFFSETS_PER_TRIGGER = "maxOffsetsPerTrigger"
SECURITY_PROTOCOL = "kafka.security.protocol"
SASL_MECHANISM = "kafka.sasl.mechanism"
SASL_JAAS_CONFIG = "kafka.sasl.jaas.config"
ENDPOINT_IDENTIFICATION = "kafka.ssl.endpoint.identification.algorithm"


def jaas_config(user: str, password: str, login: str = PLAIN_LOGIN) -> str:
    """Login line of a client; quotes and backslashes in the values are escaped."""
    if not (user and password):
        raise ValueError("a SASL protocol needs user and password")
    quoted = [value.replace("\\", "\\\\").replace('"', '\\"') for value in (user, password)]
    return f'{login} required username="{quoted[0]}" password="{quoted[1]}";'


def kafka_source_options(
    servers: str,
    topic: str,
    security_protocol: str = "SASL_SSL",
    sasl_mechanism: str = "PLAIN",
    user: str = "",
    password: str = "",
    max_offsets_per_trigger: int | None = None,
    login: str = PLAIN_LOGIN,
) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")`` (and batch ``spark.read``)."""
    options = {BOOTSTRAP_SERVERS: servers, SUBSCRIBE: topic, STARTING_OFFSETS: "earliest"}
    if max_offsets_per_trigger is not None:
        options[MAX_OFFSETS_PER_TRIGGER] = str(max_offsets_per_trigger)
    if security_protocol.upper().startswith("SASL"):
        options[SECURITY_PROTOCOL] = security_protocol
        options[SASL_MECHANISM] = sasl_mechanism
        options[SASL_JAAS_CONFIG] = jaas_config(user, password, login)
        options[ENDPOINT_IDENTIFICATION] = "https"
    return options


def kafka_log_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def file_log_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of log-shaped files, with the columns of a log connector."""
    reader = spark.readStream.format(fmt).schema(LOG_RECORD)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def bronze_projection(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Log records to raw rows: rename, cast, stamp. Payload stays as it came."""
    return log.select(
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("int").alias("source_partition"),
        F.col("offset").cast("bigint").alias("source_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("timestampType").cast("int").alias("kafka_timestamp_type"),
        F.col("key").cast("string").alias("raw_key"),
        F.col("value").cast("string").alias("raw_payload"),
        (F.current_timestamp() if as_of is None else as_of).alias("bronze_ingestion_ts"),
    )


def v1_raw_projection(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    """First-generation raw rows, with an empty parse status."""
    return log.select(
        F.col("value").cast("string").alias("json_payload"),
        F.col("timestamp").alias("kafka_timestamp"),
        "topic",
        "partition",
        "offset",
        (F.current_timestamp() if as_of is None else as_of).alias("ingest_ts"),
        F.lit(None).cast("string").alias("parse_status"),
        F.lit(None).cast("string").alias("parse_error"),
    )
