"""Freshness, volume, schema drift and service-level measures."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatlens.functions.record import has_value, is_kind
from chatlens.functions.text import evaluate_once, share
from chatlens.schemas import ENVELOPE, EnvelopeContract

# Published thresholds.
VOLUME_TOLERANCE = 0.25
ERROR_RATE_LIMIT = 0.01


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with fractions, never negative."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.greatest(micros / F.lit(1e6), F.lit(0.0))


def event_ingest_lag(parsed: DataFrame) -> DataFrame:
    lag = seconds_between(F.col("event_ts"), F.col("bronze_ingestion_ts"))
    return parsed.withColumn("event_time_to_ingest_lag_seconds", lag)


def bronze_silver_latency(parsed: DataFrame) -> DataFrame:
    latency = seconds_between(F.col("bronze_ingestion_ts"), F.col("silver_processed_ts"))
    return parsed.withColumn("bronze_to_silver_latency_seconds", latency)


def last_batch_age(metrics: DataFrame, as_of: Column) -> DataFrame:
    newest = metrics.groupBy("job_name").agg(F.max("batch_processed_ts").alias("last_success_ts"))
    age = seconds_between(F.col("last_success_ts"), as_of)
    return newest.withColumn("last_successful_batch_age_seconds", age)


def freshness_snapshot(parsed: DataFrame, metrics: DataFrame, as_of: Column) -> DataFrame:
    """Lag, latency and batch age per run. Both sides are aggregated before they meet."""
    measured = bronze_silver_latency(event_ingest_lag(parsed))
    lags = measured.groupBy(F.col("_run_id").alias("run_id")).agg(
        F.avg("event_time_to_ingest_lag_seconds").alias("avg_event_to_ingest_lag_seconds"),
        F.max("event_time_to_ingest_lag_seconds").alias("max_event_to_ingest_lag_seconds"),
        F.avg("bronze_to_silver_latency_seconds").alias("avg_bronze_to_silver_lag_seconds"),
        F.max("bronze_to_silver_latency_seconds").alias("max_bronze_to_silver_lag_seconds"),
    )
    newest = metrics.groupBy("run_id").agg(F.max("batch_processed_ts").alias("_newest"))
    age = seconds_between(F.col("_newest"), as_of)
    return (
        lags.join(newest, "run_id", "left")
        .withColumn("last_successful_batch_age_seconds", age)
        .drop("_newest")
    )


def is_spike_or_drop(expected: Column, actual: Column, tolerance: float = VOLUME_TOLERANCE) -> Column:
    deviation = F.try_divide(F.abs(actual - expected).cast("double"), expected.cast("double"))
    return F.when(expected > 0, deviation > tolerance).otherwise(F.lit(False))


def volume_snapshot(
    metrics: DataFrame, tolerance: float = VOLUME_TOLERANCE, expected: Column | None = None
) -> DataFrame:
    """Expected against actual rows per batch.

    Without a given expectation, a batch is held against the mean batch of its job and target over
    all runs: one small map, of as many entries as jobs have targets, that every row looks up.
    """
    if expected is None:
        pair = F.struct("job_name", "target_table")
        usual = metrics.groupBy("job_name", "target_table").agg(F.round(F.avg("row_count")).cast("bigint").alias("usual"))
        means = usual.agg(F.map_from_entries(F.collect_list(F.struct(pair, F.col("usual"))))).scalar()
        expected = F.try_element_at(means, pair)
    with_expected = metrics.withColumn("expected_records", expected.cast("bigint"))
    actual, wanted = F.col("row_count"), F.col("expected_records")
    return with_expected.select(
        "run_id",
        "job_name",
        "target_table",
        "batch_id",
        F.greatest(actual, F.lit(0)).alias("records_in_micro_batch"),
        "expected_records",
        actual.alias("actual_records"),
        (actual - wanted).alias("delta_records"),
        is_spike_or_drop(wanted, actual, tolerance).alias("is_spike_or_drop"),
    )


def schema_drift(
    df: DataFrame,
    payload: str = "raw_payload",
    contract: EnvelopeContract = EnvelopeContract(),
    fail_fast: bool = True,
) -> DataFrame:
    """Add missing, unexpected and retyped top-level fields (sorted arrays) and the action.

    A payload that is no JSON object lacks every required field.
    """
    read = evaluate_once(
        df,
        _record=F.try_parse_json(F.col(payload)),
        _keys=F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>")),
    )
    record = F.col("_record")

    def names_where(conditions: dict[str, Column]) -> Column:
        found = [F.when(condition, F.lit(name)) for name, condition in sorted(conditions.items())]
        return F.array_compact(F.array(*found))

    missing = {name: ~has_value(record, name) for name in contract.required}
    retyped = {
        name: has_value(record, name) & ~is_kind(record, name, expected) for name, expected in contract.kinds
    }
    unexpected = F.array_except("_keys", F.array(*[F.lit(n) for n in contract.expected]))
    drift = evaluate_once(
        read,
        missing_required_fields=names_where(missing),
        unexpected_fields=F.sort_array(unexpected),
        type_drift_fields=names_where(retyped),
    )
    broken = (F.size("missing_required_fields") > 0) | (F.size("type_drift_fields") > 0)
    action = (
        F.when(broken, "FAIL_FAST" if fail_fast else "DLQ")
        .when(F.size("unexpected_fields") > 0, "WARN_AND_CONTINUE")
        .otherwise("ACCEPT")
    )
    return drift.withColumn("action", action).drop("_record", "_keys")


def schema_drift_summary(drift: DataFrame) -> DataFrame:
    """Records per drift kind, field and action."""

    def tagged(kind: str, fields: str) -> Column:
        return F.transform(fields, lambda name: F.struct(F.lit(kind).alias("drift_kind"), name.alias("field")))

    all_drift = F.concat(
        tagged("missing", "missing_required_fields"),
        tagged("unexpected", "unexpected_fields"),
        tagged("type", "type_drift_fields"),
    )
    flat = drift.select("action", F.inline(all_drift))
    return flat.groupBy("drift_kind", "field", "action").agg(F.count(F.lit(1)).alias("records"))


def slo_breached(error_rate: Column, limit: float = ERROR_RATE_LIMIT) -> Column:
    return error_rate > limit


def success_ratio(successes: Column, attempts: Column) -> Column:
    """Share of successes, 4 digits; 0 without attempts."""
    return F.when(attempts > 0, F.round(share(successes, attempts), 4)).otherwise(F.lit(0.0))


def success_percent(successes: Column, attempts: Column) -> Column:
    """Percentage of successes, 2 digits; 0 without attempts."""
    return F.when(attempts > 0, F.round(share(successes, attempts) * 100.0, 2)).otherwise(F.lit(0.0))


def micro_batch_success_ratio(metrics: DataFrame, success: str = "row_count > 0") -> DataFrame:
    """Per run and job. By default a batch that wrote rows counts as successful."""
    counted = metrics.groupBy("run_id", "job_name").agg(
        F.count(F.lit(1)).alias("attempted_batches"),
        F.count_if(F.expr(success)).alias("successful_batches"),
    )
    ratio = success_ratio(F.col("successful_batches"), F.col("attempted_batches"))
    return counted.withColumn("success_ratio", ratio)


def healthy_run_pct(runs: DataFrame, limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Share of runs within the error-rate limit; ``runs`` has one ``dlq_rate`` per run."""
    counted = runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(~F.coalesce(slo_breached(F.col("dlq_rate"), limit), F.lit(False))).alias("healthy_runs"),
    )
    return counted.withColumn("healthy_run_pct", success_percent(F.col("healthy_runs"), F.col("total_runs")))


def uptime_proxy_pct(metrics: DataFrame, grain: str = "hour", expected: Column | None = None) -> DataFrame:
    """Intervals with a batch against intervals expected, per run. An estimate, not uptime.

    Without a given number, every interval between a run's first and last batch is expected.
    """
    seconds = {"minute": 60, "hour": 3600, "day": 86400}[grain]
    slot = F.floor(F.unix_timestamp("batch_processed_ts") / seconds)
    seen = metrics.groupBy("run_id", slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.max("_slot") - F.min("_slot") + 1 if expected is None else F.max(expected)
    counted = seen.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("successful_intervals"),
        wanted.cast("bigint").alias("expected_intervals"),
    )
    percent = success_percent(F.col("successful_intervals"), F.col("expected_intervals"))
    return counted.withColumn("uptime_proxy_pct", percent)


def healthy_interval_pct(health: DataFrame, limit: float = ERROR_RATE_LIMIT) -> DataFrame:
    """Health rows within the error-rate limit, per run and stage. Rows without a rate are not observed."""
    observed = health.filter(F.col("dlq_rate").isNotNull())
    counted = observed.groupBy("run_id", "pipeline_stage").agg(
        F.count(F.lit(1)).alias("observed_intervals"),
        F.count_if(~slo_breached(F.col("dlq_rate"), limit)).alias("healthy_intervals"),
    )
    percent = success_percent(F.col("healthy_intervals"), F.col("observed_intervals"))
    return counted.withColumn("healthy_interval_pct", percent)


# A type string in pieces: a field's name, the start or end of a container, a scalar.
SHAPE_TOKENS = r"`(?:[^`]|``)*`: |[^`<>:, ()][^`<>:,]*: |OBJECT<|ARRAY<|>|[A-Z_]+(?:\(\d+,\d+\))?"
NODE = "struct<parent: string, path: string, kind: string>"


def json_nodes(shape: Column) -> Column:
    """Every field of a JSON object at any depth: parent, path and kind. Array elements are named ``[]``.

    The variant's type string, ``shape``, is walked once, with the open containers as a stack. Names that need
    quotes keep them, so a dot in a name is no level. Empty for anything but an object.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("stack"),
        F.lit("").alias("name"),
        F.array().cast(f"array<{NODE}>").alias("nodes"),
    )

    def step(state: Column, token: Column) -> Column:
        named, ends = F.endswith(token, F.lit(": ")), token == ">"
        opens = token.isin("OBJECT<", "ARRAY<")
        inside = F.concat(state["stack"], F.array(state["name"]))
        above = F.array_join(F.filter(state["stack"], lambda x: x != ""), ".")
        kind = F.when(token == "OBJECT<", "OBJECT").when(token == "ARRAY<", "ARRAY").otherwise(token)
        node = F.struct(above.alias("parent"), F.array_join(F.filter(inside, lambda x: x != ""), ".").alias("path"), kind.alias("kind"))
        return F.struct(
            F.when(opens, inside).when(ends, F.slice(state["stack"], F.lit(1), F.greatest(F.size(state["stack"]) - 1, F.lit(0)))).otherwise(state["stack"]).alias("stack"),
            F.when(named, F.regexp_replace(token, ": $", "")).when(token == "ARRAY<", "[]").otherwise(state["name"]).alias("name"),
            F.when(named | ends, state["nodes"]).otherwise(F.concat(state["nodes"], F.array(node))).alias("nodes"),
        )

    tokens = F.when(F.startswith(shape, F.lit("OBJECT<")), F.regexp_extract_all(shape, F.lit(SHAPE_TOKENS), F.lit(0)))
    walked = F.aggregate(F.coalesce(tokens, F.array().cast("array<string>")), start, step, lambda state: state["nodes"])
    return F.filter(walked, lambda node: node["path"] != "")


# Names that a type string leaves without quotes.
PLAIN_NAME = r"^[A-Za-z_][A-Za-z0-9_]*\z"


def _fields(value: Column, parent: Column, opened: Column) -> Column:
    """Parent, path and kind of the fields of a JSON object, with the value of those that are objects to open; null for anything else."""

    def node(entry: Column) -> Column:
        name, inside = entry["key"], entry["value"]
        quoted = F.when(name.rlike(PLAIN_NAME), name).otherwise(F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`")))
        path = F.when(parent == "", quoted).otherwise(F.concat(parent, F.lit("."), quoted))
        kind = F.substring_index(F.schema_of_variant(inside), "<", 1)
        return F.struct(parent.alias("parent"), path.alias("path"), kind.alias("kind"), F.when(F.array_contains(opened, path), inside).alias("value"))

    return F.transform(F.map_entries(F.try_variant_get(value, "$", "map<string, variant>")), node)


def _with_known_levels(df: DataFrame, payload: str, contract: StructType, required: Sequence[str]) -> tuple[DataFrame, Column, Column]:
    """The rows, whether a record is as the contract says, and if not, the fields of the whole record and of objects with a
    known path or a required field inside.

    One parse; a level is read from the objects of the one above, down to those below the deepest known path.
    """
    known = expected_nodes(contract)
    above = {path[:k] for path in required for k, c in enumerate(path) if c == "."}
    wanted = sorted({*known, *above})
    opened = F.array(*[F.lit(p) for p in wanted])
    none = F.array().cast("array<struct<parent: string, path: string, kind: string, value: variant>>")
    rows = evaluate_once(df, _record=F.try_parse_json(F.col(payload)))
    agrees = F.lit(False)
    if set(required) <= set(known):
        agrees = F.coalesce(F.schema_of_variant("_record").rlike(rf"^{agreeing_shape(contract, required)}\z"), F.lit(False))
    rows = evaluate_once(rows, _agrees=agrees)
    top = F.when(~F.col("_agrees"), _fields(F.col("_record"), F.lit(""), opened))
    rows = evaluate_once(rows, _nodes=F.coalesce(top, none)).drop("_record")
    rows = rows.withColumn("_level", F.col("_nodes"))
    for _ in range(max(p.count(".") for p in wanted) + 1 if wanted else 0):
        objects = F.filter("_level", lambda n: (n["kind"] == "OBJECT") & n["value"].isNotNull())
        below = F.flatten(F.transform(objects, lambda n: _fields(n["value"], n["path"], opened)))
        rows = evaluate_once(rows, _below=below)
        rows = rows.withColumns({"_nodes": F.concat("_nodes", "_below"), "_level": F.col("_below")}).drop("_below")
    return rows.drop("_level"), F.col("_agrees"), F.col("_nodes")


def agreeing_shape(contract: StructType, required: Sequence[str], prefix: str = "") -> str:
    """Pattern of the type strings of records that have every required field and no other drift; a type string names fields in order."""
    parts = []
    for field in sorted(contract.fields, key=lambda f: f.name):
        path = f"{prefix}{field.name}"
        if isinstance(field.dataType, StructType):
            kind = agreeing_shape(field.dataType, required, f"{path}.")
        else:
            kind = KINDS_OF[field.dataType.typeName()]
        needed = any(p == path or p.startswith(f"{path}.") for p in required)
        one = rf"(?:(?<=<)|, ){re.escape(field.name)}: "
        parts.append(f"{one}{kind}" if needed else f"(?:{one}(?:{kind}|VOID))?")
    return f"OBJECT<{''.join(parts)}>"


def expected_nodes(contract: StructType, prefix: str = "") -> dict[str, str]:
    """Path -> kind of every field of a contract schema."""
    found: dict[str, str] = {}
    for field in contract.fields:
        path = f"{prefix}{field.name}"
        if isinstance(field.dataType, StructType):
            found |= {path: "OBJECT", **expected_nodes(field.dataType, f"{path}.")}
        else:
            found[path] = KINDS_OF[field.dataType.typeName()]
    return found


# Types of a contract schema -> kinds of JSON values.
KINDS_OF = {"string": "STRING", "integer": "BIGINT", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def schema_drift_paths(
    df: DataFrame,
    payload: str = "raw_payload",
    contract: StructType = ENVELOPE,
    required: Sequence[str] = EnvelopeContract().required,
    fail_fast: bool = True,
) -> DataFrame:
    """Add missing, unexpected and retyped fields at any depth, as sorted paths, and the action.

    The payload is parsed once. Of an unexpected object only its own path is reported. A field that
    holds null is neither retyped nor there.
    """
    known = expected_nodes(contract)
    paths = F.array(*[F.lit(p) for p in known])
    kinds = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    read, agrees, nodes = _with_known_levels(df, payload, contract, required)

    def sorted_paths(condition: Callable[[Column], Column]) -> Column:
        return F.sort_array(F.array_distinct(F.transform(F.filter(nodes, condition), lambda n: n["path"])))

    there = F.transform(F.filter(nodes, lambda n: n["kind"] != "VOID"), lambda n: n["path"])
    if any("[]" in path for path in required):  # in arrays, which only the walk of the whole type string reads
        read = evaluate_once(read, _walked=json_nodes(F.schema_of_variant(F.try_parse_json(F.col(payload)))))
        there = F.concat(there, F.transform(F.filter("_walked", lambda n: n["kind"] != "VOID"), lambda n: n["path"]))
    needed = F.sort_array(F.array(*[F.lit(p) for p in required]))
    drift = evaluate_once(
        read,
        missing_required_fields=F.array_except(needed, F.when(agrees, needed).otherwise(there)),
        unexpected_fields=sorted_paths(lambda n: ((n["parent"] == "") | F.array_contains(paths, n["parent"])) & ~F.array_contains(paths, n["path"])),
        type_drift_fields=sorted_paths(
            lambda n: F.array_contains(paths, n["path"]) & (n["kind"] != "VOID") & (n["kind"] != F.try_element_at(kinds, n["path"]))
        ),
    )
    broken = (F.size("missing_required_fields") > 0) | (F.size("type_drift_fields") > 0)
    action = F.when(broken, "FAIL_FAST" if fail_fast else "DLQ").when(F.size("unexpected_fields") > 0, "WARN_AND_CONTINUE").otherwise("ACCEPT")
    return drift.withColumn("action", action).drop("_nodes", "_agrees", "_walked")


def schema_union(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """path, kind, records: every field of the table's payloads at any depth, with every kind it has.

    One parse; payloads with the same type string are counted before it is walked.
    """
    shaped = evaluate_once(df, _shape=F.schema_of_variant(F.try_parse_json(F.col(payload))))
    shapes = shaped.groupBy("_shape").agg(F.count(F.lit(1)).alias("_records"))
    nodes = shapes.select("_records", F.inline(F.array_distinct(json_nodes(F.col("_shape")))))
    return nodes.groupBy("path", "kind").agg(F.sum("_records").alias("records"))
