"""Table-level tests: each reads its table once and returns counts of violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chatlens.schemas import CONTRACT_RULES


def _violations(df: DataFrame, failures: Mapping[str, Column], label: str) -> DataFrame:
    """One aggregation for all rules, turned into one row per rule."""
    names = list(failures)
    counts = df.agg(*[F.count_if(failures[n]).alias(f"_v{i}") for i, n in enumerate(names)])
    rows = [F.struct(F.lit(n).alias(label), F.col(f"_v{i}").alias("violations")) for i, n in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


def contract_check(df: DataFrame, dataset: str, rules: Mapping[str, str] | None = None) -> DataFrame:
    """(dataset, rule, violations). A rule that is unknown (null) for a row counts as violated."""
    predicates = CONTRACT_RULES[dataset] if rules is None else rules
    failures = {name: ~F.coalesce(F.expr(rule), F.lit(False)) for name, rule in predicates.items()}
    return _violations(df, failures, "rule").select(F.lit(dataset).alias("dataset"), "rule", "violations")


def schema_contract_check(df: DataFrame, contract: StructType) -> DataFrame:
    """Declared against actual columns, with null counts of the required ones."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    nulls = df.agg(
        *[
            (F.count_if(F.col(f.name).isNull()) if f.name in actual else F.lit(None).cast("bigint")).alias(f.name)
            for f in contract.fields
        ]
    )
    rows = []
    for f in contract.fields:
        expected, found = f.dataType.simpleString(), actual.get(f.name)
        broken = F.lit(found != expected)
        if not f.nullable:
            broken = broken | (F.col(f.name) > 0)
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(expected).alias("expected_type"),
                F.lit(found).cast("string").alias("actual_type"),
                F.lit(not f.nullable).alias("is_required"),
                F.col(f.name).alias("null_count"),
                broken.alias("is_violation"),
            )
        )
    return nulls.select(F.inline(F.array(*rows)))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _violations(df, {c: F.col(c).isNull() for c in columns}, "column_name")


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Key statistics: keys, keys seen more than once, and surplus rows. Null keys are left out."""
    present = df.dropna(subset=list(columns))
    counted = present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def check_expression(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Rows for which a predicate is false (unknown passes, as in a SQL ``where not``)."""
    failures = {name: ~F.expr(rule) for name, rule in expressions.items()}
    return _violations(df, failures, "expression")


def check_accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    return _violations(df, {column: ~F.col(column).isin(*accepted)}, "column_name")


def parsed_contract_check(parsed: DataFrame, dlq: DataFrame, rules: Mapping[str, str] = CONTRACT_RULES["silver_chat_parsed"]) -> DataFrame:
    """All rules of the parsed contract, (rule, violations): row rules, one row per event and run, failures kept out.

    Each table is read once and reduced per event and run first. A contract failure must be in the
    dead letters only, so an event of a run that is in both counts.
    """
    key = ["_run_id", "event_id"]
    broken = {name: ~F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    rows = [F.count_if(failure).alias(f"_v{i}") for i, failure in enumerate(broken.values())]
    events = parsed.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *rows)
    place = F.concat_ws(":", "source_topic", "source_partition", "source_offset")
    failed = dlq.where("error_category = 'CONTRACT_ERROR'").select("_run_id", place.alias("event_id")).distinct()
    both = events.join(failed.withColumn("_failed", F.lit(True)), key, "left")
    counts = {name: F.sum(f"_v{i}") for i, name in enumerate(broken)}
    counts["event_id_unique_within_contract_output"] = F.sum(F.col("_n") - 1)
    counts["contract_failures_routed_to_dlq"] = F.count_if("_failed")
    return _rows_of(both.agg(*[F.coalesce(c, F.lit(0)).alias(f"_c{i}") for i, c in enumerate(counts.values())]), list(counts), "rule")


def _rows_of(counts: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    rows = [F.struct(F.lit(n).alias(label), F.col(f"_c{i}").alias("violations")) for i, n in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


def model_tests(df: DataFrame, model: str, not_null: Sequence[str], unique: Sequence[str] = ()) -> DataFrame:
    """Declared tests of a model, (model, test, column_name, violations), in one pass over it.

    With a unique column the pass is reduced by its values first; a value's surplus rows are violations.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(not_null)]
    tests = [("not_null", c) for c in not_null]
    if unique:
        (column,) = unique
        per_value = df.groupBy(column).agg(*nulls, F.count(F.lit(1)).alias("_rows"))
        surplus = F.sum(F.when(F.col(column).isNotNull(), F.col("_rows") - 1).otherwise(0))
        sums = [F.sum(f"_n{i}") for i in range(len(not_null))] + [surplus]
        tests.append(("unique", column))
        counted = per_value.agg(*[F.coalesce(x, F.lit(0)).alias(f"_c{i}") for i, x in enumerate(sums)])
    else:
        counted = df.agg(*[x.alias(f"_c{i}") for i, x in enumerate(nulls)])
    rows = [
        F.struct(F.lit(model).alias("model"), F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("violations"))
        for i, (t, c) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*rows)))
