"""Row validation, valid/invalid split and load counts.

All operators here are narrow (one projection or filter per row) except the
count and per-rule reports, which are global or tiny-key aggregates with
map-side partial aggregation: each task ships one row per group, so a hot rule
or a third of all rows failing the same check costs nothing extra.
"""

from __future__ import annotations

import logging
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.functions.checks import (
    ERRORS_COL,
    any_failure,
    col_ref,
    empty_errors,
    errors_array,
    failure,
    is_valid,
)
from vetline.functions.rules import REGEX, SUPPORTED_RULE_TYPES, Rule, read_rules

log = logging.getLogger(__name__)

_checked_patterns: set[str] = set()


def check_patterns(spark: SparkSession, rules: Sequence[Rule]) -> None:
    """Compile every regex on the JVM before any task runs.

    A bad pattern otherwise fails inside a task, after the scan started.
    The probe is a one-row constant expression, folded while planning.
    """
    todo = [r.pattern for r in rules if r.kind == REGEX and r.pattern not in _checked_patterns]
    if not todo:
        return
    probe = spark.range(1).select(*[F.lit("").rlike(p).alias(f"p{i}") for i, p in enumerate(todo)])
    try:
        probe.collect()
    except Exception as exc:  # surface which rule is wrong
        raise ValueError(f"Invalid regex pattern among {todo}: {exc}") from exc
    _checked_patterns.update(todo)


def plan_rules(
    columns: Iterable[str],
    rules: Sequence[Rule | Mapping],
    on_missing: str = "skip",
) -> tuple[list[Rule], list[Rule]]:
    """Split ``rules`` into (active, skipped) against the available columns.

    Presence is an exact, case-sensitive test. ``on_missing='fail'`` turns a
    rule on an absent column into an error (a schema check).
    """
    if on_missing not in ("skip", "fail"):
        raise ValueError("on_missing must be 'skip' or 'fail'")
    present = set(columns)
    active, skipped = [], []
    for rule in read_rules(rules):
        if rule.kind not in SUPPORTED_RULE_TYPES:
            log.warning("No check exists for rules of type '%s'; rule left out.", rule.kind)
            skipped.append(rule)
        elif rule.column not in present:
            if on_missing == "fail":
                raise ValueError(
                    f"Rule '{rule.name}' checks column '{rule.column}', which the data lacks"
                )
            log.warning("The data lacks column '%s'; rule '%s' left out.", rule.column, rule.name)
            skipped.append(rule)
        else:
            active.append(rule)
    return active, skipped


def schema_problems(df: DataFrame, expected) -> list[str]:
    """Differences between ``df``'s schema and ``expected`` (a StructType, a
    DDL string or ``{name: type}``): missing columns and type mismatches.
    Extra columns are allowed. Exact, case-sensitive names."""
    from pyspark.sql.types import StructType

    if isinstance(expected, str):
        expected = StructType.fromDDL(expected)
    if isinstance(expected, StructType):
        wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    else:
        wanted = {k: (v if isinstance(v, str) else v.simpleString()) for k, v in dict(expected).items()}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = []
    for name, typ in wanted.items():
        if name not in have:
            problems.append(f"missing column '{name}' ({typ})")
        elif have[name] != typ:
            problems.append(f"column '{name}' is {have[name]}, expected {typ}")
    return problems


def validate(
    df: DataFrame,
    rules: Sequence[Rule | Mapping],
    schema_columns: Iterable[str] | None = None,
    on_missing: str = "skip",
) -> DataFrame:
    """Add ``_validation_errors``: one struct per failed rule, in rule order.

    Row count and all input columns are unchanged (an input column of the same
    name is replaced). With no applicable rule every row gets ``[]``.
    """
    cols = list(schema_columns) if schema_columns is not None else df.columns
    active, _ = plan_rules(cols, rules, on_missing)
    if not active:
        if not rules:
            log.warning("Validating without any rule: every row is valid.")
        return df.withColumn(ERRORS_COL, empty_errors())
    check_patterns(df.sparkSession, active)
    return df.withColumn(ERRORS_COL, errors_array(active))


def split_valid_invalid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) from a validated frame.

    valid: no error, error column dropped. invalid: at least one error, column
    kept. The two are disjoint and together hold every row.
    """
    n = F.size(F.col(ERRORS_COL))
    return validated.filter(n == 0).drop(ERRORS_COL), validated.filter(n > 0)


def validate_split(
    df: DataFrame,
    rules: Sequence[Rule | Mapping],
    schema_columns: Iterable[str] | None = None,
    on_missing: str = "skip",
) -> tuple[DataFrame, DataFrame]:
    """Same result as ``split_valid_invalid(validate(...))``, cheaper.

    The valid side is a plain conjunction of the rules (no error array is
    built, simple parts such as ``IS NOT NULL`` reach the scan); the error
    array is built only for rejected rows.
    """
    cols = list(schema_columns) if schema_columns is not None else df.columns
    active, _ = plan_rules(cols, rules, on_missing)
    if not active:
        return df, df.filter(F.lit(False)).withColumn(ERRORS_COL, empty_errors())
    check_patterns(df.sparkSession, active)
    valid = df.filter(is_valid(active))
    invalid = df.filter(any_failure(active)).withColumn(ERRORS_COL, errors_array(active))
    return valid, invalid


def load_counts(validated: DataFrame, validity: Column | None = None) -> DataFrame:
    """One row: total_count, valid_count, invalid_count, in a single pass.

    ``validity`` may be a precomputed boolean column (e.g. a stored
    ``_is_valid``); by default the error array's size decides.
    """
    ok = validity if validity is not None else (F.size(F.col(ERRORS_COL)) == 0)
    return validated.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("valid_count"),
        F.sum(F.when(ok, 0).otherwise(1)).cast("long").alias("invalid_count"),
    ).select(
        "total_count",
        F.coalesce("valid_count", F.lit(0).cast("long")).alias("valid_count"),
        F.coalesce("invalid_count", F.lit(0).cast("long")).alias("invalid_count"),
    )


def explode_errors(validated: DataFrame, keep: Sequence[str] = (), with_position: bool = False) -> DataFrame:
    """One row per error: ``keep`` columns + rule_name, column, value.

    ``with_position`` adds ``pos``, the entry's index in the row's array.
    """
    keep_cols = [col_ref(c).alias(c) for c in keep]
    if with_position:
        exploded = validated.select(*keep_cols, F.posexplode(ERRORS_COL).alias("pos", "err"))
        return exploded.select(*keep, "pos", "err.rule_name", "err.column", "err.value")
    return validated.select(*keep_cols, F.inline(ERRORS_COL))


def errors_long(df: DataFrame, rules: Sequence[Rule | Mapping], keep: Sequence[str] = (),
                on_missing: str = "skip") -> DataFrame:
    """Same rows as ``explode_errors(validate(df, rules), keep)``, cheaper.

    Each row is expanded into one flagged struct per rule and only failed ones
    are kept. Exploding the error array instead makes Catalyst infer a
    ``size(array) > 0`` filter below the projection, which builds the array
    twice per row; this form evaluates each rule once (measured ~25% faster).
    Rows come out in rule order within each input row.
    """
    active, _ = plan_rules(df.columns, rules, on_missing)
    keep_cols = [col_ref(c).alias(c) for c in keep]
    if not active:
        return df.select(*keep_cols, F.lit("").alias("rule_name"), F.lit("").alias("column"),
                         F.lit(None).cast("string").alias("value")).filter(F.lit(False))
    check_patterns(df.sparkSession, active)
    flagged = F.array(*[
        F.struct(failure(r).alias("_failed"), F.lit(r.name).alias("rule_name"),
                 F.lit(r.column).alias("column"), col_ref(r.column).cast("string").alias("value"))
        for r in active
    ])
    return df.select(*keep_cols, F.inline(flagged)).filter(F.col("_failed")).drop("_failed")


def errors_by_rule(validated: DataFrame) -> DataFrame:
    """Error count per rule and column (partial aggregation before shuffle)."""
    return (
        validated.select(F.inline(ERRORS_COL))
        .groupBy("rule_name", "column")
        .agg(F.count(F.lit(1)).alias("n_errors"))
    )


def rule_counts(df: DataFrame, rules: Sequence[Rule | Mapping], on_missing: str = "skip") -> tuple[DataFrame, DataFrame]:
    """(counts, per_rule) straight from the rules, without building arrays.

    Same numbers as ``load_counts(validate(df, rules))`` and
    ``errors_by_rule(validate(df, rules))``, computed in **one** scan and one
    aggregate: a conditional count per rule plus the valid count, all
    code-generated, one partial row per task. ``per_rule`` lists only rules
    with at least one error, as the exploded report does.
    """
    active, _ = plan_rules(df.columns, rules, on_missing)
    check_patterns(df.sparkSession, active)
    per_rule_cols = [F.sum(F.when(failure(r), 1).otherwise(0)).cast("long").alias(f"r{i}")
                     for i, r in enumerate(active)]
    ok = is_valid(active) if active else F.lit(True)
    agg = df.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("valid_count"),
        *per_rule_cols,
    )
    counts = agg.select(
        "total_count",
        F.coalesce("valid_count", F.lit(0).cast("long")).alias("valid_count"),
        (F.col("total_count") - F.coalesce("valid_count", F.lit(0).cast("long"))).alias("invalid_count"),
    )
    if not active:
        return counts, agg.select(F.lit("").alias("rule_name"), F.lit("").alias("column"),
                                  F.lit(0).cast("long").alias("n_errors")).filter(F.lit(False))
    entries = F.array(*[
        F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.column).alias("column"),
                 F.coalesce(F.col(f"r{i}"), F.lit(0).cast("long")).alias("n_errors"))
        for i, r in enumerate(active)
    ])
    # Two rules may share a name: fold them as the grouped report would.
    per_rule = (agg.select(F.inline(entries)).groupBy("rule_name", "column")
                .agg(F.sum("n_errors").alias("n_errors")).filter(F.col("n_errors") > 0))
    return counts, per_rule
