"""Dataset-level data-quality rules.

The job checks one rule, ``ColumnCount > 0``, on the frame it is about to
write. The result is a small DataFrame (one row per rule) that can be
published to a results table; it does not gate the write unless the caller
asks for it. The row count is observed in the same pass, so evaluating the
rule scans the data once and never collects it.
"""

from __future__ import annotations

import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
# Rule text of the job's default ruleset: "ColumnCount > 0".
# Outcomes: "Passed", "Failed".
DEFAULT_RULESET = ("ColumnCount > 0",)
PASSED, FAILED = "Passed", "Failed"
# ---------------------------------------------------------------------------------

_OPS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le,
        "=": operator.eq, "!=": operator.ne}
_METRICS = ("ColumnCount", "RowCount")


def _parse(rule: str) -> tuple[str, str, float]:
    parts = rule.split()
    if len(parts) != 3 or parts[0] not in _METRICS or parts[1] not in _OPS:
        raise ValueError(f"Unsupported dataset rule {rule!r}; expected '<ColumnCount|RowCount> <op> <number>'")
    return parts[0], parts[1], float(parts[2])


def evaluate_dataset_rules(df: DataFrame, rules=DEFAULT_RULESET) -> DataFrame:
    """One row per rule: rule, outcome, metric_name, metric_value, row_count.

    ColumnCount comes from the schema; RowCount (and the ``row_count``
    observation reported for every rule) from one global count with partial
    aggregation per task.
    """
    parsed = [(r, *_parse(r)) for r in rules]
    n_cols = len(df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    rows = []
    for text, metric, op, thr in parsed:
        if metric == "ColumnCount":
            value = F.lit(float(n_cols))
            ok = F.lit(_OPS[op](n_cols, thr))
        else:
            value = F.col("row_count").cast("double")
            ok = {">": value > thr, ">=": value >= thr, "<": value < thr, "<=": value <= thr,
                  "=": value == thr, "!=": value != thr}[op]
        rows.append(F.struct(
            F.lit(text).alias("rule"),
            F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("outcome"),
            F.lit(metric).alias("metric_name"),
            value.alias("metric_value"),
            F.col("row_count").alias("row_count"),
        ))
    # All rules read the one aggregate row: a single scan however many rules.
    return counted.select(F.inline(F.array(*rows)))


def needs_rows(rules=DEFAULT_RULESET) -> bool:
    """Whether any rule needs the data (not just the schema)."""
    return any(_parse(r)[0] != "ColumnCount" for r in rules)


def results_from_metrics(spark, rules, n_cols: int, row_count: int | None) -> DataFrame:
    """The same result rows as ``evaluate_dataset_rules`` from metrics already
    known (column count from the schema, row count observed during a write),
    without another pass over the data."""
    out = []
    for text in rules:
        metric, op, thr = _parse(text)
        value = float(n_cols) if metric == "ColumnCount" else (None if row_count is None else float(row_count))
        ok = value is not None and _OPS[op](value, thr)
        out.append((text, PASSED if ok else FAILED, metric, value, row_count))
    return spark.createDataFrame(
        out, "rule string, outcome string, metric_name string, metric_value double, row_count long")


def column_count_check(df: DataFrame) -> DataFrame:
    """The job's default ruleset (``ColumnCount > 0``)."""
    return evaluate_dataset_rules(df, DEFAULT_RULESET)
