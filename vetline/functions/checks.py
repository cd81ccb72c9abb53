"""Rules as Catalyst expressions.

Each rule becomes a boolean *failure* Column and an error-struct Column. Both
are plain built-in expressions (cast, trim, rlike, struct, concat), so they
stay inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from vetline.functions.rules import NOT_NULL, REGEX, WELL_FORMED, Rule

# --- fixed values (output contract) -----------------------------------------
# Name of the per-row error column: "_validation_errors".
# Error entry fields, in order: rule_name (string, not null),
# column (string, not null), value (string, nullable).
ERRORS_COL = "_validation_errors"
ERROR_ENTRY_TYPE = StructType([
    StructField("rule_name", StringType(), False),
    StructField("column", StringType(), False),
    StructField("value", StringType(), True),
])
ERRORS_TYPE = ArrayType(ERROR_ENTRY_TYPE)
# ---------------------------------------------------------------------------


def col_ref(name: str) -> Column:
    """Reference a column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def failure(rule: Rule) -> Column:
    """Boolean Column, true where the row breaks ``rule``; never NULL."""
    c = col_ref(rule.column)
    as_text = c.cast("string")
    if rule.kind == NOT_NULL:
        # trim() strips the space character only (not tabs or NBSP).
        return c.isNull() | (F.trim(as_text) == F.lit(""))
    if rule.kind == REGEX:
        # rlike is a *find*: the pattern may match anywhere unless anchored.
        return c.isNull() | ~as_text.rlike(rule.pattern)
    if rule.kind == WELL_FORMED:
        return c.isNotNull()
    raise ValueError(f"Unsupported rule type '{rule.kind}'")


def error_entry(rule: Rule) -> Column:
    """The struct recorded for a failed rule: name, column, offending value."""
    return F.struct(
        F.lit(rule.name).alias("rule_name"),
        F.lit(rule.column).alias("column"),
        col_ref(rule.column).cast("string").alias("value"),
    )


def empty_errors() -> Column:
    return F.array().cast(ERRORS_TYPE)


def errors_array(rules: Sequence[Rule]) -> Column:
    """Array of error structs in rule order, empty when every rule passes.

    Built as a concat of zero-or-one element arrays rather than an array of
    nullable structs filtered by a lambda: concat is code-generated while
    higher-order functions are interpreted.
    """
    if not rules:
        return empty_errors()
    parts = [
        F.when(failure(r), F.array(error_entry(r))).otherwise(empty_errors())
        for r in rules
    ]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def any_failure(rules: Sequence[Rule]) -> Column:
    """Boolean Column, true where at least one rule fails."""
    if not rules:
        return F.lit(False)
    out = failure(rules[0])
    for r in rules[1:]:
        out = out | failure(r)
    return out


def is_valid(rules: Sequence[Rule]) -> Column:
    """Boolean Column, true where every rule passes (no array built)."""
    return ~any_failure(rules)


def error_count(rules: Sequence[Rule]) -> Column:
    """Integer Column: how many rules the row breaks."""
    if not rules:
        return F.lit(0)
    total = None
    for r in rules:
        term = F.when(failure(r), F.lit(1)).otherwise(F.lit(0))
        total = term if total is None else total + term
    return total
