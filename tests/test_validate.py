"""Row validation against an interpreter of the rules in plain Python."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vetline.functions.checks import ERRORS_COL
from vetline.functions.rules import Rule, not_null, regex
from vetline.operators.validate import (
    errors_by_rule,
    errors_long,
    explode_errors,
    load_counts,
    split_valid_invalid,
    validate,
    validate_split,
)

SHIPMENTS = "id int, code string, qty int, note string, `due.on` date, open boolean"


def as_text(value):
    """How Spark casts a value of the test frame to a string."""
    if isinstance(value, bool):
        return str(value).lower()
    return None if value is None else str(value)


def broken(row: dict, rules) -> list[tuple[str, str, str | None]]:
    out = []
    for r in rules:
        if r.column in row and r.kind in ("not_null", "regex"):
            text = as_text(row[r.column])
            if text is None or (text.strip(" ") == "" if r.kind == "not_null" else not re.search(r.pattern, text)):
                out.append((r.name, r.column, text))
    return out


_notes = st.none() | st.text(" \t ab7é漢-", max_size=5)
_rows = st.lists(st.tuples(_notes, st.none() | st.integers(-20, 300), _notes, st.none() | st.dates(dt.date(1999, 1, 1), dt.date(2030, 1, 1)),
                           st.none() | st.booleans()), max_size=12)
_rules = st.lists(st.one_of(
    st.sampled_from(["code", "qty", "note", "due.on", "open", "Code", "lost"]).map(not_null),
    st.builds(regex, st.sampled_from(["code", "qty", "due.on", "open", "lost"]), st.sampled_from([r"-?1", "a|7", r"^.?$", "^2\\d{3}-0", "t", "é$"]))),
    max_size=5)


@settings(max_examples=12, deadline=None)
@given(rows=_rows, rules=_rules)
def test_every_view_of_the_errors_agrees_with_the_interpreter(spark, rows, rules):
    data = [(k, *row) for k, row in enumerate(rows)]
    df = spark.createDataFrame(data, SHIPMENTS)
    names = df.columns
    want = {d[0]: broken(dict(zip(names, d)), rules) for d in data}
    checked = validate(df, rules)
    got = {r["id"]: [tuple(e) for e in r[ERRORS_COL]] for r in checked.collect()}
    assert got == want and checked.columns == [*names, ERRORS_COL]
    for good, bad in (split_valid_invalid(checked), validate_split(df, rules)):
        assert {r["id"] for r in good.collect()} == {k for k, e in want.items() if not e} and good.columns == names
        assert {r["id"]: len(r[ERRORS_COL]) for r in bad.collect()} == {k: len(e) for k, e in want.items() if e}
    assert tuple(load_counts(checked).first()) == (len(want), sum(not e for e in want.values()), sum(bool(e) for e in want.values()))
    flat = sorted(((k, *e) for k, errors in want.items() for e in errors), key=repr)
    for long in (explode_errors(checked, ["id"]), errors_long(df, rules, ["id"])):
        assert sorted(map(tuple, long.collect()), key=repr) == flat
    by_rule = {}
    for _, name, column, _ in flat:
        by_rule[name, column] = by_rule.get((name, column), 0) + 1
    assert {(r["rule_name"], r["column"]): r["n_errors"] for r in errors_by_rule(checked).collect()} == by_rule


@pytest.fixture
def parcels(spark):
    return spark.createDataFrame([(1, "A-1", 3), (2, " ", None), (3, None, 40)], "id int, code string, qty int")


class TestPlanning:
    def test_columns_that_are_absent(self, parcels):
        rules = [not_null("weight"), not_null("CODE"), not_null("code")]
        assert [len(r[ERRORS_COL]) for r in validate(parcels, rules).orderBy("id").collect()] == [0, 1, 1]
        with pytest.raises(ValueError, match="weight"):
            validate(parcels, rules, on_missing="fail")

    def test_a_kind_without_a_check_is_left_out(self, parcels):
        assert all(r[ERRORS_COL] == [] for r in validate(parcels, [Rule("checksum", "code")]).collect())

    def test_a_pattern_that_does_not_compile_fails_before_any_task(self, parcels):
        with pytest.raises(ValueError, match="Invalid regex"):
            validate(parcels, [regex("code", "*[")])

    def test_an_error_column_in_the_input_is_replaced(self, parcels):
        stale = parcels.withColumn(ERRORS_COL, F.lit("old"))
        assert validate(stale, [not_null("id")]).columns == stale.columns
        assert {len(r[ERRORS_COL]) for r in validate(stale, [not_null("id")]).collect()} == {0}

    def test_positions_follow_the_rules(self, parcels):
        rules = [regex("qty", "^4"), not_null("code"), regex("code", "^A")]
        got = explode_errors(validate(parcels, rules), ["id"], with_position=True).select("id", "pos", "rule_name").collect()
        assert sorted(map(tuple, got)) == [(1, 0, "regex_qty"), (2, 0, "regex_qty"), (2, 1, "not_null_code"), (2, 2, "regex_code"),
                                           (3, 0, "not_null_code"), (3, 1, "regex_code")]

    def test_no_shuffle_and_no_python(self, parcels):
        plan = validate(parcels, [not_null("code"), regex("qty", "1")])._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Exchange", "Python", "Arrow"))

    def test_type_of_the_error_column(self, parcels):
        field = validate(parcels, []).schema[ERRORS_COL].dataType
        assert field.simpleString() == "array<struct<rule_name:string,column:string,value:string>>"
        assert [f.nullable for f in field.elementType.fields] == [False, False, True]
