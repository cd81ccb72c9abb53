"""Configuration objects: rules, formats by extension, ingest parameters, session settings."""

import os
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vetline.functions.rules import Rule, not_null, read_rule, read_rules, regex
from vetline.plans.ingest import IngestParams
from vetline.session import _local_cores, scale_settings
from vetline.sources.files import detect_format


def rule_file(*lines):
    """Rules written one a line: kind column [pattern] [as name]."""
    out = []
    for line in lines:
        head, _, label = line.partition(" as ")
        kind, column, *rest = head.split(" ")
        out.append({"rule_type": kind, "column": column} | ({"pattern": rest[0]} if rest else {}) | ({"rule_name": label} if label else {}))
    return out


def test_a_rule_file_is_read_in_order_with_names():
    rules = read_rules(rule_file("regex p_size ^[0-9]+$", "not_null l_comment as comment present", "not_null p_size") + [regex("x", "y", "xy")])
    assert [r.name for r in rules] == ["regex_p_size", "comment present", "not_null_p_size", "xy"]
    assert [r.pattern for r in rules] == ["^[0-9]+$", None, None, "y"]
    assert read_rules(()) == []


@pytest.mark.parametrize("spec, words", [
    ({"pattern": "x"}, ["rule_type", "column"]),
    ({"rule_type": "between", "column": "n"}, ["Unknown rule type", "between", "not_null", "regex"]),
    ({"rule_type": "regex", "column": "n", "pattern": ""}, ["pattern"]),
    ({"rule_type": "regex"}, ["column", "pattern"]),
])
def test_every_fault_of_a_spec_is_named(spec, words):
    with pytest.raises(ValueError) as refused:
        read_rule(spec)
    assert all(w in str(refused.value) for w in words)


_word = st.text(string.ascii_letters + "_.é ", min_size=1, max_size=12)


@settings(max_examples=40, deadline=None)
@given(column=_word, pattern=st.none() | _word, label=st.none() | st.text(max_size=5))
def test_spec_and_rule_are_inverse(column, pattern, label):
    rule = not_null(column, label) if pattern is None else regex(column, pattern, label)
    assert read_rule(rule.spec()) == rule == read_rule(rule)
    assert rule.name == (label if label is not None else rule.kind + "_" + column)
    assert Rule(*rule) == rule


@settings(max_examples=60, deadline=None)
@given(folder=st.sampled_from(["", "/lake/raw.json/", "hdfs://nn/a.b/", "./"]), stem=st.sampled_from(["events", "a.b", "2024-01-01"]),
       ending=st.sampled_from(["", ".csv", ".json", ".txt", ".json.gz", ".JsoN", ".jsonl"]))
def test_only_the_last_extension_decides_the_format(folder, stem, ending):
    assert detect_format(folder + stem + ending) == ("json" if ending.lower() == ".json" else "csv")


class TestIngestParams:
    VALUES = {"source_path": "/in/day=1", "target_path": "/out", "catalog_database": "lake", "catalog_table_name": "trips"}

    @settings(max_examples=30, deadline=None)
    @given(order=st.permutations(sorted(VALUES)), joined=st.booleans(), key=st.none() | st.just("day"))
    def test_any_order_and_either_form(self, order, joined, key):
        values = self.VALUES | ({"partition_key": key} if key else {})
        argv = ["--job-language", "python"]
        for name in [*order, *(["partition_key"] if key else [])]:
            argv += [f"--{name}={values[name]}"] if joined else [f"--{name}", values[name]]
        got = IngestParams.from_args([*argv, "--extra"])
        assert vars(got) == {"partition_key": None} | values

    @pytest.mark.parametrize("argv, named", [
        ([], "source_path"),
        (["--source_path", "--target_path", "/out"], "source_path"),
        (["--source_path", "/in", "--target_path"], "target_path"),
        (["--source", "/in", "--target_path=/o", "--catalog_database=d", "--catalog_table_name=t"], "source_path"),
    ])
    def test_absent_empty_or_shortened_names_are_refused(self, argv, named):
        with pytest.raises(ValueError, match=named):
            IngestParams.from_args(argv)


def test_task_size_holds_at_any_input_size():
    for tib in (1, 10, 100, 1000):
        parts = int(scale_settings(tib * 2**40)["spark.sql.shuffle.partitions"])
        assert parts == tib * 2**40 // (256 << 20)
    assert scale_settings(1)["spark.sql.shuffle.partitions"] == "200"


def test_local_cores():
    assert [_local_cores(m) for m in ("local[3]", "local[4, 2]", "local", "yarn")] == [3, 4, 1, None]
    assert _local_cores("local[*]") == (os.cpu_count() or 1)
