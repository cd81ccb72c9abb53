"""Physical-plan properties the library relies on at scale."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vetline.operators.validate import rule_counts, validate, validate_split
from vetline.session import scratch_path
from vetline.sinks.files import write_hourly
from vetline.sources.files import read_partitioned


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scan(plan):
    return next(line for line in plan.splitlines() if "FileScan" in line)


def test_valid_side_pushes_not_null_and_prunes_columns(spark):
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    valid, _ = validate_split(cust, [{"rule_type": "not_null", "column": "c_name"},
                                     {"rule_type": "regex", "column": "c_mktsegment", "pattern": "^[A-Z]+$"}])
    scan = _scan(_plan(valid.select("c_custkey")))
    assert "IsNotNull(c_name)" in scan and "IsNotNull(c_mktsegment)" in scan
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>", scan)


def test_validation_stays_in_codegen_without_python(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    plan = _plan(validate(li, [{"rule_type": "regex", "column": "l_returnflag", "pattern": "^[AR]$"}]))
    assert "*(" in plan  # whole-stage code generation
    assert not any(k in plan for k in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "Exchange"))


def test_rule_report_is_one_partial_aggregate(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    counts, per_rule = rule_counts(li, [{"rule_type": "not_null", "column": "l_shipdate"},
                                        {"rule_type": "regex", "column": "l_linestatus", "pattern": "O"}])
    for df in (counts, per_rule):
        plan = _plan(df)
        assert plan.count("Exchange") == 1 and "SinglePartition" in plan
        assert "partial_sum" in plan
        assert "ReadSchema: struct<l_linestatus:string,l_shipdate:timestamp_ntz>" in _scan(plan)


def test_hour_filter_prunes_partitions(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts")
    root = scratch_path(spark, "plan_hourly")
    write_hourly(ev, "ts", root, fmt="parquet")
    back = read_partitioned(spark, root, "parquet", schema=ev.schema,
                            partition_columns=["year", "month", "day", "hour"])
    scan = _scan(_plan(back.filter((F.col("day") == "05") & (F.col("hour") < "12"))))
    filters = re.search(r"PartitionFilters: \[(.*?)\]", scan).group(1)
    assert "day" in filters and "hour" in filters


def test_only_local_mode_may_invent_a_shared_folder():
    from vetline.session import _local_cores
    assert all(_local_cores(m) for m in ("local", "local[3]", "local[4, 2]", "local[*]"))
    assert not any(_local_cores(m) for m in ("local-cluster[3,2,1024]", "spark://host:7077", "yarn"))
