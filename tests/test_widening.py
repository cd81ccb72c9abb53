"""Types that may be stored in others, and rows that are refused before anything is written."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vetline.session import scratch_path, unique_name
from vetline.sinks.catalog import write_table
from vetline.sinks.tables import replace_target, upsert_target
from vetline.sinks.widening import fits, widened

DB = "vetline_w"
NARROW = ["tinyint", "smallint", "int", "bigint"]


def kind(ddl):
    return StructType.fromDDL(f"c {ddl}")["c"].dataType


@pytest.mark.parametrize("k", range(4))
def test_whole_numbers(spark, k):
    for j in range(4):
        assert fits(kind(NARROW[k]), kind(NARROW[j])) == (k <= j)
    assert fits(kind(NARROW[k]), kind("double")) == (k < 3)
    assert fits(kind(NARROW[k]), kind("float")) == (k < 2)
    assert not fits(kind("double"), kind(NARROW[k])) and not fits(kind(NARROW[k]), kind("string"))


@pytest.mark.parametrize("have, want, good", [
    ("int", "decimal(10,0)", True), ("int", "decimal(11,2)", False), ("bigint", "decimal(21,2)", True),
    ("decimal(5,2)", "decimal(7,3)", True), ("decimal(5,2)", "decimal(7,5)", False), ("decimal(5,2)", "decimal(6,1)", False),
    ("decimal(5,0)", "bigint", False), ("float", "double", True), ("double", "float", False),
    ("date", "timestamp_ntz", True), ("timestamp", "timestamp_ntz", False), ("string", "int", False), ("void", "date", True),
    ("array<int>", "array<bigint>", True), ("array<double>", "array<int>", False), ("map<int,float>", "map<bigint,double>", True),
    ("struct<a:int,b:float>", "struct<a:bigint,b:double>", True), ("struct<a:int>", "struct<b:int>", False)])
def test_other_types(spark, have, want, good):
    assert fits(kind(have), kind(want)) == good


@pytest.mark.parametrize("ddl, wider, values", [("int", "bigint", [2**31 - 1, -2**31, None]), ("float", "double", [0.1, -0.0, None]),
                                                ("decimal(4,1)", "decimal(9,4)", ["123.4", "-0.1", None]),
                                                ("array<int>", "array<bigint>", ["array(1,null)", "array()"])])
def test_widened_values_are_the_same(spark, ddl, wider, values):
    rows = spark.sql(" UNION ALL ".join(f"SELECT CAST({v if v is not None else 'NULL'} AS {ddl}) AS c" for v in values))
    back = widened(rows, StructType.fromDDL(f"c {wider}, other int"), "t")
    assert back.schema["c"].dataType == kind(wider)
    assert back.exceptAll(rows.select(F.col("c").cast(wider))).count() == 0 and back.count() == len(values)


def test_every_fault_is_named_and_nothing_is_written(spark):
    t = unique_name("t")
    name = write_table(spark.createDataFrame([(1, 2, "a")], "k int, n int, v string"), DB, t, path=scratch_path(spark, "w"))
    bad = spark.createDataFrame([(2.9, 2**40, 5, True)], "k double, n bigint, v int, extra boolean")
    for by_name in (True, False):
        with pytest.raises(ValueError, match="'k' .double into int.*'n' .bigint into int.*'v'"):
            write_table(bad if by_name else bad.drop("extra"), DB, t, by_name=by_name)
    assert spark.table(name).columns == ["k", "n", "v"] and spark.table(name).count() == 1
    write_table(spark.sql("SELECT CAST(7 AS tinyint) AS k, NULL AS v, 1.5 AS more"), DB, t)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 2, "a", None), (7, None, None, spark.sql("SELECT 1.5").first()[0])]


@pytest.mark.parametrize("start", ["replace", "upsert"])
def test_upserts_widen_and_refuse(spark, start):
    target = f"{DB}.{unique_name('t')}"
    rows = spark.createDataFrame([(1, 1.5), (2, 2.5)], "k bigint, x double")
    (replace_target(rows, target) if start == "replace" else upsert_target(rows, target, ["k"]))
    upsert_target(spark.createDataFrame([(2, 9)], "k int, x int"), target, ["k"])
    assert sorted(map(tuple, spark.table(target).collect())) == [(1, 1.5), (2, 9.0)]
    with pytest.raises(ValueError, match="'x' .string into double"):
        upsert_target(spark.createDataFrame([(2, "9")], "k int, x string"), target, ["k"])
    assert spark.table(target).count() == 2
