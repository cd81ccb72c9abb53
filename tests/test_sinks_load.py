import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from vetline.functions.checks import ERRORS_COL
from vetline.operators.validate import validate_split
from vetline.plans.load import jdbc_publisher, load
from vetline.session import path_exists, unique_name
from vetline.sinks.catalog import write_table
from vetline.sinks.dlq import dlq_path, read_dlq, write_dlq
from vetline.sinks.files import write_hourly
from vetline.sinks.tables import (
    current_data_path,
    current_version,
    default_root,
    replace_target,
    table_exists,
    upsert_target,
)
from vetline.sources.files import read_partitioned
from vetline.sources.jdbc import jdbc_table_exists, read_jdbc, write_jdbc

DAY = dt.date(2024, 3, 5)
RULES = [{"rule_type": "not_null", "column": "vendor_id"},
         {"rule_type": "regex", "column": "vendor_id", "pattern": r"^\d+$"}]
DB = "vetline_t"


def _src(spark):
    return spark.createDataFrame([(1, "7"), (2, None), (3, "x"), (4, "42")], "k int, vendor_id string")


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _staging_left(spark, target):
    prefix = target.split(".")[1] + "__staging"
    if not spark.catalog.databaseExists(DB):
        return []
    return [t.name for t in spark.catalog.listTables(DB) if t.name.startswith(prefix)]


def test_dlq_path_format():
    assert dlq_path("s3://b/dlq/", DAY) == "s3://b/dlq/year=2024/month=03/day=05/"
    assert dlq_path("s3://b/dlq", DAY, "r1").endswith("day=05/run_id=r1/")


def test_dlq_empty_writes_nothing(spark, tmp_root):
    _, invalid = validate_split(_src(spark).filter("k = 1"), RULES)
    assert write_dlq(invalid, tmp_root, DAY) == 0
    assert not path_exists(spark, tmp_root)


def test_dlq_keeps_null_fields_and_reads_back(spark, tmp_root):
    _, invalid = validate_split(_src(spark), RULES)
    assert write_dlq(invalid, tmp_root, DAY) == 2
    folder = _local(dlq_path(tmp_root, DAY))
    lines = [json.loads(x) for f in os.listdir(folder) if f.endswith(".json")
             for x in open(os.path.join(folder, f))]
    null_row = next(r for r in lines if r["k"] == 2)
    assert "vendor_id" in null_row and null_row["vendor_id"] is None
    assert null_row[ERRORS_COL][0] == {"rule_name": "not_null_vendor_id", "column": "vendor_id", "value": None}
    back = read_dlq(spark, tmp_root)
    assert sorted(r["k"] for r in back.collect()) == [2, 3]
    assert {r["year"] for r in back.collect()} == {2024}


def test_dlq_same_day_overwrites_but_runs_are_kept_apart(spark, tmp_root):
    _, invalid = validate_split(_src(spark), RULES)
    write_dlq(invalid, tmp_root, DAY)
    write_dlq(invalid.filter("k = 3"), tmp_root, DAY)
    assert [r["k"] for r in read_dlq(spark, tmp_root).collect()] == [3]
    other = tmp_root + "_runs"
    write_dlq(invalid, other, DAY, run_id="a")
    write_dlq(invalid.filter("k = 3"), other, DAY, run_id="b")
    assert read_dlq(spark, other).count() == 3


def test_dlq_renames_path_like_columns(spark, tmp_root):
    df = spark.createDataFrame([(1999, None)], "year int, vendor_id string")
    _, invalid = validate_split(df, RULES)
    write_dlq(invalid, tmp_root, DAY)
    row = read_dlq(spark, tmp_root).first()
    assert row["src_year"] == 1999 and row["year"] == 2024


def test_partitioned_table_and_evolution(spark, tmp_root):
    t = unique_name("parts")
    name = write_table(_src(spark), DB, t, path=tmp_root, partition_by="vendor_id")
    assert spark.table(name).columns == ["k", "vendor_id"]
    with pytest.raises(ValueError, match="nope"):
        write_table(_src(spark), DB, unique_name("x"), partition_by="nope")
    t2 = unique_name("evo")
    write_table(_src(spark).select("k"), DB, t2)
    write_table(_src(spark).select("vendor_id", "k"), DB, t2)
    rows = spark.table(f"{DB}.{t2}").collect()
    assert len(rows) == 8 and sum(r["vendor_id"] is None for r in rows) == 5


def test_hourly_layout(spark, tmp_root):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3, 4, 5))], "id int, ts timestamp")
    write_hourly(df, "ts", tmp_root)
    assert os.path.isdir(_local(tmp_root) + "/year=2024/month=01/day=02/hour=03")
    back = read_partitioned(spark, tmp_root, "csv", schema=df.schema,
                            partition_columns=["year", "month", "day", "hour"])
    assert tuple(back.select("month", "hour").first()) == ("01", "03")


class TestLoad:
    def _target(self):
        return f"{DB}.{unique_name('tgt')}"

    def test_replace_valid_rows_only(self, spark, tmp_root):
        tgt = self._target()
        m = load(spark, _src(spark), tgt, RULES, dlq_path=tmp_root, run_date=DAY).first()
        assert (m["status"], m["total_count"], m["valid_count"], m["invalid_count"], m["dlq_count"]) == (
            "succeeded", 4, 2, 2, 2)
        assert sorted(r["k"] for r in spark.table(tgt).collect()) == [1, 4]
        assert not _staging_left(spark, tgt)
        # valid rows were written once, straight into the new version, with the target's columns only
        assert current_data_path(spark, tgt) == m["target_version"]
        assert spark.read.parquet(m["target_version"]).columns == ["k", "vendor_id"]

    def test_zero_valid_keeps_old_rows(self, spark, tmp_root):
        tgt = self._target()
        replace_target(_src(spark), tgt)
        m = load(spark, _src(spark).filter("k in (2, 3)"), tgt, RULES, dlq_path=tmp_root).first()
        assert m["status"] == "no_valid_rows" and spark.table(tgt).count() == 4

    def test_empty_source_is_a_noop(self, spark):
        tgt = self._target()
        replace_target(_src(spark), tgt)
        m = load(spark, _src(spark).filter("k < 0"), tgt, RULES).first()
        assert m["status"] == "empty_source" and spark.table(tgt).count() == 4

    def test_failure_before_switch_leaves_target(self, spark):
        tgt = self._target()
        replace_target(_src(spark), tgt)
        before = current_version(spark, tgt)
        with pytest.raises(RuntimeError, match="expected"):
            replace_target(_src(spark).filter("k > 1"), tgt, expected_count=99)
        assert current_version(spark, tgt) == before and spark.table(tgt).count() == 4

    def test_failing_source_drops_staging(self, spark):
        tgt = self._target()
        bad = _src(spark).withColumn("vendor_id", F.when(F.col("k") == 4, F.raise_error(F.lit("boom")))
                                     .otherwise(F.col("vendor_id")))
        with pytest.raises(Exception):
            load(spark, bad, tgt, RULES)
        assert not _staging_left(spark, tgt)
        assert not table_exists(spark, DB, tgt.split(".")[1])
        root = _local(default_root(spark, tgt))
        assert not os.path.exists(root) or not [d for d in os.listdir(root) if d.startswith("_v")]

    def test_dlq_failure_is_recorded_and_load_goes_on(self, spark, tmp_root):
        blocker = _local(tmp_root) + "_file"
        os.makedirs(os.path.dirname(blocker), exist_ok=True)
        open(blocker, "w").write("not a folder")
        tgt = self._target()
        m = load(spark, _src(spark), tgt, RULES, dlq_path=blocker + "/sub", run_date=DAY).first()
        assert m["status"] == "succeeded" and m["dlq_status"].startswith("failed")
        assert spark.table(tgt).count() == 2

    def test_upsert_by_key(self, spark):
        tgt = self._target()
        replace_target(_src(spark).filter("k in (1, 4)"), tgt)
        upd = spark.createDataFrame([(4, "400"), (5, "5"), (None, "6")], "k int, vendor_id string")
        load(spark, upd, tgt, RULES, mode="upsert", keys=["k"])
        assert sorted(map(tuple, spark.table(tgt).collect()), key=str) == sorted(
            [(1, "7"), (4, "400"), (5, "5"), (None, "6")], key=str)

    def test_upsert_needs_keys(self, spark):
        with pytest.raises(ValueError):
            load(spark, _src(spark), self._target(), RULES, mode="upsert")
        with pytest.raises(ValueError):
            upsert_target(_src(spark), self._target(), [])

    def test_versions_are_pruned(self, spark):
        tgt = self._target()
        for _ in range(4):
            out = replace_target(_src(spark), tgt, keep_versions=2)
        root = _local(out["version"]).rsplit("/", 1)[0]
        assert len([d for d in os.listdir(root) if d.startswith("_v2")]) == 2


def test_jdbc_replace_and_cleanup(spark):
    url = f"jdbc:derby:memory:{unique_name('t')};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_jdbc(_src(spark), url, "TGT", props, mode="overwrite")
    load(spark, _src(spark), f"{DB}.jdbc_stage_probe", RULES, staging=f"{DB}.{unique_name('s')}",
         publish=jdbc_publisher(url, "TGT", props, staging="TGT_STG"))
    assert sorted(r["k"] for r in read_jdbc(spark, url, "TGT", props).collect()) == [1, 4]
    assert not jdbc_table_exists(spark, url, "TGT_STG", props)
    # A staged count that disagrees aborts before the swap; staging is still dropped.
    with pytest.raises(RuntimeError):
        jdbc_publisher(url, "TGT", props, staging="TGT_STG")(_src(spark), 99)
    assert not jdbc_table_exists(spark, url, "TGT_STG", props)
    assert read_jdbc(spark, url, "TGT", props).count() == 2


def test_partition_scoped_upsert(spark):
    tgt = f"{DB}.{unique_name('pup')}"
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, None, "x")],
                                 "k int, p string, v string")
    replace_target(base, tgt, partition_by="p")
    up1 = spark.createDataFrame([(2, "b", "new"), (5, "d/e", "new"), (4, None, "new")], "k int, p string, v string")
    out1 = upsert_target(up1, tgt, keys=["k", "p"], partition_by="p", keep_versions=2)
    written = sorted(d for d in os.listdir(_local(out1["version"])) if d.startswith("p="))
    assert written == ["p=__HIVE_DEFAULT_PARTITION__", "p=b", "p=d%2Fe"]  # only touched partitions
    up2 = spark.createDataFrame([(1, "a", "newer"), (6, "a", "newer")], "k int, p string, v string")
    out2 = upsert_target(up2, tgt, keys=["k", "p"], partition_by="p", keep_versions=1)
    assert sorted(d for d in os.listdir(_local(out2["version"])) if d.startswith("p=")) == ["p=a"]
    got = sorted(map(tuple, spark.table(tgt).select("k", "p", "v").collect()), key=str)
    assert got == sorted([(1, "a", "newer"), (6, "a", "newer"), (2, "b", "new"), (3, "c", "x"),
                          (4, None, "x"), (4, None, "new"), (5, "d/e", "new")], key=str)
    # pruning kept the older folders that the current version still reads,
    # and only the partitions it reads
    assert spark.table(tgt).filter("p = 'c'").count() == 1
    first = _local(out1["version"]).rsplit("/", 1)[0]
    leftovers = {v: sorted(d for d in os.listdir(f"{first}/{v}") if d.startswith("p="))
                 for v in os.listdir(first) if v.startswith("_v")}
    assert sorted(sum(leftovers.values(), [])) == ["p=__HIVE_DEFAULT_PARTITION__", "p=a", "p=b", "p=c",
                                                   "p=d%2Fe"]
    # a key move across partitions is a different key when p is part of it
    up3 = spark.createDataFrame([(3, "a", "moved")], "k int, p string, v string")
    upsert_target(up3, tgt, keys=["k", "p"], partition_by="p")
    assert spark.table(tgt).filter("k = 3").count() == 2


def test_upsert_with_key_outside_partitions_finds_its_rows(spark):
    tgt = f"{DB}.{unique_name('pall')}"
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    replace_target(base, tgt, partition_by="p")
    upsert_target(spark.createDataFrame([(1, "b")], "k int, p string"), tgt, keys=["k"], partition_by="p")
    assert sorted(map(tuple, spark.table(tgt).select("k", "p").collect())) == [(1, "b"), (2, "b")]


def test_partition_scoped_upsert_prunes_the_scan(spark):
    from vetline.sinks.tables import _rows_in
    tgt = f"{DB}.{unique_name('prn')}"
    base = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 20).cast("string").alias("p"))
    replace_target(base, tgt, partition_by="p")
    touched = spark.createDataFrame([("3",), (None,)], "p string")
    pruned = _rows_in(spark.table(tgt), touched.collect(), ["p"], touched.schema)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    import re
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "= 3" in filters and "isnull" in filters
    assert pruned.count() == 10


def test_partitioned_csv_header_mismatch_fails(spark, tmp_root):
    good = spark.createDataFrame([(1, "a")], "id int, name string")
    good.write.option("header", True).csv(tmp_root + "/hour=01")
    good.select("name", "id").write.option("header", True).csv(tmp_root + "/hour=02")  # swapped header
    back = read_partitioned(spark, tmp_root, "csv", schema=good.schema, partition_columns=["hour"])
    with pytest.raises(Exception, match="(?i)header|schema"):
        back.collect()


def test_schema_check_before_staging(spark):
    from vetline.operators.validate import schema_problems
    src = _src(spark)
    assert schema_problems(src, "k int, vendor_id string") == []
    assert schema_problems(src, {"k": "bigint", "zone": "string"}) == [
        "column 'k' is int, expected bigint", "missing column 'zone' (string)"]
    tgt = f"{DB}.{unique_name('sch')}"
    with pytest.raises(ValueError, match="zone"):
        load(spark, src, tgt, RULES, expected_schema="k int, zone string")
    assert not table_exists(spark, DB, tgt.split(".")[1]) and not _staging_left(spark, tgt)
    assert load(spark, src, tgt, RULES, expected_schema="k int").first()["status"] == "succeeded"


def test_partition_scoped_upsert_two_columns(spark):
    tgt = f"{DB}.{unique_name('p2')}"
    base = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 2, "x"), (3, "b", 1, "x"), (4, None, 1, "x")],
                                 "k int, p string, q int, v string")
    replace_target(base, tgt, partition_by=["p", "q"])
    up = spark.createDataFrame([(1, "a", 1, "new"), (3, "a", 2, "new"), (4, None, 1, "new")],
                               "k int, p string, q int, v string")
    out = upsert_target(up, tgt, keys=["k", "p", "q"], partition_by=["p", "q"])
    rewritten = sorted(os.path.relpath(r, _local(out["version"])) for r, ds, fs in os.walk(_local(out["version"]))
                       if any(f.endswith(".parquet") for f in fs))
    assert rewritten == ["p=__HIVE_DEFAULT_PARTITION__/q=1", "p=a/q=1", "p=a/q=2"]
    got = sorted(map(tuple, spark.table(tgt).select("k", "p", "q", "v").collect()), key=str)
    assert got == sorted([(1, "a", 1, "new"), (2, "a", 2, "x"), (3, "a", 2, "new"), (3, "b", 1, "x"),
                          (4, None, 1, "x"), (4, None, 1, "new")], key=str)


def test_reader_planned_before_switch_keeps_old_rows(spark):
    tgt = f"{DB}.{unique_name('rd')}"
    replace_target(_src(spark), tgt)
    before = spark.table(tgt).select("k")  # resolved now, read later
    replace_target(_src(spark).filter("k > 2"), tgt, keep_versions=2)
    assert sorted(r["k"] for r in before.collect()) == [1, 2, 3, 4]  # old version still there
    assert sorted(r["k"] for r in spark.table(tgt).collect()) == [3, 4]


def test_upsert_inherits_from_a_loaded_version(spark, tmp_root):
    tgt = f"{DB}.{unique_name('mix')}"
    src = spark.createDataFrame([(1, "a", "7"), (2, "b", "8"), (3, "c", "x")], "k int, p string, vendor_id string")
    first = load(spark, src, tgt, RULES, partition_by="p", dlq_path=tmp_root).first()["target_version"]
    upd = spark.createDataFrame([(1, "a", "70"), (4, "d", "9")], "k int, p string, vendor_id string")
    m = load(spark, upd, tgt, RULES, mode="upsert", keys=["k", "p"], partition_by="p", keep_versions=1).first()
    assert m["status"] == "succeeded"
    got = sorted(map(tuple, spark.table(tgt).select("k", "p", "vendor_id").collect()))
    assert got == [(1, "a", "70"), (2, "b", "8"), (4, "d", "9")]
    # the first version keeps only what the current one still reads: p=b
    left = sorted(r for r, ds, fs in os.walk(_local(first)) if any(f.endswith(".parquet") for f in fs))
    assert [os.path.relpath(r, _local(first)) for r in left] == ["p=b"]


def test_pruning_never_drops_the_current_version(spark):
    from vetline.sinks.commits import new_version_dir
    from vetline.sinks.tables import default_root, register_version
    tgt = f"{DB}.{unique_name('cur')}"
    early = new_version_dir(default_root(spark, tgt))  # a slow load starts first ...
    replace_target(_src(spark), tgt)          # ... a fast one finishes meanwhile
    _src(spark).filter("k = 1").write.parquet(early)
    register_version(spark, tgt, early, _src(spark).schema, keep_versions=1)  # older name, now current
    assert [r["k"] for r in spark.table(tgt).collect()] == [1]


class TestKeyRanges:
    """Conditions of equal depth for JDBC reads, over an in-process database."""

    DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}

    def table(self, spark, keys):
        from vetline.sources.jdbc import write_jdbc
        url = f"jdbc:derby:memory:{unique_name('ranges')};create=true"
        df = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "K long, N long")
        write_jdbc(df, url, "T", self.DERBY, mode="overwrite")
        return url

    def read(self, spark, url, n, **kw):
        from vetline.sources.jdbc import equi_depth_predicates, read_jdbc
        ranges = equi_depth_predicates(spark, url, "T", "K", n, self.DERBY, **kw)
        back = read_jdbc(spark, url, "T", self.DERBY, partition_column="K", num_partitions=n)
        sizes = [r.n for r in back.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        return ranges, sorted(r.N for r in back.collect()), sizes

    def test_skewed_keys_are_split_evenly(self, spark):
        keys = [k for k in range(700)] + [10**12 + k for k in range(100)]
        ranges, rows, sizes = self.read(spark, self.table(spark, keys), 4)
        assert len(ranges) == 4 and rows == list(range(800)) and sizes == [200] * 4

    def test_a_hot_key_null_keys_and_few_keys(self, spark):
        keys = [5] * 300 + [None] * 20 + list(range(10, 30))
        ranges, rows, sizes = self.read(spark, self.table(spark, keys), 4)
        assert rows == list(range(len(keys))) and max(sizes) <= 320 and 1 < len(ranges) <= 4
        for own in ([], [None, None], [7, 7]):
            ranges, rows, _ = self.read(spark, self.table(spark, own), 3)
            assert ranges == ["1 = 1"] and rows == list(range(len(own)))

    def test_a_sample_covers_all_rows(self, spark):
        keys = [k * k for k in range(1000)] + [-k for k in range(500)]
        ranges, rows, _ = self.read(spark, self.table(spark, keys), 5, sample=100)
        assert 3 <= len(ranges) <= 5 and rows == list(range(1500))
        with pytest.raises(ValueError, match="both bounds"):
            from vetline.sources.jdbc import read_jdbc
            read_jdbc(spark, "jdbc:derby:memory:x;create=true", "T", self.DERBY, partition_column="K", lower_bound=1, num_partitions=3)


def test_very_many_partition_values_share_folders(spark):
    target = f"{DB}.{unique_name('many')}"
    n = 12_000
    src = spark.range(n).select("id", F.when(F.col("id") % 100 == 0, F.lit("")).when(F.col("id") % 100 == 1, F.lit(None))
                                .otherwise(F.col("id").cast("string")).alias("v"))
    rules = [{"rule_type": "regex", "column": "id", "pattern": "^.*[0-8]$"}]
    load(spark, src, target, rules, partition_by="v")
    folders = [d for d in os.listdir(_local(current_data_path(spark, target))) if "=" in d]
    assert 1 < len(folders) < 10
    want = {r.id: r.v for r in src.where("id % 10 <> 9").collect()}
    assert spark.table(target).columns == ["id", "v"]
    got = [tuple(r) for r in spark.table(target).collect()]
    assert len(got) == len(want) and dict(got) == want
    # An upsert by another key moves a row from one value to another, and finds rows wherever they stand.
    change = spark.createDataFrame([(2, "new"), (100, "7"), (1, ""), (n, None)], "id long, v string")
    upsert_target(change, target, ["id"], partition_by="v")
    want.update({r.id: r.v for r in change.collect()})
    got = [tuple(r) for r in spark.table(target).collect()]
    assert len(got) == len(want) and dict(got) == want
    for other in (None, "id"):
        with pytest.raises(ValueError, match="partition"):
            upsert_target(change, target, ["id"], partition_by=other)
    with pytest.raises(ValueError, match="partition"):
        replace_target(src, target)
    # Few values have folders of their own again.
    load(spark, src.where("id < 50"), target, rules, partition_by="v")
    folders = [d for d in os.listdir(_local(current_data_path(spark, target))) if "=" in d]
    assert len(folders) == 45 and spark.table(target).count() == 45
