"""Targets that outlive a session, refused replacements, repeated keys, and CSV text."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from vetline.operators.enrich import lookup_right_join, lookup_size
from vetline.plans.load import load
from vetline.session import path_exists, scratch_path, unique_name
from vetline.sinks.dlq import read_dlq
from vetline.sinks.files import write_hourly
from vetline.sinks import commits
from vetline.sinks.commits import committed_versions, filesystem, latest_number, new_version_dir, read_text, write_once
from vetline.sinks.tables import (
    default_root,
    drop_table,
    ensure_registered,
    register_version,
    replace_target,
    sweep_uncommitted,
    upsert_target,
)
from vetline.sources.files import read_csv, read_partitioned
from vetline.streaming.incremental import file_stream, load_incremental

DB = "vetline_d"


def rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=repr)


def forget(spark, target):
    """What a new session with an empty catalog knows of the target: nothing."""
    db, t = target.split(".")
    for table in spark.catalog.listTables(db):
        if table.name.startswith(t):
            drop_table(spark, f"{db}.{table.name}")


@pytest.mark.parametrize("parts", [None, "p"])
def test_each_run_in_a_new_session_adds_to_the_same_target(spark, parts):
    src, ckpt, target = scratch_path(spark, "in"), scratch_path(spark, "ck"), f"{DB}.{unique_name('t')}"
    for drop in range(4):
        df = spark.createDataFrame([(drop, "ab"[drop % 2], "v")], "k int, p string, v string")
        df.coalesce(1).write.mode("append").option("header", True).csv(src)
        load_incremental(spark, file_stream(spark, src, df.schema), target, [], keys=["k", "p"], checkpoint=ckpt, partition_by=parts)
        forget(spark, target)
    ensure_registered(spark, target)
    assert [r[0] for r in spark.table(target).select("k").orderBy("k").collect()] == [0, 1, 2, 3]


def test_a_switch_cut_off_after_its_commit_is_finished_later(spark):
    target = f"{DB}.{unique_name('t')}"
    first = replace_target(spark.range(3), target)["version"]
    replace_target(spark.range(5), target)
    spark.sql(f"ALTER TABLE {target} SET LOCATION '{first}'")
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('vetline.version_path' = '{first}')")
    ensure_registered(spark, target)
    spark.catalog.refreshTable(target)
    assert spark.table(target).count() == 5


def test_a_load_that_is_still_writing_keeps_its_folder_and_a_lost_race_fails(spark):
    target = f"{DB}.{unique_name('t')}"
    root = default_root(spark, target)
    replace_target(spark.range(1), target)
    base, slow = latest_number(spark, root), new_version_dir(root)
    spark.range(9).write.parquet(slow)
    for n in (2, 3, 4):
        replace_target(spark.range(n), target, keep_versions=1)
    assert path_exists(spark, slow) and len(committed_versions(spark, root)) == 1
    with pytest.raises(RuntimeError, match="meanwhile"):
        register_version(spark, target, slow, spark.range(9).schema, root=root, base=base)
    assert spark.table(target).count() == 4 and not path_exists(spark, slow)


@pytest.mark.parametrize("bad, named", [(["CAST(k AS string) AS k", "v"], "k"), (["k"], "v")])
def test_rows_that_do_not_fit_are_refused_and_the_target_stays(spark, bad, named):
    target = f"{DB}.{unique_name('t')}"
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    replace_target(good, target)
    for attempt in (lambda df: replace_target(df, target), lambda df: load(spark, df, target, [])):
        with pytest.raises(ValueError, match=f"'{named}'"):
            attempt(good.selectExpr(*bad))
    assert rows(spark, target) == [(1, "a")]
    replace_target(good.withColumn("extra", F.lit(1.5)), target)
    assert spark.table(target).columns == ["k", "v", "extra"]


@pytest.mark.parametrize("how", [replace_target, lambda df, target, **kw: load(df.sparkSession, df, target, [], **kw)])
def test_replacement_by_position(spark, how):
    target = f"{DB}.{unique_name('t')}"
    replace_target(spark.createDataFrame([(1, "a", 2.5)], "k bigint, v string, x double"), target, partition_by="v")
    assert spark.table(target).columns == ["k", "x", "v"]  # the partition column stands last
    how(spark.createDataFrame([(7, 3, "new")], "v int, k int, x string"), target, by_name=False, partition_by="v")
    assert rows(spark, target) == [(7, 3.0, "new")]
    for bad in ("7 AS k, 'new' AS v", "7.5 AS a, 1 AS b, 'p' AS c"):
        with pytest.raises(ValueError):
            how(spark.sql(f"SELECT {bad}"), target, by_name=False, partition_by="v")
    assert rows(spark, target) == [(7, 3.0, "new")]
    fresh = f"{DB}.{unique_name('t')}"
    how(spark.range(3), fresh, by_name=False)
    assert rows(spark, fresh) == [(0,), (1,), (2,)]


def test_upsert_refuses_other_types_and_absent_columns(spark):
    target = f"{DB}.{unique_name('t')}"
    replace_target(spark.createDataFrame([(1, "a", 2)], "k int, p string, n int"), target, partition_by="p")
    with pytest.raises(ValueError, match="lack p"):
        upsert_target(spark.createDataFrame([(1, 2)], "k int, n int"), target, ["k"], partition_by="p")
    with pytest.raises(ValueError, match="types.*n"):
        upsert_target(spark.createDataFrame([(1, "a", "2")], "k int, p string, n string"), target, ["k"], partition_by="p")


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark):
    target = f"{DB}.{unique_name('t')}"
    whole = spark.range(200).selectExpr("id AS k", "'old' AS v")
    upsert_target(whole, target, ["k"], buckets=8)
    assert spark.table(target).columns == ["k", "v"]
    before = set(spark.table(target).inputFiles())
    upsert_target(spark.createDataFrame([(3, "new"), (999, "new")], "k long, v string"), target, ["k"], buckets=8)
    after = set(spark.table(target).inputFiles())
    assert len(before & after) >= 6 and len({f.rsplit("/", 2)[1] for f in after - before}) <= 2
    assert {(r.k, r.v) for r in spark.table(target).collect()} == {(k, "new" if k == 3 else "old") for k in range(200)} | {(999, "new")}


class TestCrashes:
    """A load that ends at any point of its commit leaves a target that the next one can load."""

    def test_an_empty_commit_file_does_not_block_the_target(self, spark):
        target = f"{DB}.{unique_name('t')}"
        root = default_root(spark, target)
        replace_target(spark.range(3), target)
        path, fs = filesystem(spark, f"{root}/_versions/000000000002.json")
        fs.create(path, False).close()  # created, never written
        assert latest_number(spark, root) == 1
        replace_target(spark.range(5), target)
        assert spark.table(target).count() == 5 and latest_number(spark, root) == 2
        upsert_target(spark.range(4, 9), target, ["id"])
        assert spark.table(target).count() == 9

    @pytest.mark.parametrize("step", ["before", "after"])
    def test_cut_off_around_the_rename(self, spark, monkeypatch, step):
        target = f"{DB}.{unique_name('t')}"
        root = default_root(spark, target)
        replace_target(spark.range(3), target)
        real = commits.write_once

        def cut(*args):
            if step == "after":
                real(*args)
            raise KeyboardInterrupt

        monkeypatch.setattr(commits, "write_once", cut)
        with pytest.raises(KeyboardInterrupt):
            replace_target(spark.range(5), target)
        monkeypatch.setattr(commits, "write_once", real)
        ensure_registered(spark, target)
        spark.catalog.refreshTable(target)
        assert spark.table(target).count() == (3 if step == "before" else 5)
        replace_target(spark.range(7), target)
        assert spark.table(target).count() == 7 and latest_number(spark, root) == (2 if step == "before" else 3)

    def test_only_one_of_many_gets_a_number(self, spark):
        path = f"{scratch_path(spark, 'once')}/_versions/000000000001.json"
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k: write_once(spark, path, f'{{"k": {k}}}'), range(16)))
        assert sum(won) == 1
        folder, fs = filesystem(spark, path.rsplit("/", 1)[0])
        assert [s.getPath().getName() for s in fs.listStatus(folder)] == ["000000000001.json"]
        assert read_text(spark, *filesystem(spark, path)) == f'{{"k": {won.index(True)}}}'

    @pytest.mark.parametrize("parts", [None, "p"])
    def test_what_never_committed_is_swept_by_age(self, spark, parts):
        target = f"{DB}.{unique_name('t')}"
        root = default_root(spark, target)
        df = spark.range(40).selectExpr("id", "CAST(id % 4 AS string) AS p")
        upsert_target(df, target, ["id"], partition_by=parts)
        upsert_target(df.where("id < 2"), target, ["id"], partition_by=parts)  # the first version's other files are still read
        fresh_one, old_one = new_version_dir(root), f"{root}/_v20200101000000000000_0123abcd"
        for folder in (fresh_one, old_one):
            df.write.parquet(folder)
        assert sweep_uncommitted(spark, target) == ["_v20200101000000000000_0123abcd"]
        assert path_exists(spark, fresh_one) and not path_exists(spark, old_one)
        assert sweep_uncommitted(spark, target, older_than=dt.timedelta(0)) == [fresh_one.rsplit("/", 1)[1]]
        assert spark.table(target).count() == 40


class TestFilesOfAnUpsert:
    """A target without partitions or buckets: only files that hold an updated key are rewritten."""

    def files(self, spark, target):
        return set(spark.table(target).inputFiles())

    def many(self, spark, n=400):
        return spark.range(n).selectExpr("id AS k", "'old' AS v").repartitionByRange(8, "k")

    @pytest.fixture(autouse=True)
    def small_files(self, spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        yield
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")

    @pytest.mark.parametrize("start", ["upsert", "replace"])
    def test_untouched_files_stay(self, spark, start):
        target = f"{DB}.{unique_name('t')}"
        if start == "replace":  # a plain target gets its groups with its first upsert
            replace_target(self.many(spark), target)
            upsert_target(spark.createDataFrame([(7, "seven")], "k long, v string"), target, ["k"])
        else:
            upsert_target(self.many(spark), target, ["k"])
        assert spark.table(target).columns == ["k", "v"]
        before = self.files(spark, target)
        assert len(before) >= 6
        upsert_target(spark.createDataFrame([(3, "new"), (5, "new"), (1000, "new")], "k long, v string"), target, ["k"])
        after = self.files(spark, target)
        assert len(before - after) == 1
        want = {(k, "new" if k in (3, 5) else "seven" if k == 7 and start == "replace" else "old") for k in range(400)} | {(1000, "new")}
        assert {tuple(r) for r in spark.table(target).collect()} == want

    def test_new_keys_touch_nothing(self, spark):
        target = f"{DB}.{unique_name('t')}"
        upsert_target(self.many(spark), target, ["k"])
        before = self.files(spark, target)
        upsert_target(spark.range(400, 500).selectExpr("id AS k", "'new' AS v"), target, ["k"])
        assert before < self.files(spark, target) and spark.table(target).count() == 500

    def test_a_replacement_keeps_the_form_and_null_keys_never_match(self, spark):
        target = f"{DB}.{unique_name('t')}"
        upsert_target(self.many(spark), target, ["k"])
        replace_target(self.many(spark, 300), target)
        assert spark.table(target).count() == 300
        load(spark, self.many(spark, 200), target, [])
        before = self.files(spark, target)
        for _ in range(2):
            upsert_target(spark.createDataFrame([(None, "null"), (0, "zero")], "k long, v string"), target, ["k"])
        assert len(before & self.files(spark, target)) >= 1
        rest = spark.table(target).where("k IS NULL OR k = 0").collect()
        assert sorted(map(tuple, rest), key=repr) == [(0, "zero"), (None, "null"), (None, "null")]
        assert spark.table(target).count() == 202

    def test_only_files_in_the_range_of_the_keys_are_searched(self, spark):
        from vetline.sinks.tables import _in_range
        target = f"{DB}.{unique_name('t')}"
        upsert_target(self.many(spark), target, ["k"])
        plan = _in_range(spark.table(target), spark.range(3, 6).toDF("k"), "k")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(k,3)" in plan and "LessThanOrEqual(k,5)" in plan
        assert _in_range(spark.table(target), spark.range(0).toDF("k"), "k").count() == 0

    def test_a_key_that_moves_between_partitions_leaves_the_others_alone(self, spark):
        target = f"{DB}.{unique_name('t')}"
        rows_ = spark.range(60).selectExpr("id AS k", "CAST(id % 6 AS string) AS p", "'old' AS v")
        replace_target(rows_, target, partition_by="p")
        before = self.files(spark, target)
        upsert_target(spark.createDataFrame([(2, "5", "moved"), (99, "new", "new")], "k long, p string, v string"), target, ["k"], partition_by="p")
        after = self.files(spark, target)
        assert {f.rsplit("/", 2)[1] for f in before & after} == {"p=0", "p=1", "p=3", "p=4"}
        assert {tuple(r) for r in spark.table(target).select("k", "p", "v").collect()} == \
            {(k, str(k % 6), "old") for k in range(60) if k != 2} | {(2, "5", "moved"), (99, "new", "new")}

    def test_a_partition_that_loses_its_last_row_is_gone(self, spark):
        target = f"{DB}.{unique_name('t')}"
        replace_target(spark.createDataFrame([(1, "a", None), (2, "b", 7)], "k int, p string, q int"), target, partition_by=["p", "q"])
        upsert_target(spark.createDataFrame([(1, "b", 7), (2, "b", 7)], "k int, p string, q int"), target, ["k"], partition_by=["p", "q"])
        assert rows(spark, target) == [(1, "b", 7), (2, "b", 7)]


def test_another_number_of_buckets_is_refused(spark):
    target = f"{DB}.{unique_name('t')}"
    df = spark.range(20).selectExpr("id AS k", "id % 3 AS other")
    upsert_target(df, target, ["k"], buckets=4)
    for kw in ({"keys": ["k"], "buckets": 7}, {"keys": ["k", "other"], "buckets": 4}, {"keys": ["other", "k"]}):
        with pytest.raises(ValueError, match="4 buckets of k"):
            upsert_target(df, target, **kw)
    upsert_target(df, target, ["k"])  # the target knows its number
    assert spark.table(target).count() == 20
    replace_target(df.where("k < 5"), target)
    upsert_target(df.where("k < 6"), target, ["k"], buckets=4)
    assert spark.table(target).count() == 6
    plain = f"{DB}.{unique_name('t')}"
    replace_target(df, plain)
    with pytest.raises(ValueError, match="not kept in buckets"):
        upsert_target(df, plain, ["k"], buckets=4)


class TestRepeatedKeys:
    def test_refused_or_ordered(self, spark):
        target = f"{DB}.{unique_name('t')}"
        batch = spark.createDataFrame([(1, 5, "b"), (1, 9, "c"), (1, 7, "a"), (2, 1, "z"), (None, 1, "n"), (None, 2, "n")],
                                      "k int, at int, v string")
        with pytest.raises(ValueError, match="order_by"):
            upsert_target(batch, target, ["k"])
        upsert_target(batch, target, ["k"], order_by="at")
        assert rows(spark, target) == sorted([(1, 9, "c"), (2, 1, "z"), (None, 1, "n"), (None, 2, "n")], key=repr)

    @pytest.mark.parametrize("per_trigger", [1, 5])
    def test_keys_without_a_value_are_rejected_and_the_last_row_stands(self, spark, per_trigger):
        src, target, dlq = scratch_path(spark, "in"), f"{DB}.{unique_name('t')}", scratch_path(spark, "dlq")
        for at in range(4):
            df = spark.createDataFrame([(at % 2, at, f"v{at}"), (None, at, "no key")], "k int, at int, v string")
            df.coalesce(1).write.mode("append").option("header", True).csv(src)
            if per_trigger == 1:
                load_incremental(spark, file_stream(spark, src, df.schema), target, [], keys=["k"], dlq_path=dlq, order_by="at",
                                 checkpoint=f"{src}-checkpoint")
        if per_trigger > 1:
            load_incremental(spark, file_stream(spark, src, df.schema, max_files_per_trigger=per_trigger), target, [], keys=["k"],
                             dlq_path=dlq, order_by="at")
        assert rows(spark, target) == [(0, 2, "v2"), (1, 3, "v3")]
        assert read_dlq(spark, dlq).count() == 4


class TestCsv:
    TEXTS = ["  pad  ", "   ", "", None, 'say "hi"', "two\nlines", "a,b", "\ttab", "back\\slash", "é漢", '"', "\n end"]

    def test_text_survives_the_hourly_layout(self, spark):
        root = scratch_path(spark, "hours")
        df = spark.createDataFrame([(k, t, dt.datetime(2024, 5, 6, 7)) for k, t in enumerate(self.TEXTS)], "k int, t string, at timestamp")
        with pytest.raises(Exception, match="line break"):
            write_hourly(df, "at", root)
        write_hourly(df, "at", root, mode="overwrite", line_breaks=True)
        back = read_partitioned(spark, root, schema=df.schema, partition_columns=["year", "month", "day", "hour"], multiLine=True)
        assert [r.t for r in back.orderBy("k").collect()] == self.TEXTS

    def test_hours_are_utc_in_any_session(self, spark):
        root = scratch_path(spark, "hours")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        try:
            write_hourly(spark.sql("SELECT 1 AS k, timestamp '2024-01-02 12:00:00Z' AS at"), "at", root)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert path_exists(spark, f"{root}/year=2024/month=01/day=02/hour=12")

    def test_a_reordered_header_fails(self, spark):
        path = scratch_path(spark, "csv")
        spark.createDataFrame([("x", 1)], "b string, a string").write.option("header", True).csv(path)
        with pytest.raises(Exception, match="(?i)header"):
            read_csv(spark, path, schema="a string, b string").collect()
        with pytest.raises(Exception, match="(?i)header"):
            load_incremental(spark, file_stream(spark, path, "a string, b string"), f"{DB}.{unique_name('t')}", [], keys=["a"])


    def test_a_large_file_is_split_over_tasks(self, spark):
        path = scratch_path(spark, "csv") + "/one.csv"
        spark.range(60_000).selectExpr("id", "repeat('x', 50) AS t").coalesce(1).write.option("header", True).csv(path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        try:
            back = read_csv(spark, path, schema="id long, t string")
            assert back.rdd.getNumPartitions() > 8 and back.agg(F.sum("id")).first()[0] == sum(range(60_000))
            assert read_csv(spark, path, schema="id long, t string", multiLine=True).rdd.getNumPartitions() == 1
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


class TestMalformedRecords:
    def test_raw_text_reaches_the_queue_and_the_target_has_no_such_column(self, spark):
        path, dlq, target = scratch_path(spark, "in") + "/a.csv", scratch_path(spark, "dlq"), f"{DB}.{unique_name('t')}"
        lines = ["1,one", "x,two", "3", "4,four,more", '5,"open', ",six"]
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
        for mode, keys in (("replace", None), ("upsert", ["k"])):
            source = read_csv(spark, path, schema="k int, v string", header=False, keep_malformed=True)
            got = load(spark, source, target, [{"rule_type": "not_null", "column": "k"}], dlq_path=dlq, mode=mode, keys=keys).first()
            assert (got.total_count, got.valid_count) == (6, 2)
            assert spark.table(target).columns == ["k", "v"] and rows(spark, target) == [(1, "one"), (5, "open")]
            back = {r.raw_record: [e.rule_name for e in r._validation_errors] for r in read_dlq(spark, dlq).collect()}
            assert back == {"x,two": ["malformed_record", "not_null_k"], "3": ["malformed_record"], "4,four,more": ["malformed_record"],
                            None: ["not_null_k"]}

    def test_partitioned_and_without_schema(self, spark):
        root = scratch_path(spark, "in")
        spark.createDataFrame([("a,b",), ("1,2",), ("1",)], "value string").coalesce(1).write.text(f"{root}/day=01")
        back = read_partitioned(spark, root, schema=spark.createDataFrame([], "a int, b int").schema, partition_columns=["day"], keep_malformed=True)
        assert {(r.a, r.b, r._corrupt_record, r.day) for r in back.collect()} == {(1, 2, None, "01"), (1, None, "1", "01")}
        assert read_csv(spark, f"{root}/day=01", keep_malformed=True).where("_corrupt_record IS NOT NULL").select("a", "_corrupt_record").first() == ("1", "1")
        with pytest.raises(ValueError, match="schema"):
            read_partitioned(spark, root, keep_malformed=True)


class TestPinnedSource:
    def test_other_rows_in_equal_number_are_refused(self, spark, monkeypatch):
        from vetline.plans import load as plan
        src, target = scratch_path(spark, "src"), f"{DB}.{unique_name('t')}"
        spark.createDataFrame([(1, "a"), (2, None)], "k int, v string").write.parquet(src)
        replace_target(spark.createDataFrame([(0, "old")], "k int, v string"), target)
        real = plan.scratch_path

        def between_the_passes(*args):
            spark.createDataFrame([(1, "a"), (3, None)], "k int, v string").write.mode("append").parquet(f"{src}-new")
            (hpath, fs), (new, _) = commits.filesystem(spark, src), commits.filesystem(spark, f"{src}-new")
            fs.delete(hpath, True)
            fs.rename(new, hpath)
            return real(*args)

        monkeypatch.setattr(plan, "scratch_path", between_the_passes)
        source = spark.read.schema("k int, v string").parquet(src)
        with pytest.raises(Exception):
            load(spark, source, target, [{"rule_type": "not_null", "column": "v"}])
        assert rows(spark, target) == [(0, "old")]

    def test_a_source_that_changes_by_itself(self, spark):
        target = f"{DB}.{unique_name('t')}"
        source = spark.range(20).withColumn("r", F.current_timestamp()).withColumn("v", F.when(F.col("id") > 5, "x"))
        with pytest.raises(RuntimeError, match="changed"):
            load(spark, source, target, [{"rule_type": "not_null", "column": "v"}])
        source = source.drop("r").withColumn("m", F.create_map(F.lit("a"), F.col("id")))
        assert load(spark, source, target, [{"rule_type": "not_null", "column": "v"}]).first().invalid_count == 6


class TestBlankPartitionKeys:
    def test_rejects_keep_their_fields(self, spark):
        target, dlq = f"{DB}.{unique_name('t')}", scratch_path(spark, "dlq")
        src = spark.createDataFrame([(1, "x"), (2, ""), (3, None)], "k int, part string")
        load(spark, src, target, [{"rule_type": "not_null", "column": "part"}], dlq_path=dlq, partition_by="part")
        assert sorted((r.k, r.part) for r in read_dlq(spark, dlq).collect()) == [(2, ""), (3, None)]
        assert rows(spark, target) == [(1, "x")]

    TEXTS = ["", None, " ", "__vetline_empty__", "__vetline_empty__x", "__vetline_empt", "a/b=c", "ü"]

    @pytest.mark.parametrize("how", ["replace", "load", "upsert"])
    def test_blank_values_stay_apart_from_null(self, spark, how):
        target = f"{DB}.{unique_name('t')}"
        df = spark.createDataFrame([(k, t, "v") for k, t in enumerate(self.TEXTS)], "k int, p string, v string")
        if how == "load":
            load(spark, df, target, [], partition_by="p")
        else:
            (replace_target if how == "replace" else lambda *a, **kw: upsert_target(*a, keys=["k"], **kw))(df, target, partition_by="p")
        assert [r.p for r in spark.table(target).orderBy("k").collect()] == self.TEXTS
        assert [r.k for r in spark.table(target).where("p = ''").collect()] == [0]
        assert [r.k for r in spark.table(target).where("p IS NULL").collect()] == [1]
        forget(spark, target)
        ensure_registered(spark, target)
        moved = spark.createDataFrame([(0, "", "new"), (2, "", "new"), (1, None, "new"), (9, "__vetline_empty__", "new")], df.schema)
        upsert_target(moved, target, ["k"], partition_by="p")
        want = {k: (t, "v") for k, t in enumerate(self.TEXTS)} | {0: ("", "new"), 1: (None, "new"), 2: ("", "new"), 9: ("__vetline_empty__", "new")}
        assert {r.k: (r.p, r.v) for r in spark.table(target).collect()} == want
        upsert_target(spark.createDataFrame([(0, "", "again"), (5, "a", "again")], df.schema), target, ["k", "p"], partition_by="p")
        got = sorted((r.k, r.p, r.v) for r in spark.table(target).where("k IN (0, 5)").collect())
        assert got == [(0, "", "again"), (5, "__vetline_empt", "v"), (5, "a", "again")]

    def test_pruning_still_reaches_the_folders(self, spark):
        import re
        target = f"{DB}.{unique_name('t')}"
        for value in ("x", ""):  # without and with values under another name
            replace_target(spark.createDataFrame([(1, value), (2, "b")], "k int, p string"), target, partition_by="p")
            plan = spark.table(target).where("p = 'b'")._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [" in plan and "b" in re.search(r"PartitionFilters: \[(.*?)\]", plan, re.S).group(1), plan
            assert [r.k for r in spark.table(target).where("p = 'b'").collect()] == [2]


class TestHotKeys:
    def test_hot_on_either_side_gives_the_same_rows(self, spark):
        lookup = spark.createDataFrame([(1 if k % 10 else k, f"l{k}") for k in range(60)] + [(None, "n")], "k int, l string")
        records = spark.createDataFrame([(2 if r % 4 else r, r) for r in range(80)] + [(1, 100), (1, 100), (None, 101)], "k int, r int")
        want = lookup_right_join(lookup, records, "k", broadcast=False)
        got = lookup_right_join(lookup, records, "k", broadcast=False, salt_buckets=3)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)

    def test_measuring_a_lookup(self, spark):
        n, size = lookup_size(spark.range(1000).repartition(7))
        assert n == 1000 and size >= 8 * 1000


class TestDlqTable:
    def test_a_run_that_is_repeated_leaves_one_copy(self, spark):
        from vetline.sinks.dlq import append_dlq_table
        t, day = unique_name("dlq"), dt.date(2024, 5, 6)
        first, again = (spark.createDataFrame([(1, v)], "k int, v string") for v in ("first", "again"))
        for rows_, run, on in ((first, "r1", day), (first, "it's", day), (first, "r1", day + dt.timedelta(days=1)), (again, "r1", day), (again, "it's", day)):
            append_dlq_table(rows_, DB, t, on, run)
        got = sorted((r.run_id, r.run_date.day, r.v) for r in spark.table(f"{DB}.{t}").collect())
        assert got == [("it's", 6, "again"), ("r1", 6, "again"), ("r1", 7, "first")]

    def test_a_table_of_the_older_form_is_appended_to(self, spark):
        from vetline.sinks.catalog import write_table
        from vetline.sinks.dlq import append_dlq_table
        t, day = unique_name("dlq"), dt.date(2024, 5, 6)
        rows_ = spark.createDataFrame([(1, "a")], "k int, v string")
        write_table(rows_.withColumn("run_id", F.lit("r0")).withColumn("run_date", F.lit(day)), DB, t, partition_by="run_date")
        append_dlq_table(rows_, DB, t, day, "r1")
        assert sorted(r.run_id for r in spark.table(f"{DB}.{t}").collect()) == ["r0", "r1"]
