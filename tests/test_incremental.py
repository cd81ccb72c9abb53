import datetime as dt

import pytest

from vetline.session import delete_path, scratch_path, unique_name
from vetline.sinks.commits import CommitConflict, committed_versions
from vetline.sinks.dlq import read_dlq
from vetline.sinks.tables import default_root, upsert_target
from vetline.streaming.incremental import file_stream, load_incremental, stream_id

RULES = [{"rule_type": "regex", "column": "v", "pattern": r"^\d+$"}]
SCHEMA = "k int, v string"


def _drop(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(src)


def test_new_files_only_and_replay_is_idempotent(spark):
    src, ckpt, dlq = scratch_path(spark, "in"), scratch_path(spark, "ck"), scratch_path(spark, "dlq")
    tgt = f"vetline_i.{unique_name('inc')}"
    day = dt.date(2024, 5, 6)

    def run():
        return load_incremental(spark, file_stream(spark, src, SCHEMA), tgt, RULES, keys=["k"],
                                checkpoint=ckpt, dlq_path=dlq, run_date=day)

    _drop(spark, src, [(1, "10"), (2, "x"), (3, "30")])
    m1 = run().collect()
    assert [(r["run_id"], r["total_count"], r["valid_count"]) for r in m1] == [("batch0", 3, 2)]
    assert run().count() == 0  # nothing new: no batch at all

    _drop(spark, src, [(3, "31"), (4, "y"), (5, "50")])
    assert [r["run_id"] for r in run().collect()] == ["batch1"]
    expected = [(1, "10"), (3, "31"), (5, "50")]
    assert sorted(map(tuple, spark.table(tgt).select("k", "v").collect())) == expected

    # Crash after batch 1 wrote but before Spark recorded it: the batch runs again.
    delete_path(spark, f"{ckpt}/commits/1")
    assert [r["run_id"] for r in run().collect()] == ["batch1"]
    assert sorted(map(tuple, spark.table(tgt).select("k", "v").collect())) == expected
    rejects = read_dlq(spark, dlq).select("k", "run_id").collect()
    assert sorted(map(tuple, rejects)) == [(2, "batch0"), (4, "batch1")]


def test_full_replace_is_refused(spark):
    import pytest
    src = scratch_path(spark, "in")
    _drop(spark, src, [(1, "1")])
    stream = file_stream(spark, src, SCHEMA)
    with pytest.raises(ValueError, match="upsert"):
        load_incremental(spark, stream, "vetline_i.x", RULES, keys=["k"], mode="replace")
    with pytest.raises(ValueError):
        load_incremental(spark, spark.range(1), "vetline_i.x", RULES, keys=["k"])
    from vetline.plans.load import load
    with pytest.raises(ValueError, match="load_incremental"):
        load(spark, stream, "vetline_i.x", RULES)


def test_archive_moves_processed_files(spark):
    import os
    import time
    src, ckpt, arch = scratch_path(spark, "in"), scratch_path(spark, "ck"), scratch_path(spark, "arch")
    tgt = f"vetline_i.{unique_name('arc')}"
    local = lambda p: p[len("file:"):] if p.startswith("file:") else p

    def run():
        stream = file_stream(spark, src, SCHEMA, archive_dir=arch)
        return load_incremental(spark, stream, tgt, RULES, keys=["k"], checkpoint=ckpt)

    _drop(spark, src, [(1, "10")])
    run()
    _drop(spark, src, [(2, "20")])
    run()  # archiving of a batch's files happens once a later batch starts
    _drop(spark, src, [(3, "30")])
    run()
    for _ in range(20):
        if any(f.endswith(".csv") for _, _, fs in os.walk(local(arch)) for f in fs):
            break
        time.sleep(0.5)
    archived = [f for _, _, fs in os.walk(local(arch)) for f in fs if f.endswith(".csv")]
    assert archived, "processed files were not archived"
    assert sorted(r["k"] for r in spark.table(tgt).collect()) == [1, 2, 3]


def test_long_running_stream(spark):
    from vetline.streaming.incremental import start_incremental
    src, ckpt = scratch_path(spark, "in"), scratch_path(spark, "ck")
    tgt, runs = f"vetline_i.{unique_name('svc')}", f"vetline_i.{unique_name('runs')}"
    _drop(spark, src, [(1, "10"), (2, "x")])
    query = start_incremental(spark, file_stream(spark, src, SCHEMA), tgt, RULES, keys=["k"],
                              checkpoint=ckpt, interval="1 second", runs_table=runs)
    try:
        query.processAllAvailable()
        _drop(spark, src, [(3, "30")])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r["k"] for r in spark.table(tgt).collect()) == [1, 3]
    got = sorted((r["run_id"], r["valid_count"]) for r in spark.table(runs).collect())
    assert got[0] == ("batch0", 1) and got[-1][1] == 1 and sum(v for _, v in got) == 2


def test_a_replay_after_midnight_adds_nothing_and_undoes_nothing(spark):
    src, ckpt, dlq = scratch_path(spark, "in"), scratch_path(spark, "ck"), scratch_path(spark, "dlq")
    tgt = f"vetline_i.{unique_name('mid')}"

    def run(day):
        return load_incremental(spark, file_stream(spark, src, SCHEMA), tgt, RULES, keys=["k"], checkpoint=ckpt, dlq_path=dlq, run_date=day)

    _drop(spark, src, [(1, "10"), (2, "x")])
    run(dt.date(2024, 5, 6))
    versions = committed_versions(spark, default_root(spark, tgt))
    upsert_target(spark.createDataFrame([(1, "corrected")], SCHEMA), tgt, ["k"])  # by another job, meanwhile
    delete_path(spark, f"{ckpt}/commits/0")
    again = run(dt.date(2024, 5, 7)).collect()
    assert [(r["run_id"], r["status"]) for r in again] == [("batch0", "already_loaded")]
    assert sorted(map(tuple, spark.table(tgt).collect())) == [(1, "corrected")]
    assert [(r.k, r.day) for r in read_dlq(spark, dlq).collect()] == [(2, 6)]
    assert len(versions) == 1 and committed_versions(spark, default_root(spark, tgt))[-1]["streams"] == {stream_id(spark, ckpt): 0}


def test_a_batch_cut_off_before_its_commit_runs_again_on_its_own_day(spark, monkeypatch):
    from vetline.sinks import tables
    src, ckpt, dlq = scratch_path(spark, "in"), scratch_path(spark, "ck"), scratch_path(spark, "dlq")
    tgt = f"vetline_i.{unique_name('cut')}"
    _drop(spark, src, [(1, "10"), (2, "x")])

    def run(day):
        return load_incremental(spark, file_stream(spark, src, SCHEMA), tgt, RULES, keys=["k"], checkpoint=ckpt, dlq_path=dlq, run_date=day)

    real = tables.commit
    monkeypatch.setattr(tables, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(Exception):
        run(dt.date(2024, 5, 6))
    monkeypatch.setattr(tables, "commit", real)
    assert run(dt.date(2024, 5, 7)).first()["status"] == "succeeded"
    assert sorted(map(tuple, spark.table(tgt).collect())) == [(1, "10")]
    assert [(r.k, r.day) for r in read_dlq(spark, dlq).collect()] == [(2, 6)]


def test_two_streams_share_target_queue_and_runs_table(spark):
    dlq, tgt, runs = scratch_path(spark, "dlq"), f"vetline_i.{unique_name('two')}", f"vetline_i.{unique_name('runs')}"
    day, streams = dt.date(2024, 5, 6), {}
    for name, rows in (("a", [(1, "10"), (2, "x")]), ("b", [(3, "30"), (4, "y"), (5, "z")])):
        src, ckpt = scratch_path(spark, name), scratch_path(spark, "ck")
        _drop(spark, src, rows)
        load_incremental(spark, file_stream(spark, src, SCHEMA), tgt, RULES, keys=["k"], checkpoint=ckpt, dlq_path=dlq, run_date=day, runs_table=runs)
        streams[name] = stream_id(spark, ckpt)
    assert sorted(r.k for r in spark.table(tgt).collect()) == [1, 3]
    assert sorted((r.k, r.stream) for r in read_dlq(spark, dlq).collect()) == [(2, streams["a"]), (4, streams["b"]), (5, streams["b"])]
    assert {(r.stream_id, r.run_id) for r in spark.table(runs).collect()} == {(s, "batch0") for s in streams.values()}


def test_a_collision_of_commits_is_tried_again(spark, monkeypatch):
    from vetline.sinks import tables
    src, tgt = scratch_path(spark, "in"), f"vetline_i.{unique_name('col')}"
    _drop(spark, src, [(1, "10")])
    real, left = tables.commit, [2]

    def commit(*args, **kw):
        if left[0]:
            left[0] -= 1
            raise CommitConflict("meanwhile")
        return real(*args, **kw)

    monkeypatch.setattr(tables, "commit", commit)
    got = load_incremental(spark, file_stream(spark, src, SCHEMA), tgt, RULES, keys=["k"]).collect()
    assert [r["status"] for r in got] == ["succeeded"] and spark.table(tgt).count() == 1
