"""Validated load: stage, validate, dead-letter, replace or upsert, clean up.

Plan (the source is scanned once, in replace mode a second time if rows are rejected,
and before that for an estimate of a partitioned target's values):

1. Validate the source while writing it. In replace mode the valid rows go
   straight into a new version folder of the target, written once and with
   the target's columns only; the total and valid counters are observed
   during that write, above the shuffle that gathers partitions, so a map
   task that runs again is not counted again. Only if there are rejects is the
   source read once more, filtered to them, and their error arrays are built;
   their number must agree with the counters. In upsert mode (or with a custom
   ``publish``) all rows go to a staging table by an ``_is_valid`` flag.
2. Empty source: stop; the target is untouched.
3. Rejected rows go to the DLQ (and optionally a DLQ table) with their
   original fields. A DLQ failure is recorded in the metrics and the load goes
   on.
4. No valid row: the target keeps its rows. Otherwise switch the target to
   the new version in one catalog call (replace), or upsert the valid rows
   by key, or hand them to ``publish``.
5. Staging (table or unused version folder) is removed whatever happened,
   including a failure while staging.

Each step reads durable output of the previous one, so a lost executor only
re-runs tasks of the current step.

A source that keeps malformed records (``keep_malformed=True`` of the readers)
has them rejected first of all: an error entry ``malformed_record`` with the
record's raw text, which the DLQ keeps as a field too. The target does not get
that column.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
import uuid
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vetline.functions.checks import ERRORS_COL, col_ref, errors_array, is_valid
from vetline.functions.rules import Rule, well_formed
from vetline.operators.validate import check_patterns, plan_rules, schema_problems
from vetline.sinks.dlq import append_dlq_table, write_dlq
from vetline.session import delete_path, scratch_path
from vetline.sinks.commits import latest_number, new_version_dir
from vetline.sinks.tables import (
    append_rows,
    by_position,
    check_replacement,
    default_root,
    drop_table,
    ensure_registered,
    escaped,
    gathered,
    layout_for,
    needs_escape,
    register_version,
    stage,
    upsert_target,
    with_hidden,
)

from vetline.sources.files import CORRUPT

log = logging.getLogger(__name__)

VALID_FLAG = "_is_valid"

METRICS_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("target", StringType(), False),
    StructField("status", StringType(), False),
    StructField("total_count", LongType(), False),
    StructField("valid_count", LongType(), False),
    StructField("invalid_count", LongType(), False),
    StructField("dlq_count", LongType(), False),
    StructField("dlq_status", StringType(), False),
    StructField("rules_skipped", LongType(), False),
    StructField("target_version", StringType(), True),
    StructField("stream_id", StringType(), True),
])


def load(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    rules: Sequence[Rule | Mapping],
    dlq_path: str | None = None,
    run_date: dt.date | None = None,
    run_id: str | None = None,
    mode: str = "replace",
    keys: Sequence[str] | None = None,
    partition_by: Sequence[str] | str | None = None,
    target_root: str | None = None,
    staging: str | None = None,
    on_missing: str = "skip",
    dlq_table: str | None = None,
    runs_table: str | None = None,
    keep_versions: int = 2,
    dlq_per_run: bool = False,
    publish: Callable[[DataFrame, int], str | None] | None = None,
    expected_schema=None,
    order_by: Sequence[str] | str | None = None,
    buckets: int | None = None,
    batch: tuple[str, int] | None = None,
    by_name: bool = True,
) -> DataFrame:
    """Run one validated load of ``source`` into ``target``; return a one-row
    metrics DataFrame (also appended to ``runs_table`` when given).

    ``dlq_per_run`` writes rejects under ``.../day=DD/run_id=<run_id>/`` so
    runs on the same day do not overwrite each other, and rerunning one run
    replaces only its own rejects.

    ``expected_schema`` (StructType, DDL string or ``{name: type}``) is checked
    before anything is staged; a missing column or another type fails the
    load and leaves the target untouched (together with ``on_missing='fail'``
    this is the pre-merge schema check).

    ``order_by`` lets an upsert take several rows of one key: the last by these
    columns stands. ``buckets`` keeps an upsert target in that many hash
    buckets of the key (see ``upsert_target``).

    ``batch`` (stream id, number) makes an upsert a batch of that stream: the
    number is committed with the target's version, so that a batch included
    already changes nothing, and staging and rejects carry the stream's id.

    ``by_name=False`` (replace mode) gives the valid rows to the target's columns
    by position instead of by name; rules use the source's names.

    ``publish(accepted, valid_count)`` replaces the default target switch
    (catalog table replace or upsert), e.g. ``jdbc_publisher(...)`` for a
    database table; it returns a version label or None.
    """
    if source.isStreaming:
        raise ValueError("load() takes a batch DataFrame; use load_incremental for a stream")
    if mode not in ("replace", "upsert"):
        raise ValueError("mode must be 'replace' or 'upsert'")
    if mode == "upsert" and not keys:
        raise ValueError("mode='upsert' needs keys")
    if not by_name and (mode != "replace" or publish is not None):
        raise ValueError("by_name=False is for replacements of a target table")
    if batch and (mode != "upsert" or publish is not None):
        raise ValueError("batch is for upserts of a target table")
    if expected_schema is not None:
        problems = schema_problems(source, expected_schema)
        if problems:
            raise ValueError("Source schema check failed: " + "; ".join(problems))
    run_date = run_date or dt.date.today()
    run_id = run_id or uuid.uuid4().hex[:12]
    # One staging table per run, so concurrent loads of a target never share it.
    stream = batch[0] if batch else None
    staging = staging or f"{target}__staging_{re.sub('[^0-9A-Za-z]', '_', stream + '_' if stream else '')}{run_id}"
    active, skipped = plan_rules(source.columns, rules, on_missing)
    check_patterns(spark, active)
    if CORRUPT in source.columns:
        active.insert(0, well_formed(CORRUPT))
    source = source.drop(ERRORS_COL)
    own = source.drop(CORRUPT, VALID_FLAG).schema

    metrics = dict(run_id=run_id, target=target, status="started", total_count=0, valid_count=0,
                   invalid_count=0, dlq_count=0, dlq_status="skipped", rules_skipped=len(skipped),
                   target_version=None, stream_id=stream)
    direct = mode == "replace" and publish is None
    part_cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    version = registered = rejects_path = None
    try:
        ok = is_valid(active) if active else F.lit(True)
        obs = Observation(f"load_{run_id}")
        counters = (F.count(F.lit(1)).alias("total"), F.sum(F.when(F.col(VALID_FLAG), 1).otherwise(0)).alias("valid"),
                    _fingerprint(source, ~F.col(VALID_FLAG)).alias("rejected"))
        if direct:
            root = target_root or default_root(spark, target)
            ensure_registered(spark, target, root)
            fitted = (lambda df: df) if by_name else (lambda df: by_position(df, target))
            own = fitted(spark.createDataFrame([], own)).schema
            check_replacement(spark, target, own)
            base = latest_number(spark, root)
            version = new_version_dir(root)
            flagged = source.withColumn(VALID_FLAG, ok)
            if part_cols:
                part_cols, layout = gathered(fitted(source.where(ok).drop(VALID_FLAG, CORRUPT)), part_cols)
                if by_name:
                    flagged = with_hidden(flagged, layout).hint("rebalance", *part_cols)
            else:
                part_cols, layout = layout_for(spark, root, [])
            accepted = fitted(flagged.observe(obs, *counters).where(VALID_FLAG).drop(VALID_FLAG, CORRUPT))
            blank = Observation(f"blank_{run_id}")
            accepted = accepted.observe(blank, F.count_if(needs_escape(accepted, part_cols)).alias("escaped"))
            rows = escaped(with_hidden(accepted, layout), part_cols)
            if "partitioned" in layout:
                rows = rows.sortWithinPartitions(*part_cols, *[col_ref(c) for c in layout["by"]])
            writer = rows.write.mode("errorifexists")
            (writer.partitionBy(*part_cols) if part_cols else writer).parquet(version)
        else:
            staged_rows = source.withColumn(ERRORS_COL, errors_array(active)).withColumn(VALID_FLAG, ok).observe(obs, *counters)
            stage(staged_rows, staging, partition_by=VALID_FLAG)
        got = obs.get
        total = int(got["total"] or 0)
        valid = int(got["valid"] or 0)
        metrics.update(total_count=total, valid_count=valid, invalid_count=total - valid)

        if total == 0:
            log.warning("Source is empty; target %s left untouched.", target)
            metrics["status"] = "empty_source"
            return _finish(spark, metrics, runs_table)

        if direct:
            rejects = None
            if total - valid > 0:
                rejects_path = scratch_path(spark, "rejects", run_id)
                counted = Observation(f"rejects_{run_id}")
                (source.where(~ok).withColumn(ERRORS_COL, errors_array(active))
                 .observe(counted, F.count(F.lit(1)).alias("n"), _fingerprint(source, F.lit(True)).alias("rejected")).write.parquet(rejects_path))
                if int(counted.get["n"]) != total - valid or counted.get["rejected"] != got["rejected"]:
                    raise RuntimeError(f"The source changed during the load: {counted.get['n']} rejects, {total - valid} expected, "
                                       "or as many other ones; nothing was switched")
                rejects = spark.read.parquet(rejects_path)
        else:
            staged = spark.table(staging)
            rejects = staged.filter(~F.col(VALID_FLAG)).drop(VALID_FLAG)
        if total - valid > 0:
            try:
                if dlq_path:
                    metrics["dlq_count"] = write_dlq(rejects, dlq_path, run_date, count=total - valid,
                                                     run_id=run_id if dlq_per_run else None, stream=stream)
                if dlq_table:
                    db, _, t = dlq_table.rpartition(".")
                    append_dlq_table(rejects, db, t, run_date, f"{stream}.{run_id}" if stream else run_id)
                    metrics["dlq_count"] = total - valid
                metrics["dlq_status"] = "written" if (dlq_path or dlq_table) else "no_dlq_configured"
            except Exception as exc:  # rejects are lost, the load goes on
                log.error("Failed to write invalid records to DLQ: %s", exc)
                metrics["dlq_status"] = f"failed: {type(exc).__name__}"

        if valid == 0:
            log.warning("Zero valid records - target %s keeps its rows.", target)
            metrics["status"] = "no_valid_rows"
            return _finish(spark, metrics, runs_table)

        if direct:
            if blank.get["escaped"]:
                layout = {**layout, "escaped": True}
            register_version(spark, target, version, own, part_cols, root=root,
                             keep_versions=keep_versions, base=base, layout=layout)
            registered = version
            metrics["target_version"] = version
            metrics["status"] = "succeeded"
            return _finish(spark, metrics, runs_table)

        accepted = staged.filter(F.col(VALID_FLAG)).drop(VALID_FLAG, ERRORS_COL, CORRUPT)
        if publish is not None:
            metrics["target_version"] = publish(accepted, valid)
            metrics["status"] = "succeeded"
            return _finish(spark, metrics, runs_table)
        out = upsert_target(accepted, target, keys, partition_by=partition_by, root=target_root,
                            keep_versions=keep_versions, order_by=order_by, buckets=buckets, batch=batch)
        metrics["target_version"] = out["version"]
        metrics["status"] = "succeeded"
        return _finish(spark, metrics, runs_table)
    except Exception:
        metrics["status"] = "failed"
        if runs_table:
            try:
                _finish(spark, metrics, runs_table)
            except Exception:  # keep the original error
                log.exception("Could not record the failed run")
        raise
    finally:
        if version is not None and registered is None:
            delete_path(spark, version)  # never switched to: empty, all rejected, or failed
        if rejects_path is not None:
            delete_path(spark, rejects_path)
        try:
            drop_table(spark, staging)
        except Exception:
            log.exception("Failed to drop staging table %s", staging)


def _fingerprint(source: DataFrame, where: Column) -> Column:
    """Sum over the rows that ``where`` selects of a hash of all their fields; it does not depend on their order."""
    cols = [F.to_json(F.struct(col_ref(f.name))) if "map<" in f.dataType.simpleString() else col_ref(f.name)
            for f in source.schema.fields if f.name != VALID_FLAG]
    return F.coalesce(F.sum(F.when(where, F.xxhash64(*cols)).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def jdbc_publisher(url: str, table: str, properties: dict | None = None,
                   **options) -> Callable[[DataFrame, int], str | None]:
    """``publish`` step that replaces a database table over JDBC."""
    from vetline.sinks.jdbc import replace_target_jdbc

    def publish(accepted: DataFrame, valid_count: int) -> str | None:
        replace_target_jdbc(accepted, url, table, properties, expected_count=valid_count, **options)
        return None

    return publish


def _finish(spark: SparkSession, metrics: dict, runs_table: str | None) -> DataFrame:
    row = spark.createDataFrame([tuple(metrics[f.name] for f in METRICS_SCHEMA.fields)], METRICS_SCHEMA)
    if runs_table:
        append_rows(row, runs_table)
    return row
