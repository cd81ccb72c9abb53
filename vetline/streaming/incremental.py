"""Incremental load: each run picks up only the files that arrived since the
last one.

A file stream remembers which files it has consumed in its checkpoint (in the
shared folder), so rerunning the job with ``trigger(availableNow=True)``
processes exactly the new files and stops. Every micro-batch runs the same
validated load as a batch job (stage, validate, dead-letter, switch target).

``foreachBatch`` is at-least-once: a batch interrupted after its write is
replayed with the same id. Here every batch takes effect exactly once:

* the target is upserted by ``keys``, never fully replaced (which would keep
  only the newest batch), and its commit names the batch (stream id, batch id).
  A replayed batch that the target includes is skipped, so it cannot undo what
  later batches, or another stream on the same target, wrote since. Rows whose
  key is null or blank could not be found again, so they are rejected; several
  rows of one key in a batch need ``order_by``, which also makes the result
  the same however files fall into batches;
* rejects go to ``.../day=DD/stream=<id>/run_id=batch<n>/`` with overwrite;
* a batch's run date is fixed when it first runs, so a replay after midnight
  overwrites its own rejects instead of adding a second copy.

Stream id and run dates are kept in the checkpoint (``vetline``). Streams with
checkpoints of their own may share a target, a queue and a runs table: commits
that collide are tried again.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vetline.functions.rules import NOT_NULL, Rule, not_null, read_rules
from vetline.plans.load import METRICS_SCHEMA, load
from vetline.session import delete_path, scratch_path
from vetline.sinks.commits import CommitConflict, filesystem, included_batch, read_text, write_once
from vetline.sinks.tables import default_root
from vetline.sources.files import CORRUPT_OPTIONS, CSV_OPTIONS, with_corrupt

log = logging.getLogger(__name__)


def file_stream(spark: SparkSession, source_dir: str, schema: StructType, fmt: str = "csv",
                max_files_per_trigger: int | None = None, archive_dir: str | None = None,
                keep_malformed: bool = False, **options) -> DataFrame:
    """Streaming file source. A schema is required (no inference on streams);
    ``key=value`` sub-folders are discovered and filled in when the schema
    names them. ``max_files_per_trigger`` splits a large backlog into several
    bounded batches.

    Every trigger lists the whole source tree, so with a growing history of
    hourly folders the listing grows too. ``archive_dir`` moves each file
    out of the source after its batch commits (``cleanSource=archive``),
    keeping the listing to the files not yet processed. ``keep_malformed`` keeps
    the raw text of records that do not fit the schema, for the DLQ.
    """
    if keep_malformed:
        schema, options = with_corrupt(schema), {**CORRUPT_OPTIONS, **options}
    reader = spark.readStream.format(fmt).schema(schema)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if fmt == "csv":
        options = {"header": True, **CSV_OPTIONS, **options}
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(source_dir)


#: Records of batches kept in a checkpoint; a stream replays its last batch only.
_KEPT_BATCHES = 100
#: How often a batch is tried again when another load commits first.
_ATTEMPTS = 5


def _fixed(spark: SparkSession, path: str, text: str) -> str:
    """``text``, or what was fixed under ``path`` before."""
    write_once(spark, path, text)
    return read_text(spark, *filesystem(spark, path))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to, made when it is first asked for."""
    return _fixed(spark, f"{checkpoint.rstrip('/')}/vetline/stream", uuid.uuid4().hex[:16])


def _batch_date(spark: SparkSession, checkpoint: str, batch_id: int, run_date: dt.date | None) -> dt.date:
    """The run date of a batch: the one it had when it first ran."""
    folder = f"{checkpoint.rstrip('/')}/vetline/batches"
    if batch_id >= _KEPT_BATCHES:
        delete_path(spark, f"{folder}/{batch_id - _KEPT_BATCHES}")
    return dt.date.fromisoformat(_fixed(spark, f"{folder}/{batch_id}", (run_date or dt.date.today()).isoformat()))


def _batch_loader(checkpoint, target, rules, keys, dlq_path, run_date, partition_by, runs_table, sink: list | None, order_by=None, buckets=None,
                  dlq_table=None):
    rules = read_rules(rules)
    rules += [not_null(k) for k in keys if not any(r.kind == NOT_NULL and r.column == k for r in rules)]

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream, run_id = stream_id(spark, checkpoint), f"batch{batch_id}"
        if included_batch(spark, default_root(spark, target), stream) >= batch_id:
            log.info("%s includes %s of stream %s already", target, run_id, stream)
            if sink is not None:
                sink.append((run_id, target, "already_loaded", 0, 0, 0, 0, "skipped", 0, None, stream))
            return
        day = _batch_date(spark, checkpoint, batch_id, run_date)
        for attempt in range(_ATTEMPTS):
            try:
                metrics = load(spark, batch, target, rules, dlq_path=dlq_path, run_date=day, run_id=run_id, mode="upsert", keys=list(keys),
                               partition_by=partition_by, runs_table=runs_table, dlq_per_run=True, order_by=order_by, buckets=buckets,
                               dlq_table=dlq_table, batch=(stream, batch_id))
                break
            except CommitConflict:
                if attempt + 1 == _ATTEMPTS:
                    raise
        if sink is not None:
            sink.extend(tuple(r) for r in metrics.collect())  # one row per batch
    return run_batch


def _check(source: DataFrame, keys, mode: str) -> None:
    if mode != "upsert":
        raise ValueError("Incremental loads only upsert by keys: a full replace per batch "
                         "would drop every earlier batch's rows.")
    if not keys:
        raise ValueError("load_incremental needs key columns")
    if not source.isStreaming:
        raise ValueError("source must be a streaming DataFrame (see file_stream)")


def load_incremental(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    rules: Sequence[Rule | Mapping],
    keys: Sequence[str],
    checkpoint: str | None = None,
    dlq_path: str | None = None,
    run_date: dt.date | None = None,
    partition_by: Sequence[str] | str | None = None,
    runs_table: str | None = None,
    mode: str = "upsert",
    order_by: Sequence[str] | str | None = None,
    buckets: int | None = None,
    dlq_table: str | None = None,
) -> DataFrame:
    """Process everything new in ``source`` (a streaming DataFrame) and stop.

    Returns the metrics of the batches run now, one row each (bounded by the
    number of batches, not the data).
    """
    _check(source, keys, mode)
    checkpoint = checkpoint or scratch_path(spark, "stream_checkpoint")
    collected: list[tuple] = []
    query = (source.writeStream
             .foreachBatch(_batch_loader(checkpoint, target, rules, keys, dlq_path, run_date, partition_by,
                                         runs_table, collected, order_by, buckets, dlq_table))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"Incremental load failed: {query.exception()}")
    return spark.createDataFrame(collected, METRICS_SCHEMA)


def start_incremental(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    rules: Sequence[Rule | Mapping],
    keys: Sequence[str],
    checkpoint: str,
    interval: str = "1 hour",
    dlq_path: str | None = None,
    partition_by: Sequence[str] | str | None = None,
    runs_table: str | None = None,
    order_by: Sequence[str] | str | None = None,
    buckets: int | None = None,
    dlq_table: str | None = None,
) -> StreamingQuery:
    """Long-running form: the same validated load every ``interval`` for the
    files that arrived since the last batch. Returns the running query; each
    batch's metrics go to ``runs_table``. The DLQ date is the day on which a
    batch first ran. A restarted query resumes from ``checkpoint``.
    """
    _check(source, keys, "upsert")
    return (source.writeStream
            .foreachBatch(_batch_loader(checkpoint, target, rules, keys, dlq_path, None, partition_by, runs_table, None, order_by, buckets, dlq_table))
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval)
            .start())
