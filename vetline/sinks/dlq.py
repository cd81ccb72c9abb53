"""Dead-letter queue for rejected rows.

Rejected rows are written as JSON lines, original fields plus the error array,
under ``<base>/year=YYYY/month=MM/day=DD/``. Null fields are written as
``null`` rather than dropped, so each record keeps every original field.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from vetline.sinks.catalog import table_exists, table_name, write_table
from vetline.sources.files import CORRUPT

log = logging.getLogger(__name__)

# --- fixed values ---------------------------------------------------------------
# DLQ directory: <base without trailing slash>/year=YYYY/month=MM/day=DD/
DLQ_PARTITIONS = ("year", "month", "day")
# ---------------------------------------------------------------------------------
#: Partitions of a DLQ table.
DLQ_TABLE_PARTITIONS = ("run_date", "run_id")
#: The DLQ's field for the raw text of a malformed record.
RAW_RECORD = "raw_record"


def dlq_path(base: str, run_date: dt.date, run_id: str | None = None, stream: str | None = None) -> str:
    """Partitioned DLQ folder for ``run_date`` (and optionally one stream, one run)."""
    path = f"{base.rstrip('/')}/year={run_date.year:04d}/month={run_date.month:02d}/day={run_date.day:02d}/"
    if stream is not None:
        path += f"stream={stream}/"
    if run_id is not None:
        path += f"run_id={run_id}/"
    return path


def _rename_path_columns(df: DataFrame, extra: tuple[str, ...]) -> DataFrame:
    """Columns named like a partition directory would be shadowed by the
    path value on read-back; keep them under ``src_<name>``. The raw text of a
    malformed record goes into ``raw_record``: JSON readers fill a field of the
    reader's own name themselves."""
    out = df
    malformed = (RAW_RECORD,) if CORRUPT in df.columns else ()
    for c in DLQ_PARTITIONS + extra + malformed:
        if c in out.columns:
            out = out.withColumnRenamed(c, f"src_{c}")
    return out.withColumnRenamed(CORRUPT, RAW_RECORD)


def write_dlq(invalid: DataFrame, base: str, run_date: dt.date | None = None,
              run_id: str | None = None, mode: str = "overwrite", count: int | None = None,
              stream: str | None = None) -> int:
    """Write rejected rows for one day; return how many were written.

    With no rows nothing is written (an earlier run's rejects stay). Pass
    ``count`` when it is already known (e.g. from the load's counters).
    Otherwise emptiness is probed for one whole row (which stops at the
    first reject) and the count is observed during the write itself, so the
    rejects are computed once, not counted and then recomputed.
    ``mode='overwrite'`` replaces the day's (or, with ``run_id``, the run's)
    folder, so rerunning a run is idempotent. Runs are numbered within a stream:
    streams that share a queue give their id.
    """
    run_date = run_date or dt.date.today()
    if count is not None and int(count) == 0 or count is None and not invalid.head(1):
        log.info("Nothing was rejected; the DLQ is left as it is.")
        return 0
    path = dlq_path(base, run_date, run_id, stream)
    extra = tuple(c for c, v in (("stream", stream), ("run_id", run_id)) if v is not None)
    rows = _rename_path_columns(invalid, extra)
    obs = None
    if count is None:
        obs = Observation(f"dlq_{uuid.uuid4().hex[:8]}")
        rows = rows.observe(obs, F.count(F.lit(1)).alias("n"))
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)
    n = int(count) if obs is None else int(obs.get["n"])
    log.info("Wrote %d records to DLQ path %s", n, path)
    return n


def dlq_schema(invalid: DataFrame, run_id: bool = False) -> StructType:
    """Schema of the DLQ records written for ``invalid`` (after the renames of
    ``write_dlq``), with the partition columns as integers. Reading with it
    skips JSON inference, which would otherwise scan the whole queue."""
    extra = ("run_id",) if run_id else ()
    fields = [f for f in _rename_path_columns(invalid, extra).schema.fields]
    parts = [StructField(c, IntegerType(), True) for c in DLQ_PARTITIONS]
    if run_id:
        parts.append(StructField("run_id", StringType(), True))
    return StructType(fields + parts)


def read_dlq(spark, base: str, schema=None) -> DataFrame:
    """Read the whole DLQ back; ``year/month/day`` come from the folders.

    Give ``schema`` for large queues: without it the JSON is sampled to infer
    types. Struct fields come back in alphabetical order: select by name.
    """
    reader = spark.read.option("basePath", base.rstrip("/"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(base.rstrip("/"))


def append_dlq_table(invalid: DataFrame, database: str, table: str, run_date: dt.date,
                     run_id: str) -> str:
    """Put a run's rejected rows into a catalog table partitioned by ``run_date`` and ``run_id``.

    A run replaces its own partition, so running it again leaves one copy. One
    run writes one partition value, so there is nothing to rebalance: each
    task writes its rows into that folder without a shuffle. A table that is
    partitioned otherwise (by ``run_date`` alone) is appended to.
    """
    spark = invalid.sparkSession
    rows = _rename_path_columns(invalid, DLQ_TABLE_PARTITIONS).withColumn("run_id", F.lit(run_id)).withColumn("run_date", F.lit(run_date))
    parts: Sequence[str] = DLQ_TABLE_PARTITIONS
    if table_exists(spark, database, table):
        parts = [c.name for c in spark.catalog.listColumns(f"{database}.{table}") if c.isPartition]
        if set(parts) == set(DLQ_TABLE_PARTITIONS):
            own = run_id.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table_name(database, table)} DROP IF EXISTS PARTITION (run_date = DATE '{run_date}', run_id = '{own}')")
        else:
            log.warning("%s.%s is not partitioned by run: rejects of a run that is repeated appear twice", database, table)
    return write_table(rows, database, table, partition_by=parts, mode="append", rebalance=False)
