"""File-to-catalog ingest: CSV or JSON files into a Parquet catalog table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from vetline.functions.checks import ERRORS_COL, any_failure, errors_array, is_valid
from vetline.functions.rules import well_formed
from vetline.sinks.catalog import write_table
from vetline.sinks.dlq import write_dlq
from vetline.sources.files import CORRUPT, read_auto

# --- fixed values ------------------------------------------------------------------
# Job parameters: source_path, target_path, catalog_database, catalog_table_name
# (required) and partition_key (optional, None when absent).
REQUIRED_PARAMS = ("source_path", "target_path", "catalog_database", "catalog_table_name")
OPTIONAL_PARAMS = ("partition_key",)
# -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class IngestParams:
    source_path: str
    target_path: str
    catalog_database: str
    catalog_table_name: str
    partition_key: str | None = None

    @classmethod
    def from_args(cls, argv: Sequence[str]) -> "IngestParams":
        """Read ``--name value`` or ``--name=value`` in any order; names must be exact, others are ignored.

        A required parameter that is absent, or one without a value, raises
        ``ValueError`` naming it.
        """
        given: dict[str, str] = {}
        words = iter(argv)
        for word in words:
            name, joined, value = word.removeprefix("--").partition("=")
            if not word.startswith("--") or name not in REQUIRED_PARAMS + OPTIONAL_PARAMS:
                continue  # other jobs' arguments, and their values
            if not joined:
                value = next(words, None)
                if value is None or value.startswith("--"):
                    raise ValueError(f"--{name} has no value")
            given[name] = value
        absent = [name for name in REQUIRED_PARAMS if name not in given]
        if absent:
            raise ValueError(f"Parameters not given: {', '.join(absent)}")
        return cls(**given)


def ingest(spark: SparkSession, source_path: str, target_path: str, catalog_database: str,
           catalog_table_name: str, partition_key: str | None = None, schema=None,
           mode: str = "append", dlq_path: str | None = None, run_date: dt.date | None = None,
           run_id: str | None = None, **read_options) -> DataFrame:
    """Read ``source_path`` (format from its extension), write snappy Parquet
    at ``target_path`` and register ``catalog_database.catalog_table_name``.

    Give ``schema`` for large JSON input (otherwise the reader samples it to
    infer types; ``samplingRatio`` bounds that). With ``dlq_path`` records
    that do not fit the schema go there, with their raw text, instead of into
    the table; the files are read a second time only if there are any. Returns
    the catalog table as a DataFrame.
    """
    df = read_auto(spark, source_path, schema=schema, keep_malformed=dlq_path is not None, **read_options)
    if dlq_path is not None:
        df, malformed = split_malformed(df)
        write_dlq(malformed, dlq_path, run_date, run_id=run_id)
    name = write_table(df, catalog_database, catalog_table_name, path=target_path,
                       partition_by=partition_key, mode=mode)
    return spark.table(name)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, malformed ones with their error array) of a frame that was read with ``keep_malformed``."""
    rule = [well_formed(CORRUPT)]
    return df.where(is_valid(rule)).drop(CORRUPT), df.where(any_failure(rule)).withColumn(ERRORS_COL, errors_array(rule))


def run(spark: SparkSession, argv: Sequence[str]) -> DataFrame:
    p = IngestParams.from_args(argv)
    return ingest(spark, p.source_path, p.target_path, p.catalog_database, p.catalog_table_name,
                  p.partition_key)
