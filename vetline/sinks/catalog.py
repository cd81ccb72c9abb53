"""Parquet tables registered in the catalog, with additive schema evolution."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.functions.checks import col_ref
from vetline.session import shared_root
from vetline.sinks.widening import misfits, widened


def table_name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create ``database`` if missing; by default its managed tables live in
    the shared folder, never on one machine's disk."""
    if spark.catalog.databaseExists(database):
        return
    loc = location or f"{shared_root(spark)}/warehouse/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{loc}'")


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def _ddl(field) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"


def add_missing_columns(spark: SparkSession, name: str, df: DataFrame) -> list[str]:
    """``ALTER TABLE ADD COLUMNS`` for columns of ``df`` the table lacks.

    Existing rows read the new columns as NULL. Returns the added names.
    """
    existing = set(spark.table(name).columns)
    new = [f for f in df.schema.fields if f.name not in existing]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(_ddl(f) for f in new)})")
        spark.catalog.refreshTable(name)
    return [f.name for f in new]


def align_to_table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Columns of ``df`` by name, in the table's order and types; absent ones as NULL.

    Types may only widen (``sinks.widening``); others are refused.
    """
    target = spark.table(name).schema
    df = widened(df, target, name)
    have = set(df.columns)
    cols = [col_ref(f.name).cast(f.dataType).alias(f.name) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
    return df.select(*cols)


def write_table(df: DataFrame, database: str, table: str, path: str | None = None,
                partition_by: Sequence[str] | str | None = None, mode: str = "append",
                compression: str = "snappy", evolve_schema: bool = True,
                max_records_per_file: int | None = None, rebalance: bool = True,
                by_name: bool = True) -> str:
    """Write ``df`` as Parquet and register it as ``database.table``.

    * new table: created (external when ``path`` is given), partitioned by
      ``partition_by`` (the key columns move last; NULL keys land in the
      default partition);
    * existing table, ``append``: columns the table lacks are added first,
      then rows are inserted by name, so schema drift does not shift values;
      types may widen (int into bigint), others are refused before anything is written;
      ``by_name=False`` inserts positionally (``INSERT INTO t SELECT *``),
      without schema evolution.
    Partitioned writes are rebalanced on the keys (one shuffle; AQE splits hot
    keys and merges small ones) so each partition folder gets few files.
    Returns the qualified table name.
    """
    spark = df.sparkSession
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"Partition column(s) {missing} not in the frame's columns {df.columns}")
    ensure_database(spark, database)
    name = table_name(database, table)
    if keys and rebalance:
        df = df.hint("rebalance", *keys)

    if table_exists(spark, database, table) and mode == "append":
        if not by_name:
            if len(df.columns) != len(spark.table(name).columns):
                raise ValueError(f"Positional insert needs {len(spark.table(name).columns)} columns, "
                                 f"got {len(df.columns)}")
            faults = misfits(list(zip(df.schema.fields, spark.table(name).schema.fields)))
            if faults:
                raise ValueError(f"Rows for {name} have other types than it: {', '.join(faults)}")
            df.write.insertInto(name)
            return name
        widened(df, spark.table(name).schema, name)
        if evolve_schema:
            add_missing_columns(spark, name, df)
        writer = align_to_table(spark, name, df).write
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        writer.insertInto(name)
        return name

    writer = df.write.format("parquet").option("compression", compression)
    if path:
        writer = writer.option("path", path)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.mode(mode).saveAsTable(name)
    return name
