"""Readers for the driver's parquet tables and the derived validation fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with injected NULL, empty, blank and non-numeric values.

    The driver tables hold no null or blank value, so validating them raw
    exercises nothing; this deterministic rewrite (same in the DuckDB oracle)
    gives every rule something to catch. Columns: o_orderkey, vendor_id,
    pickup_datetime.
    """
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 10
    cust = F.col("o_custkey").cast("string")
    vendor = (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.lit(""))
        .when(k == 2, F.lit("   "))
        .when(k == 3, F.concat(F.lit("v"), cust))
        .otherwise(cust)
    )
    pickup = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderdate"))
    return o.select("o_orderkey", vendor.alias("vendor_id"), pickup.alias("pickup_datetime"))


DIRTY_ORDERS_SQL = """
SELECT o_orderkey,
  CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
       WHEN 3 THEN 'v' || CAST(o_custkey AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) END AS vendor_id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS pickup_datetime
FROM orders
"""

# The job's default rule set, in order.
DEFAULT_RULES = (
    {"rule_type": "not_null", "column": "vendor_id"},
    {"rule_type": "not_null", "column": "pickup_datetime"},
    {"rule_type": "regex", "column": "vendor_id", "pattern": r"^\d+$"},
)
