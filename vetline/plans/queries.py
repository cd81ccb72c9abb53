"""Registered queries: each reads the driver tables and returns a DataFrame.

Every entry has a DuckDB oracle in ``ORACLE_SQL`` with identical column names
(unless the operation cannot be written in SQL, which is then stated).
Queries that exercise sinks write under the session's shared folder and
return what they read back, so the check covers the write *and* the read.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetline.functions.checks import ERRORS_COL
from vetline.operators.validate import (
    errors_by_rule,
    errors_long,
    explode_errors,
    load_counts,
    rule_counts,
    split_valid_invalid,
    validate,
    validate_split,
)
from vetline.sources.tables import DEFAULT_RULES, DIRTY_ORDERS_SQL, dirty_orders, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _with_dirty(sql: str) -> str:
    return f"WITH dirty_orders AS ({DIRTY_ORDERS_SQL})\n{sql}"


# Oracle fragments: one SELECT per default rule, in rule order.
_NN_VENDOR = "(vendor_id IS NULL OR trim(vendor_id) = '')"
_NN_PICKUP = "(pickup_datetime IS NULL OR trim(CAST(pickup_datetime AS VARCHAR)) = '')"
_RX_VENDOR = "(vendor_id IS NULL OR NOT regexp_matches(vendor_id, '^\\d+$'))"
_ANY_FAIL = f"({_NN_VENDOR} OR {_NN_PICKUP} OR {_RX_VENDOR})"
_ERRORS_BODY = f"""
SELECT o_orderkey, 'not_null_vendor_id' AS rule_name, 'vendor_id' AS "column", vendor_id AS value
FROM dirty_orders WHERE {_NN_VENDOR}
UNION ALL
SELECT o_orderkey, 'not_null_pickup_datetime', 'pickup_datetime', CAST(pickup_datetime AS VARCHAR)
FROM dirty_orders WHERE {_NN_PICKUP}
UNION ALL
SELECT o_orderkey, 'regex_vendor_id', 'vendor_id', vendor_id
FROM dirty_orders WHERE {_RX_VENDOR}
"""
_ERRORS_EXPLODED_SQL = _with_dirty(_ERRORS_BODY)
_SPLIT_VALID_SQL = _with_dirty(
    f"SELECT o_orderkey, vendor_id, pickup_datetime FROM dirty_orders WHERE NOT {_ANY_FAIL}"
)


# --- V5 / V6: single rules ---------------------------------------------------

@register("validate_not_null", _with_dirty(f"""
SELECT o_orderkey, 'not_null_vendor_id' AS rule_name, 'vendor_id' AS "column", vendor_id AS value
FROM dirty_orders WHERE {_NN_VENDOR}
"""))
def validate_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(dirty_orders(spark, sf_dir), [{"rule_type": "not_null", "column": "vendor_id"}])
    return explode_errors(v, ["o_orderkey"])


@register("validate_regex", _with_dirty(f"""
SELECT o_orderkey, 'regex_vendor_id' AS rule_name, 'vendor_id' AS "column", vendor_id AS value
FROM dirty_orders WHERE {_RX_VENDOR}
"""))
def validate_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"rule_type": "regex", "column": "vendor_id", "pattern": r"^\d+$"}]
    return explode_errors(validate(dirty_orders(spark, sf_dir), rules), ["o_orderkey"])


# --- V4 / V7: the error array ----------------------------------------------

@register("errors_exploded", _ERRORS_EXPLODED_SQL)
def errors_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors_long(dirty_orders(spark, sf_dir), list(DEFAULT_RULES), ["o_orderkey"])


@register("errors_exploded_from_array", _ERRORS_EXPLODED_SQL)
def errors_exploded_from_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(dirty_orders(spark, sf_dir), list(DEFAULT_RULES))
    return explode_errors(v, ["o_orderkey"])


@register("errors_ordered", _with_dirty(f"""
SELECT o_orderkey, 0 AS pos, 'not_null_vendor_id' AS rule_name FROM dirty_orders WHERE {_NN_VENDOR}
UNION ALL
SELECT o_orderkey, CAST({_NN_VENDOR} AS INTEGER), 'not_null_pickup_datetime'
FROM dirty_orders WHERE {_NN_PICKUP}
UNION ALL
SELECT o_orderkey, CAST({_NN_VENDOR} AS INTEGER) + CAST({_NN_PICKUP} AS INTEGER), 'regex_vendor_id'
FROM dirty_orders WHERE {_RX_VENDOR}
"""))
def errors_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(dirty_orders(spark, sf_dir), list(DEFAULT_RULES))
    return explode_errors(v, ["o_orderkey"], with_position=True).select("o_orderkey", "pos", "rule_name")


# --- V11: split ----------------------------------------------------------------

@register("split_valid", _SPLIT_VALID_SQL)
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_invalid(validate(dirty_orders(spark, sf_dir), list(DEFAULT_RULES)))
    return valid


@register("split_invalid", _with_dirty(f"""
SELECT o_orderkey, vendor_id,
  CAST({_NN_VENDOR} AS INTEGER) + CAST({_NN_PICKUP} AS INTEGER) + CAST({_RX_VENDOR} AS INTEGER) AS n_errors
FROM dirty_orders WHERE {_ANY_FAIL}
"""))
def split_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = split_valid_invalid(validate(dirty_orders(spark, sf_dir), list(DEFAULT_RULES)))
    return invalid.select("o_orderkey", "vendor_id", F.size(ERRORS_COL).alias("n_errors"))


@register("split_fast_valid", _SPLIT_VALID_SQL)
def split_fast_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = validate_split(dirty_orders(spark, sf_dir), list(DEFAULT_RULES))
    return valid


@register("split_fast_invalid", _ERRORS_EXPLODED_SQL)
def split_fast_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = validate_split(dirty_orders(spark, sf_dir), list(DEFAULT_RULES))
    return explode_errors(invalid, ["o_orderkey"])


# --- reports and counts (A1-A3) ------------------------------------------------

@register("errors_by_rule", _with_dirty(f"""
SELECT rule_name, "column", count(*) AS n_errors FROM (
  SELECT 'not_null_vendor_id' AS rule_name, 'vendor_id' AS "column" FROM dirty_orders WHERE {_NN_VENDOR}
  UNION ALL
  SELECT 'not_null_pickup_datetime', 'pickup_datetime' FROM dirty_orders WHERE {_NN_PICKUP}
  UNION ALL
  SELECT 'regex_vendor_id', 'vendor_id' FROM dirty_orders WHERE {_RX_VENDOR}
) GROUP BY rule_name, "column"
"""))
def errors_by_rule_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors_by_rule(validate(dirty_orders(spark, sf_dir), list(DEFAULT_RULES)))


@register("load_metrics", _with_dirty(f"""
SELECT count(*) AS total_count,
       count(*) FILTER (WHERE NOT {_ANY_FAIL}) AS valid_count,
       count(*) FILTER (WHERE {_ANY_FAIL}) AS invalid_count
FROM dirty_orders
"""))
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_counts(validate(dirty_orders(spark, sf_dir), list(DEFAULT_RULES)))


# --- V8 / V10: skipped rules ------------------------------------------------------

@register("rule_missing_column", _with_dirty(
    "SELECT o_orderkey, vendor_id, 0 AS n_errors FROM dirty_orders"))
def rule_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"rule_type": "not_null", "column": "col_missing"},
             {"rule_type": "regex", "column": "VENDOR_ID", "pattern": "^x$"}]
    v = validate(dirty_orders(spark, sf_dir), rules)
    return v.select("o_orderkey", "vendor_id", F.size(ERRORS_COL).alias("n_errors"))


@register("rules_empty", _with_dirty(
    "SELECT o_orderkey, vendor_id, 0 AS n_errors FROM dirty_orders"))
def rules_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(dirty_orders(spark, sf_dir), [])
    return v.select("o_orderkey", "vendor_id", F.size(ERRORS_COL).alias("n_errors"))


# --- rules on typed columns of a large table (cast to string first) ----------------

LINEITEM_RULES = (
    {"rule_type": "not_null", "column": "l_shipdate"},
    {"rule_type": "regex", "column": "l_returnflag", "pattern": "^[AR]$"},
    {"rule_type": "regex", "column": "l_linestatus", "pattern": "O"},
    {"rule_type": "regex", "column": "l_linenumber", "pattern": "^[1-3]$"},
    {"rule_type": "not_null", "column": "l_comment"},
)


@register("lineitem_errors_by_rule", """
SELECT rule_name, "column", count(*) AS n_errors FROM (
  SELECT 'regex_l_returnflag' AS rule_name, 'l_returnflag' AS "column" FROM lineitem
  WHERE l_returnflag IS NULL OR NOT regexp_matches(l_returnflag, '^[AR]$')
  UNION ALL
  SELECT 'regex_l_linestatus', 'l_linestatus' FROM lineitem
  WHERE l_linestatus IS NULL OR NOT regexp_matches(l_linestatus, 'O')
  UNION ALL
  SELECT 'regex_l_linenumber', 'l_linenumber' FROM lineitem
  WHERE l_linenumber IS NULL OR NOT regexp_matches(CAST(l_linenumber AS VARCHAR), '^[1-3]$')
  UNION ALL
  SELECT 'not_null_l_shipdate', 'l_shipdate' FROM lineitem
  WHERE l_shipdate IS NULL OR trim(CAST(l_shipdate AS VARCHAR)) = ''
) GROUP BY rule_name, "column"
""")
def lineitem_errors_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    # l_comment does not exist: that rule is skipped (V8).
    return rule_counts(read_table(spark, sf_dir, "lineitem"), list(LINEITEM_RULES))[1]


@register("lineitem_load_metrics", """
SELECT count(*) AS total_count,
  count(*) FILTER (WHERE NOT (l_shipdate IS NULL
      OR l_returnflag IS NULL OR NOT regexp_matches(l_returnflag, '^[AR]$')
      OR l_linestatus IS NULL OR NOT regexp_matches(l_linestatus, 'O')
      OR l_linenumber IS NULL OR NOT regexp_matches(CAST(l_linenumber AS VARCHAR), '^[1-3]$'))) AS valid_count,
  count(*) FILTER (WHERE (l_shipdate IS NULL
      OR l_returnflag IS NULL OR NOT regexp_matches(l_returnflag, '^[AR]$')
      OR l_linestatus IS NULL OR NOT regexp_matches(l_linestatus, 'O')
      OR l_linenumber IS NULL OR NOT regexp_matches(CAST(l_linenumber AS VARCHAR), '^[1-3]$'))) AS invalid_count
FROM lineitem
""")
def lineitem_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts(read_table(spark, sf_dir, "lineitem"), list(LINEITEM_RULES))[0]


@register("lineitem_errors_by_rule_exploded", ORACLE_SQL["lineitem_errors_by_rule"])
def lineitem_errors_by_rule_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors_by_rule(validate(read_table(spark, sf_dir, "lineitem"), list(LINEITEM_RULES)))


@register("part_regex_errors", """
SELECT p_partkey, rule_name, "column", value FROM (
  SELECT p_partkey, 'regex_p_brand' AS rule_name, 'p_brand' AS "column", p_brand AS value FROM part
  WHERE p_brand IS NULL OR NOT regexp_matches(p_brand, '^Brand#[0-9]$')
  UNION ALL
  SELECT p_partkey, 'size_two_digits', 'p_size', CAST(p_size AS VARCHAR) FROM part
  WHERE p_size IS NULL OR NOT regexp_matches(CAST(p_size AS VARCHAR), '^\\d{2}$')
  UNION ALL
  SELECT p_partkey, 'regex_p_name', 'p_name', p_name FROM part
  WHERE p_name IS NULL OR NOT regexp_matches(p_name, '^[a-z]+ [a-z]+$')
)
""")
def part_regex_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"rule_type": "regex", "column": "p_brand", "pattern": "^Brand#[0-9]$"},
        {"rule_type": "regex", "column": "p_size", "pattern": r"^\d{2}$", "rule_name": "size_two_digits"},
        {"rule_type": "regex", "column": "p_name", "pattern": "^[a-z]+ [a-z]+$"},
    ]
    return explode_errors(validate(read_table(spark, sf_dir, "part"), rules), ["p_partkey"])


# --- J1: lookup right join, V12: dataset rule -----------------------------------

from vetline.operators.enrich import lookup_right_join  # noqa: E402
from vetline.operators.quality import column_count_check  # noqa: E402

_DOC_JOIN_SQL = """
SELECT l.doc_id AS lookup_doc_id, l.quality, l.toxic, d.doc_id, d.text, d.lang, d.source, d.n_chars
FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id
"""


def _doc_join(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return lookup_right_join(read_table(spark, sf_dir, "labels"), read_table(spark, sf_dir, "documents"),
                             "doc_id", **kw)


@register("lookup_right_join", _DOC_JOIN_SQL)
def lookup_right_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_join(spark, sf_dir)


@register("lookup_right_join_filtered", """
SELECT n.n_nationkey, n.n_name, n.n_regionkey, c.*
FROM (SELECT * FROM nation WHERE n_regionkey = 0) n RIGHT JOIN customer c ON n.n_nationkey = c.c_nationkey
""")
def lookup_right_join_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read_table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 0)
    return lookup_right_join(nations, read_table(spark, sf_dir, "customer"), "n_nationkey",
                             records_key="c_nationkey")


_FANOUT_SQL = """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_name, c.c_mktsegment
FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey
"""


def _fanout(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return lookup_right_join(orders, customers, "o_custkey", records_key="c_custkey", **kw)


@register("lookup_right_join_fanout", _FANOUT_SQL)
def lookup_right_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fanout(spark, sf_dir)


@register("lookup_right_join_salted", _FANOUT_SQL)
def lookup_right_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Salting applies to the shuffle join; a broadcast lookup needs none.
    return _fanout(spark, sf_dir, salt_buckets=8, broadcast=False)


@register("lookup_right_join_merge", _FANOUT_SQL)
def lookup_right_join_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fanout(spark, sf_dir, broadcast=False)


@register("lookup_right_join_broadcast", """
SELECT n.n_nationkey, n.n_name, n.n_regionkey, c.c_custkey, c.c_nationkey, c.c_mktsegment
FROM nation n RIGHT JOIN customer c ON n.n_nationkey = c.c_nationkey
""")
def lookup_right_join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return lookup_right_join(read_table(spark, sf_dir, "nation"), customers, "n_nationkey",
                             records_key="c_nationkey", broadcast=True, max_broadcast_rows=10_000)


@register("dq_column_count", f"""
SELECT 'ColumnCount > 0' AS rule, 'Passed' AS outcome, 'ColumnCount' AS metric_name,
       CAST(8.0 AS DOUBLE) AS metric_value, count(*) AS row_count
FROM ({_DOC_JOIN_SQL})
""")
def dq_column_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_count_check(_doc_join(spark, sf_dir))


# --- sources and sinks: write, then read back what was written ---------------------

import datetime as _dt  # noqa: E402

from vetline.plans.enrich_job import enrich  # noqa: E402
from vetline.plans.ingest import ingest  # noqa: E402
from vetline.plans.load import load  # noqa: E402
from vetline.session import scratch_path, unique_name  # noqa: E402
from vetline.sinks.catalog import write_table  # noqa: E402
from vetline.sinks.dlq import append_dlq_table, dlq_schema, read_dlq, write_dlq  # noqa: E402
from vetline.sinks.files import write_hourly  # noqa: E402
from vetline.sinks.tables import replace_target, stage, truncate_table  # noqa: E402
from vetline.sources.files import read_auto, read_csv, read_partitioned  # noqa: E402

QDB = "vetline_q"
RUN_DATE = _dt.date(2024, 1, 15)


def _orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
                    F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")


@register("csv_roundtrip", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv_roundtrip") + "/orders.csv"
    _orders_text(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path)  # no schema: every column comes back as text


@register("json_roundtrip", "SELECT * FROM documents")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "json_roundtrip") + "/documents.JSON"
    docs.write.json(path)
    return read_auto(spark, path, schema=docs.schema)


_HOURLY_SQL = """
SELECT event_id, ts, user_id, event_type, props,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
FROM events WHERE strftime(ts, '%d') = '05' AND strftime(ts, '%H') < '12'
"""
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@register("hour_partition_pruned", _HOURLY_SQL)
def hour_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    root = scratch_path(spark, "hourly")
    write_hourly(ev, "ts", root, timestampNTZFormat=_MICROS)
    back = read_partitioned(spark, root, "csv", schema=ev.schema,
                            partition_columns=["year", "month", "day", "hour"], timestampNTZFormat=_MICROS)
    return back.filter((F.col("day") == "05") & (F.col("hour") < "12"))


_CUSTOMER_JSON_SQL = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
"""


_CUSTOMER_JSON = "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string"


def _customer_source(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    path = scratch_path(spark, "ingest_src") + f"/customer.{fmt}"
    writer = read_table(spark, sf_dir, "customer").write
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path))
    return path


@register("catalog_ingest", _CUSTOMER_JSON_SQL)
def catalog_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _customer_source(spark, sf_dir, "json")
    return ingest(spark, src, scratch_path(spark, "ingest_out"), QDB, unique_name("customer"), schema=_CUSTOMER_JSON)


@register("catalog_ingest_partitioned", _CUSTOMER_JSON_SQL)
def catalog_ingest_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _customer_source(spark, sf_dir, "json")
    return ingest(spark, src, scratch_path(spark, "ingest_out"), QDB, unique_name("customer_p"),
                  partition_key="c_mktsegment", schema=_CUSTOMER_JSON)


@register("catalog_ingest_csv", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer
""")
def catalog_ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _customer_source(spark, sf_dir, "csv")
    return ingest(spark, src, scratch_path(spark, "ingest_out"), QDB, unique_name("customer_csv"))


@register("catalog_schema_evolution", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def catalog_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    t = unique_name("orders_evo")
    first = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderstatus")
    rest = o.filter(F.col("o_orderstatus") != "F").select(
        "o_orderpriority", "o_orderstatus", "o_custkey", "o_orderkey")  # other order, new column
    write_table(first, QDB, t, path=scratch_path(spark, "evo"))
    name = write_table(rest, QDB, t)
    return spark.table(name)


@register("enrich_to_catalog", _DOC_JOIN_SQL)
def enrich_to_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = unique_name("doc_join")
    enrich(spark, read_table(spark, sf_dir, "labels"), read_table(spark, sf_dir, "documents"), "doc_id",
           QDB, t, path=scratch_path(spark, "enrich"), dq_results_table=f"{QDB}.{unique_name('dq')}")
    return spark.table(f"{QDB}.{t}")


# --- dead-letter queue (K10-K12) --------------------------------------------------------

@register("dlq_readback", _with_dirty(f"""
SELECT o_orderkey, rule_name, "column", value, 2024 AS year, 1 AS month, 15 AS day FROM ({_ERRORS_BODY}) e
"""))
def dlq_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "dlq")
    _, invalid = validate_split(dirty_orders(spark, sf_dir), list(DEFAULT_RULES))
    write_dlq(invalid, base, RUN_DATE)
    back = read_dlq(spark, base, schema=dlq_schema(invalid))
    return back.select("o_orderkey", "year", "month", "day", F.inline(ERRORS_COL)).select(
        "o_orderkey", "rule_name", "column", "value", "year", "month", "day")


@register("dlq_same_day_rerun", _with_dirty("""
SELECT o_orderkey, 'not_null_pickup_datetime' AS rule_name FROM dirty_orders WHERE pickup_datetime IS NULL
"""))
def dlq_same_day_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "dlq")
    src = dirty_orders(spark, sf_dir)
    _, first = validate_split(src, list(DEFAULT_RULES))
    write_dlq(first, base, RUN_DATE)
    _, second = validate_split(src, [{"rule_type": "not_null", "column": "pickup_datetime"}])
    write_dlq(second, base, RUN_DATE)  # same day: replaces the first run's rejects
    back = read_dlq(spark, base, schema=dlq_schema(second))
    return back.select("o_orderkey", F.inline(ERRORS_COL)).select("o_orderkey", "rule_name")


@register("dlq_table_append", _with_dirty(f"""
SELECT 'r1' AS run_id, o_orderkey, rule_name FROM ({_ERRORS_BODY}) a
UNION ALL
SELECT 'r2', o_orderkey, rule_name FROM ({_ERRORS_BODY}) b
"""))
def dlq_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = unique_name("dlq")
    _, invalid = validate_split(dirty_orders(spark, sf_dir), list(DEFAULT_RULES))
    append_dlq_table(invalid, QDB, t, RUN_DATE, "r1")
    append_dlq_table(invalid, QDB, t, RUN_DATE, "r2")
    back = spark.table(f"{QDB}.{t}")
    return back.select("run_id", "o_orderkey", F.inline(ERRORS_COL)).select("run_id", "o_orderkey", "rule_name")


# --- staged load, replace, upsert (K4-K9, K13-K15, C1-C5) ------------------------------

from vetline.sinks.tables import recreate_like  # noqa: E402

_LOAD_COLS = "o_orderkey, vendor_id, pickup_datetime"


def _target(spark: SparkSession, prefix: str) -> str:
    return f"{QDB}.{unique_name(prefix)}"


def _seed_target(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    """First version of a target: the orders still open, with their vendor."""
    seed = dirty_orders(spark, sf_dir).join(
        read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O").select("o_orderkey"),
        "o_orderkey")
    replace_target(seed, target)
    return seed


@register("replace_target", _SPLIT_VALID_SQL)
def replace_target_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "orders_clean")
    _seed_target(spark, sf_dir, target)
    load(spark, dirty_orders(spark, sf_dir), target, list(DEFAULT_RULES),
         dlq_path=scratch_path(spark, "load_dlq"), run_date=RUN_DATE)
    return spark.table(target)


@register("load_dlq", _with_dirty(f"""
SELECT o_orderkey, rule_name, "column", value FROM ({_ERRORS_BODY}) e
"""))
def load_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, dlq = _target(spark, "orders_clean"), scratch_path(spark, "load_dlq")
    load(spark, dirty_orders(spark, sf_dir), target, list(DEFAULT_RULES), dlq_path=dlq, run_date=RUN_DATE)
    return read_dlq(spark, dlq).select("o_orderkey", F.inline(ERRORS_COL)).select(
        "o_orderkey", "rule_name", "column", "value")


_SEED_SQL = _with_dirty(f"""
SELECT d.o_orderkey, d.vendor_id, d.pickup_datetime FROM dirty_orders d
JOIN orders o ON d.o_orderkey = o.o_orderkey WHERE o.o_orderstatus = 'O'
""")


@register("replace_skipped_when_no_valid", _SEED_SQL)
def replace_skipped_when_no_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "orders_keep")
    _seed_target(spark, sf_dir, target)
    never = [{"rule_type": "regex", "column": "vendor_id", "pattern": "^never$"}]
    load(spark, dirty_orders(spark, sf_dir), target, never, dlq_path=scratch_path(spark, "load_dlq"),
         run_date=RUN_DATE)
    return spark.table(target)


@register("empty_source_noop", _SEED_SQL)
def empty_source_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "orders_keep")
    _seed_target(spark, sf_dir, target)
    empty = dirty_orders(spark, sf_dir).filter(F.col("o_orderkey") < 0)
    load(spark, empty, target, list(DEFAULT_RULES), dlq_path=scratch_path(spark, "load_dlq"),
         run_date=RUN_DATE)
    return spark.table(target)


@register("replace_partitioned", _with_dirty(f"""
SELECT o_orderkey, vendor_id, pickup_datetime, strftime(pickup_datetime, '%Y') AS pickup_year
FROM dirty_orders WHERE NOT {_ANY_FAIL}
"""))
def replace_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "orders_by_year")
    src = dirty_orders(spark, sf_dir).withColumn("pickup_year", F.date_format("pickup_datetime", "yyyy"))
    for _ in range(2):  # the second run replaces the first version through the view
        load(spark, src, target, list(DEFAULT_RULES), partition_by="pickup_year",
             dlq_path=scratch_path(spark, "load_dlq"), run_date=RUN_DATE)
    return spark.table(target)


_UPSERT_SQL = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus, round(o_totalprice * 2, 2) FROM orders WHERE o_orderstatus IN ('O', 'P')
"""


@register("upsert_target", _UPSERT_SQL)
def upsert_target_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = _target(spark, "orders_upsert")
    replace_target(o.filter(F.col("o_orderstatus").isin("F", "O")), target)
    updates = o.filter(F.col("o_orderstatus").isin("O", "P")).withColumn(
        "o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    rules = [{"rule_type": "regex", "column": "o_orderstatus", "pattern": "^[FOP]$"}]
    load(spark, updates, target, rules, mode="upsert", keys=["o_orderkey"])
    return spark.table(target)


_COUNTS_SQL = f"""
count(*) AS total_count,
count(*) FILTER (WHERE NOT {_ANY_FAIL}) AS valid_count,
count(*) FILTER (WHERE {_ANY_FAIL}) AS invalid_count
"""


@register("run_metadata", _with_dirty(f"""
SELECT 'succeeded' AS status, {_COUNTS_SQL},
       count(*) FILTER (WHERE {_ANY_FAIL}) AS dlq_count, 'written' AS dlq_status, CAST(0 AS BIGINT) AS rules_skipped
FROM dirty_orders
"""))
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _target(spark, "job_runs")
    load(spark, dirty_orders(spark, sf_dir), _target(spark, "orders_clean"), list(DEFAULT_RULES),
         dlq_path=scratch_path(spark, "load_dlq"), run_date=RUN_DATE, runs_table=runs)
    return spark.table(runs).select("status", "total_count", "valid_count", "invalid_count",
                                    "dlq_count", "dlq_status", "rules_skipped")


@register("truncate_staging", """
SELECT count(*) AS staged_rows, CAST(0 AS BIGINT) AS rows_after_truncate,
       CAST(0 AS BIGINT) AS rows_after_recreate FROM orders
""")
def truncate_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    staging, target = _target(spark, "stg"), _target(spark, "orders_t")
    replace_target(o, target)
    stage(o, staging)
    staged = spark.table(staging).count()
    truncate_table(spark, staging)
    after_truncate = spark.table(staging).count()
    stage(o, staging)
    recreate_like(spark, staging, target)
    after_recreate = spark.table(staging).count()
    return o.agg(F.count(F.lit(1)).alias("staged_rows")).select(
        "staged_rows",
        F.lit(after_truncate).cast("long").alias("rows_after_truncate"),
        F.lit(after_recreate).cast("long").alias("rows_after_recreate"),
    ).filter(F.col("staged_rows") == F.lit(staged))


# --- incremental load (S6): a file stream run twice, once per drop ----------------------

from vetline.streaming.incremental import file_stream, load_incremental  # noqa: E402

_EVENT_RULES = (
    {"rule_type": "not_null", "column": "event_type"},
    {"rule_type": "regex", "column": "event_type", "pattern": "^[a-z]+$"},
)
_DROP_SPLIT = "2024-01-15 00:00:00"


def _incremental(spark: SparkSession, sf_dir: str, partition_by: tuple[str, ...] = (), buckets: int | None = None) -> tuple[str, DataFrame]:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    src, target = scratch_path(spark, "incoming"), _target(spark, "events_inc")
    ckpt, dlq = scratch_path(spark, "inc_ckpt"), scratch_path(spark, "inc_dlq")
    schema = ev.schema
    for part in ["year", "month", "day", "hour"]:
        schema = schema.add(part, "string")
    runs = []
    for drop in (ev.filter(F.col("ts") < F.lit(_DROP_SPLIT).cast(ev.schema["ts"].dataType)),
                 ev.filter(F.col("ts") >= F.lit(_DROP_SPLIT).cast(ev.schema["ts"].dataType))):
        write_hourly(drop, "ts", src, timestampNTZFormat=_MICROS)  # new files arrive
        stream = file_stream(spark, src, schema, "csv", timestampNTZFormat=_MICROS)
        runs.append(load_incremental(spark, stream, target, list(_EVENT_RULES),
                                     keys=["event_id", *partition_by], partition_by=list(partition_by) or None,
                                     checkpoint=ckpt, dlq_path=dlq, run_date=RUN_DATE, buckets=buckets))
    return target, runs[0].unionByName(runs[1])


@register("incremental_load", """
SELECT event_id, ts, user_id, event_type, value,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
FROM events
""")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = _incremental(spark, sf_dir)
    return spark.table(target)


@register("incremental_load_partitioned", ORACLE_SQL["incremental_load"])
def incremental_load_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Day-partitioned target: the second drop rewrites only the days it brings.
    target, _ = _incremental(spark, sf_dir, partition_by=("year", "month", "day"))
    return spark.table(target)


@register("incremental_load_bucketed", ORACLE_SQL["incremental_load"])
def incremental_load_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No partition column in the key: hidden hash buckets bound what a drop rewrites.
    target, _ = _incremental(spark, sf_dir, buckets=16)
    return spark.table(target)


@register("incremental_runs", f"""
SELECT 'batch0' AS run_id, count(*) FILTER (WHERE ts < TIMESTAMP '{_DROP_SPLIT}') AS total_count
FROM events
UNION ALL
SELECT 'batch1', count(*) FILTER (WHERE ts >= TIMESTAMP '{_DROP_SPLIT}') FROM events
""")
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, runs = _incremental(spark, sf_dir)
    return runs.select("run_id", "total_count")


# --- JDBC (S8, K4-K9 over a database; in-process Derby, no port) -------------------------

from vetline.plans.load import jdbc_publisher  # noqa: E402
from vetline.sources.jdbc import read_jdbc, write_jdbc  # noqa: E402

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _derby_url() -> str:
    # An in-memory database private to this JVM: a test stand-in for the
    # warehouse (executors on other machines could not reach it).
    return f"jdbc:derby:memory:{unique_name('vetline')};create=true"


@register("jdbc_roundtrip", "SELECT * FROM customer")
def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    url = _derby_url()
    write_jdbc(c, url, "CUSTOMER", DERBY, mode="overwrite")
    bounds = c.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    return read_jdbc(spark, url, "CUSTOMER", DERBY, partition_column="c_custkey",
                     lower_bound=bounds[0], upper_bound=bounds[1], num_partitions=4, timestamp_ntz=True)


@register("jdbc_replace", _SPLIT_VALID_SQL)
def jdbc_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = dirty_orders(spark, sf_dir)
    url = _derby_url()
    write_jdbc(src, url, "ORDERS_CLEAN", DERBY, mode="overwrite")  # old rows, valid or not
    load(spark, src, "vetline_q.orders_clean_jdbc", list(DEFAULT_RULES),
         dlq_path=scratch_path(spark, "load_dlq"), run_date=RUN_DATE,
         staging=f"{QDB}.{unique_name('stg')}", publish=jdbc_publisher(url, "ORDERS_CLEAN", DERBY))
    return read_jdbc(spark, url, "ORDERS_CLEAN", DERBY, partition_column='"o_orderkey"', num_partitions=4, timestamp_ntz=True)


# --- remaining sources and sinks ---------------------------------------------------------

@register("dq_results_published", f"""
SELECT 'ColumnCount > 0' AS rule, 'Passed' AS outcome, 'ColumnCount' AS metric_name,
       CAST(8.0 AS DOUBLE) AS metric_value, count(*) AS row_count
FROM ({_DOC_JOIN_SQL}) j
UNION ALL
SELECT 'RowCount > 0', CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END, 'RowCount',
       CAST(count(*) AS DOUBLE), count(*)
FROM ({_DOC_JOIN_SQL}) k
""")
def dq_results_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = f"{QDB}.{unique_name('dq_results')}"
    enrich(spark, read_table(spark, sf_dir, "labels"), read_table(spark, sf_dir, "documents"), "doc_id",
           QDB, unique_name("doc_join"), path=scratch_path(spark, "enrich"),
           dq_rules=("ColumnCount > 0", "RowCount > 0"), dq_results_table=results)
    return spark.table(results).select("rule", "outcome", "metric_name", "metric_value", "row_count")


@register("csv_recursive_scan", """
SELECT event_id, ts, user_id, event_type, props FROM events
""")
def csv_recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A recursive walk reads every file below the root; the partition folders
    # are then plain directories and give no columns.
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    root = scratch_path(spark, "hourly_rec")
    write_hourly(ev, "ts", root, timestampNTZFormat=_MICROS)
    return read_csv(spark, root, schema=ev.schema, recursive=True, timestampNTZFormat=_MICROS)


@register("positional_insert", """
SELECT c_custkey AS a, c_name AS b, c_mktsegment AS c FROM customer
UNION ALL
SELECT c_custkey, c_mktsegment, c_name FROM customer
""")
def positional_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    t = unique_name("positional")
    write_table(c.select(c.c_custkey.alias("a"), c.c_name.alias("b"), c.c_mktsegment.alias("c")), QDB, t,
                path=scratch_path(spark, "positional"))
    # Same column names in another order: by position, as INSERT INTO t SELECT *.
    write_table(c.select(c.c_custkey.alias("a"), c.c_mktsegment.alias("c"), c.c_name.alias("b")), QDB, t,
                by_name=False)
    return spark.table(f"{QDB}.{t}")


# --- rules over whole long texts -------------------------------------------------------

DOC_RULES = (
    {"rule_type": "not_null", "column": "text"},
    {"rule_type": "regex", "column": "lang", "pattern": "^[a-z]{2}$"},
    {"rule_type": "regex", "column": "text", "pattern": "^[^@]*$", "rule_name": "text_without_at_sign"},
    {"rule_type": "regex", "column": "text", "pattern": "[0-9]", "rule_name": "text_has_digit"},
)
_DOC_FAILS = {
    "not_null_text": "(text IS NULL OR trim(text) = '')",
    "regex_lang": "(lang IS NULL OR NOT regexp_matches(lang, '^[a-z]{2}$'))",
    "text_without_at_sign": "(text IS NULL OR NOT regexp_matches(text, '^[^@]*$'))",
    "text_has_digit": "(text IS NULL OR NOT regexp_matches(text, '[0-9]'))",
}
_DOC_COLUMN = {"not_null_text": "text", "regex_lang": "lang", "text_without_at_sign": "text",
               "text_has_digit": "text"}


@register("documents_errors_by_rule", "SELECT rule_name, \"column\", n_errors FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule_name, '{_DOC_COLUMN[n]}' AS \"column\", count(*) AS n_errors FROM documents WHERE {c}"
    for n, c in _DOC_FAILS.items()) + "\n) WHERE n_errors > 0")
def documents_errors_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts(read_table(spark, sf_dir, "documents"), list(DOC_RULES))[1]


@register("documents_valid", f"""
SELECT doc_id, lang, source, n_chars FROM documents WHERE NOT ({" OR ".join(_DOC_FAILS.values())})
""")
def documents_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = validate_split(read_table(spark, sf_dir, "documents"), list(DOC_RULES))
    return valid.select("doc_id", "lang", "source", "n_chars")


# --- dirty inputs and refused or failing steps (S7, K9, K13, V9, V13, C4, K16, J1) -------------

from vetline.functions.rules import Rule  # noqa: E402
from vetline.sinks.tables import table_exists, upsert_target  # noqa: E402


@register("load_from_catalog_table", _SPLIT_VALID_SQL)
def load_from_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _target(spark, "orders_raw"), _target(spark, "orders_clean")
    db, _, t = source.partition(".")
    write_table(dirty_orders(spark, sf_dir), db, t, mode="overwrite")
    load(spark, spark.table(source), target, list(DEFAULT_RULES), dlq_path=scratch_path(spark, "load_dlq"), run_date=RUN_DATE)
    return spark.table(target)


@register("staging_cleaned_after_failure", "SELECT count(*) AS target_rows, CAST(0 AS BIGINT) AS staging_tables FROM orders")
def staging_cleaned_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    target, staging = _target(spark, "orders_keep"), _target(spark, "orders_stg")
    replace_target(orders, target)

    def refuse(accepted: DataFrame, valid_count: int) -> str | None:
        raise RuntimeError(f"publishing {valid_count} rows fails on purpose")

    try:
        load(spark, orders, target, [], staging=staging, publish=refuse)
        raise AssertionError("the load should have failed")
    except RuntimeError:
        left = int(table_exists(spark, *staging.split(".")))
    return spark.table(target).agg(F.count(F.lit(1)).alias("target_rows"), F.lit(left).cast("bigint").alias("staging_tables"))


@register("rule_unsupported_type", "SELECT o_orderkey, true AS valid FROM orders")
def rule_unsupported_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(read_table(spark, sf_dir, "orders"), [Rule("checksum", "o_orderpriority")])
    return checked.select("o_orderkey", (F.size(ERRORS_COL) == 0).alias("valid"))


@register("schema_check_refused", "SELECT o_orderkey, o_totalprice, true AS refused FROM orders")
def schema_check_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    target, refused = _target(spark, "orders_keep"), []
    replace_target(orders, target)
    for rows, expected in ((orders.select(F.col("o_orderkey").cast("string"), "o_totalprice"), None), (orders.select("o_orderkey"), None),
                           (orders, "o_orderkey bigint, o_clerk string")):
        try:
            load(spark, rows, target, [], expected_schema=expected)
        except ValueError:
            refused.append(True)
    return spark.table(target).withColumn("refused", F.lit(len(refused) == 3))


@register("dlq_failure_load_continues", _with_dirty(f"""
SELECT 'succeeded' AS status, true AS dlq_failed, count(*) FILTER (WHERE NOT {_ANY_FAIL}) AS target_rows FROM dirty_orders
"""))
def dlq_failure_load_continues(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "orders_clean")
    metrics = load(spark, dirty_orders(spark, sf_dir), target, list(DEFAULT_RULES), dlq_path="nosuchfilesystem://dlq", run_date=RUN_DATE)
    rows = spark.table(target).agg(F.count(F.lit(1)).alias("target_rows"))
    return metrics.select("status", F.col("dlq_status").startswith("failed").alias("dlq_failed")).join(rows)


@register("upsert_duplicate_keys", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1
""")
def upsert_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    target = _target(spark, "last_order")
    first = orders.where("o_orderkey % 2 = 0")
    upsert_target(first, target, ["o_custkey"], order_by=["o_orderdate", "o_orderkey"])
    upsert_target(orders, target, ["o_custkey"], order_by=["o_orderdate", "o_orderkey"])
    return spark.table(target).drop("o_orderdate")


@register("upsert_null_keys_replayed", """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey END AS k, o_totalprice, 'rejected' AS kept
FROM orders WHERE o_orderkey % 10 = 0
UNION ALL
SELECT o_orderkey, o_totalprice, 'loaded' FROM orders WHERE o_orderkey % 10 <> 0
""")
def upsert_null_keys_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One drop delivered twice as two files: keys that are null go to the DLQ, the others are loaded once.
    k = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")).alias("k")
    rows = read_table(spark, sf_dir, "orders").select(k, "o_totalprice")
    src, dlq, ckpt = (scratch_path(spark, "nulls", p) for p in ("in", "dlq", "ck"))
    target = _target(spark, "null_keys")
    for _ in range(2):
        rows.write.mode("append").option("header", True).csv(src)
        load_incremental(spark, file_stream(spark, src, rows.schema), target, [], keys=["k"], checkpoint=ckpt, dlq_path=dlq, run_date=RUN_DATE)
    rejected = read_dlq(spark, dlq).where("run_id = 'batch0'").select("k", "o_totalprice", F.lit("rejected").alias("kept"))
    return rejected.unionByName(spark.table(target).withColumn("kept", F.lit("loaded")))


_CSV_TEXT = """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN concat('  ', text, ' ')
                               WHEN 3 THEN concat('"', text, '",') ELSE text END AS text
FROM documents
"""


@register("csv_text_roundtrip", _CSV_TEXT)
def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_table(spark, sf_dir, "documents").createOrReplaceTempView("vetline_documents")
    rows = spark.sql(_CSV_TEXT.replace("documents", "vetline_documents")).withColumn("at", F.expr("timestamp '2024-01-01 00:00:00'"))
    root = scratch_path(spark, "csv_text")
    write_hourly(rows, "at", root, line_breaks=True)
    return read_partitioned(spark, root, schema=rows.schema, partition_columns=["year", "month", "day", "hour"], multiLine=True).select("doc_id", "text")


@register("lookup_right_join_hot_fanout", """
SELECT o.o_orderkey, c.c_custkey, c.c_name
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN 1 ELSE o_custkey END AS o_custkey FROM orders) o
RIGHT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def lookup_right_join_hot_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nine lookup rows in ten share one key: it is dealt on both sides.
    key = F.when(F.col("o_orderkey") % 10 != 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", key)
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return lookup_right_join(orders, customers, "o_custkey", records_key="c_custkey", broadcast=False, salt_buckets=8).drop("o_custkey")


@register("load_dlq_partitioned", _with_dirty(f"""
SELECT o_orderkey, vendor_id FROM dirty_orders WHERE {_ANY_FAIL}
"""))
def load_dlq_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rejects keep blank and empty values of the column that partitions the target.
    target, dlq = _target(spark, "orders_by_vendor"), scratch_path(spark, "load_dlq")
    src = dirty_orders(spark, sf_dir)
    load(spark, src, target, list(DEFAULT_RULES), partition_by="vendor_id", dlq_path=dlq, run_date=RUN_DATE)
    return read_dlq(spark, dlq, schema=src.select("o_orderkey", "vendor_id").schema).select("o_orderkey", "vendor_id")


# --- commits, replays and shared targets (K6, K11, K13, S6) -----------------------------------

import datetime as dt  # noqa: E402

from vetline.session import delete_path, path_exists  # noqa: E402
from vetline.sinks.commits import POINTERS, filesystem  # noqa: E402
from vetline.sinks.tables import default_root, sweep_uncommitted  # noqa: E402
from vetline.streaming.incremental import stream_id  # noqa: E402


@register("commit_crash_recovered", "SELECT o_orderkey, o_totalprice, CAST(1 AS INTEGER) AS folders_swept FROM orders")
def commit_crash_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A load died between creating its commit file and writing it, and left its rows: neither blocks the next load.
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    target = _target(spark, "crashed")
    root = default_root(spark, target)
    replace_target(orders.where("o_orderkey % 2 = 0"), target)
    path, fs = filesystem(spark, f"{root}/{POINTERS}/000000000002.json")
    fs.create(path, False).close()
    orders.write.parquet(f"{root}/_v20240101000000000000_00000000")
    load(spark, orders.where("o_orderkey % 3 = 0"), target, [])
    upsert_target(orders, target, ["o_orderkey"])
    swept = int(not path_exists(spark, f"{root}/_v20240101000000000000_00000000")) + len(sweep_uncommitted(spark, target))
    return spark.table(target).withColumn("folders_swept", F.lit(swept))


@register("upsert_bucket_change_refused", "SELECT o_orderkey, o_totalprice, true AS refused FROM orders")
def upsert_bucket_change_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rows would be looked for in buckets they are not in: the number of the target stands, and a batch may leave it out.
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    target = _target(spark, "bucketed")
    upsert_target(orders, target, ["o_orderkey"], buckets=4)
    try:
        upsert_target(orders, target, ["o_orderkey"], buckets=7)
        refused = False
    except ValueError:
        refused = True
    upsert_target(orders.where("o_orderkey % 5 = 0"), target, ["o_orderkey"])
    return spark.table(target).withColumn("refused", F.lit(refused))


@register("upsert_untouched_files", """
SELECT o_orderkey, CASE WHEN o_orderkey <= 100 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, true AS others_stay FROM orders
""")
def upsert_untouched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Neither partitions nor buckets: files are ranges of the key, and a batch rewrites those that hold its keys.
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    target = _target(spark, "by_file")
    upsert_target(orders.where("o_orderkey <= 1000"), target, ["o_orderkey"])
    upsert_target(orders.where("o_orderkey > 1000"), target, ["o_orderkey"])  # new keys: the first files stay
    before = set(spark.table(target).inputFiles())
    upsert_target(orders.where("o_orderkey <= 100").withColumn("o_totalprice", -F.col("o_totalprice")), target, ["o_orderkey"])
    stay = before & set(spark.table(target).inputFiles())
    return spark.table(target).withColumn("others_stay", F.lit(0 < len(stay) < len(before)))


_STREAMS_SQL = f"""
SELECT o_orderkey, vendor_id, 'rejected' AS kept, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS stream FROM dirty_orders WHERE {{0}}
UNION ALL
SELECT o_orderkey, vendor_id, 'loaded', '' FROM dirty_orders WHERE NOT {{0}}
"""
_VENDOR_RULE = [{"rule_type": "regex", "column": "vendor_id", "pattern": r"^\d+$"}]


def _two_streams(spark: SparkSession, sf_dir: str, replay: bool) -> DataFrame:
    rows = dirty_orders(spark, sf_dir).select("o_orderkey", "vendor_id")
    target, dlq, names = _target(spark, "shared"), scratch_path(spark, "shared_dlq"), []
    for name, rest in (("even", 0), ("odd", 1)):
        src, ckpt = scratch_path(spark, name), scratch_path(spark, "ck")
        rows.where(F.col("o_orderkey") % 2 == rest).write.csv(src, header=True, emptyValue='""', ignoreLeadingWhiteSpace=False,
                                                              ignoreTrailingWhiteSpace=False)
        for day in (RUN_DATE, RUN_DATE + dt.timedelta(days=1))[:1 + replay]:
            load_incremental(spark, file_stream(spark, src, rows.schema), target, _VENDOR_RULE, keys=["o_orderkey"], checkpoint=ckpt,
                             dlq_path=dlq, run_date=day)
            delete_path(spark, f"{ckpt}/commits/0")  # as if the driver had died before the stream took note of the batch
        names.append((stream_id(spark, ckpt), name))
    named = F.create_map(*[F.lit(x) for pair in names for x in pair])
    rejected = read_dlq(spark, dlq).select("o_orderkey", "vendor_id", F.lit("rejected").alias("kept"), named[F.col("stream")].alias("stream"))
    return rejected.unionByName(spark.table(target).select("o_orderkey", "vendor_id", F.lit("loaded").alias("kept"), F.lit("").alias("stream")))


@register("two_streams_one_dlq", _with_dirty(_STREAMS_SQL.format(_RX_VENDOR)))
def two_streams_one_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both call their first batch batch0; target and queue keep the rows of either.
    return _two_streams(spark, sf_dir, replay=False)


@register("stream_replay_after_midnight", _with_dirty(_STREAMS_SQL.format(_RX_VENDOR)))
def stream_replay_after_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every batch is delivered again the next day: no reject appears twice, no row is loaded twice.
    return _two_streams(spark, sf_dir, replay=True)


# --- malformed records and sources that change (S1, S4, C1, C7) --------------------------------

_LINE_FAULTS = """
CASE o_orderkey % 10 WHEN 0 THEN concat('x', {k}, ',', {c}, ',', o_orderstatus) WHEN 1 THEN concat({k}, ',', {c}, ',', o_orderstatus, ',more')
                     WHEN 2 THEN concat({k}, ',', {c}) ELSE concat({k}, ',', {c}, ',', o_orderstatus) END"""
_JSON_FAULTS = """
CASE o_orderkey % 10 WHEN 0 THEN concat('{{"o_orderkey":', {k}, ',"o_cust') WHEN 1 THEN concat('{{"o_orderkey":"x', {k}, '","o_custkey":', {c}, '}}')
                     WHEN 2 THEN concat('[', {k}, ']}}') ELSE concat('{{"o_orderkey":', {k}, ',"o_custkey":', {c}, ',"o_orderstatus":"', o_orderstatus, '"}}') END"""
_MALFORMED_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS VARCHAR) AS raw, 'loaded' AS kept FROM orders WHERE o_orderkey % 10 > 2
UNION ALL
SELECT NULL, NULL, NULL, {0}, 'malformed_record' FROM orders WHERE o_orderkey % 10 <= 2
"""


def _fault(kind: str, cast: str) -> str:
    return kind.format(k=f"CAST(o_orderkey AS {cast})", c=f"CAST(o_custkey AS {cast})")


_ORDER_LINE = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"


def _lines(spark: SparkSession, sf_dir: str, faults: str, name: str) -> str:
    path = scratch_path(spark, "lines") + "/" + name
    read_table(spark, sf_dir, "orders").selectExpr(_fault(faults, "STRING") + " AS value").write.text(path)
    return path


def _loaded_and_malformed(spark: SparkSession, table: DataFrame, dlq: str) -> DataFrame:
    rejected = read_dlq(spark, dlq).select("raw_record", F.inline(ERRORS_COL)).where("value = raw_record")
    return table.select("o_orderkey", "o_custkey", "o_orderstatus", F.lit(None).cast("string").alias("raw"), F.lit("loaded").alias("kept")).unionAll(
        rejected.selectExpr("CAST(NULL AS bigint)", "CAST(NULL AS bigint)", "CAST(NULL AS string)", "raw_record", "rule_name"))


@register("csv_malformed_to_dlq", _MALFORMED_SQL.format(_fault(_LINE_FAULTS, "VARCHAR")))
def csv_malformed_to_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A word where a number belongs, a field too many, a field too few: rejected with their text, nothing loaded as NULL.
    path, target, dlq = _lines(spark, sf_dir, _LINE_FAULTS, "orders.csv"), _target(spark, "lines"), scratch_path(spark, "dlq")
    rows = read_csv(spark, path, schema=_ORDER_LINE, header=False, keep_malformed=True)
    load(spark, rows, target, [], dlq_path=dlq, run_date=RUN_DATE)
    return _loaded_and_malformed(spark, spark.table(target), dlq)


@register("json_malformed_to_dlq", _MALFORMED_SQL.format(_fault(_JSON_FAULTS, "VARCHAR")))
def json_malformed_to_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Cut off, of another type, no object: through the file ingest.
    path, dlq = _lines(spark, sf_dir, _JSON_FAULTS, "orders.json"), scratch_path(spark, "dlq")
    table = ingest(spark, path, scratch_path(spark, "ingest_out"), QDB, unique_name("orders"), schema=_ORDER_LINE, dlq_path=dlq, run_date=RUN_DATE)
    return _loaded_and_malformed(spark, table, dlq)


@register("csv_malformed_upsert", _MALFORMED_SQL.format(_fault(_LINE_FAULTS, "VARCHAR")))
def csv_malformed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The same records through an incremental load.
    path, target, dlq = _lines(spark, sf_dir, _LINE_FAULTS, "orders.csv"), _target(spark, "lines"), scratch_path(spark, "dlq")
    rows = file_stream(spark, path, _ORDER_LINE, keep_malformed=True, header=False)
    load_incremental(spark, rows, target, [], keys=["o_orderkey"], dlq_path=dlq, run_date=RUN_DATE)
    return _loaded_and_malformed(spark, spark.table(target), dlq)


@register("source_change_refused", "SELECT o_orderkey, o_totalprice, true AS refused FROM orders")
def source_change_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every read of this source gives other rejects, always as many: they are not those that were left out.
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    target = _target(spark, "pinned")
    replace_target(orders, target)
    read_at = F.unix_micros(F.current_timestamp()).cast("double")
    moving = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).otherwise(-read_at))
    try:
        load(spark, moving, target, [{"rule_type": "regex", "column": "o_totalprice", "pattern": "^[0-9]"}])
        refused = False
    except RuntimeError:
        refused = True
    return spark.table(target).withColumn("refused", F.lit(refused))


# --- types, reruns, blank partitions, skewed keys, large lookups (K1-K3, K12, S8, J1) ----------------

@register("append_type_refused", """
SELECT c_custkey, c_nationkey, true AS refused FROM customer
UNION ALL
SELECT -c_custkey, CAST(c_nationkey AS INTEGER), true FROM customer
""")
def append_type_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A balance does not fit a column of whole numbers, a bigint no int; an int fits a bigint.
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    t, refused = unique_name("customers"), 0
    name = write_table(c.select("c_custkey", "c_nationkey"), QDB, t)
    wrong = (c.select("c_custkey", F.col("c_acctbal").alias("c_nationkey")), c.select("c_custkey", F.col("c_custkey").alias("c_nationkey")))
    for rows in wrong:
        for write in (lambda df: write_table(df, QDB, t), lambda df: write_table(df, QDB, t, by_name=False)):
            try:
                write(rows)
            except ValueError:
                refused += 1
    write_table(c.select((-F.col("c_custkey")).cast("int").alias("c_custkey"), "c_nationkey"), QDB, t)
    return spark.table(name).withColumn("refused", F.lit(refused == 4))


@register("upsert_types_widen", """
SELECT o_orderkey, CASE WHEN o_orderkey <= 1000 THEN CAST(1 AS DOUBLE) ELSE o_totalprice END AS o_totalprice, true AS refused FROM orders
""")
def upsert_types_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    target = _target(spark, "widened")
    upsert_target(orders, target, ["o_orderkey"])
    updates = orders.where("o_orderkey <= 1000").select(F.col("o_orderkey").cast("int"), F.lit(1).alias("o_totalprice"))
    upsert_target(updates, target, ["o_orderkey"])
    try:
        upsert_target(updates.withColumn("o_totalprice", F.lit("1")), target, ["o_orderkey"])
        refused = False
    except ValueError:
        refused = True
    return spark.table(target).withColumn("refused", F.lit(refused))


@register("dlq_table_rerun", ORACLE_SQL["dlq_table_append"])
def dlq_table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The first run is repeated after the second: the table holds one copy of either.
    t = unique_name("dlq")
    _, invalid = validate_split(dirty_orders(spark, sf_dir), list(DEFAULT_RULES))
    for run in ("r1", "r2", "r1"):
        append_dlq_table(invalid, QDB, t, RUN_DATE, run)
    return spark.table(f"{QDB}.{t}").select("run_id", "o_orderkey", F.inline(ERRORS_COL)).select("run_id", "o_orderkey", "rule_name")


@register("replace_blank_partitions", _with_dirty("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN vendor_id LIKE 'v%' THEN 'v' WHEN trim(vendor_id) = '' THEN vendor_id ELSE 'n' END AS vendor
FROM dirty_orders
"""))
def replace_blank_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Empty, blank and NULL partition values stay apart, also where an upsert rewrites some of them.
    dirty_orders(spark, sf_dir).createOrReplaceTempView("vetline_dirty")
    rows = spark.sql("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN vendor_id LIKE 'v%' THEN 'v'
                               WHEN trim(vendor_id) = '' THEN vendor_id ELSE 'n' END AS vendor FROM vetline_dirty""")
    target = _target(spark, "blank")
    load(spark, rows.where("o_orderkey % 3 <> 0"), target, [], partition_by="vendor")
    upsert_target(rows.where("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"), target, ["o_orderkey"], partition_by="vendor")
    return spark.table(target)


@register("jdbc_skewed_keys", "SELECT o_orderkey, o_totalprice, true AS even FROM orders")
def jdbc_skewed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Most keys lie close together and few far away: ranges follow the keys, not the width.
    key = F.when(F.col("o_orderkey") % 50 == 0, F.col("o_orderkey") * 1_000_000).otherwise(F.col("o_orderkey")).alias("K")
    orders = read_table(spark, sf_dir, "orders").select(key, F.col("o_totalprice").alias("PRICE"))
    url = _derby_url()
    write_jdbc(orders, url, "SKEWED", DERBY, mode="overwrite", num_partitions=4)
    back = read_jdbc(spark, url, "SKEWED", DERBY, partition_column="K", num_partitions=8)
    sizes = [r["n"] for r in back.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]  # a row per range
    even = len(sizes) == 8 and max(sizes) <= 1.2 * min(sizes)
    return back.select(F.when(F.col("K") % 1_000_000 == 0, (F.col("K") / 1_000_000).cast("bigint")).otherwise(F.col("K")).alias("o_orderkey"),
                       F.col("PRICE").alias("o_totalprice"), F.lit(even).alias("even"))


@register("lookup_large_reduced", """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderkey, o.o_totalprice
FROM lineitem l RIGHT JOIN (SELECT * FROM orders WHERE o_custkey % 20 = 0) o ON l.l_orderkey = o.o_orderkey
""")
def lookup_large_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The lookup is too large to be broadcast, the records' keys are few: only lookup rows that match are moved.
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = read_table(spark, sf_dir, "orders").where("o_custkey % 20 = 0").select("o_orderkey", "o_totalprice")
    return lookup_right_join(lines, orders, "l_orderkey", records_key="o_orderkey", max_broadcast_rows=orders.count() + 1)


@register("replace_positional", """
SELECT c_mktsegment AS c_name, c_name AS c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_custkey FROM customer WHERE c_nationkey > 4
""")
def replace_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    # INSERT INTO target SELECT *: the n-th column of the rows is the target's n-th, whatever either is called.
    c = read_table(spark, sf_dir, "customer")
    target = _target(spark, "by_position")
    replace_target(c.select("c_name", "c_mktsegment", "c_custkey"), target)
    replace_target(c.select("c_mktsegment", "c_name", "c_custkey"), target, by_name=False)
    load(spark, c.select("c_mktsegment", "c_name", "c_nationkey"), target, [{"rule_type": "regex", "column": "c_nationkey", "pattern": "^([5-9]|..)$"}],
         by_name=False)
    return spark.table(target)
