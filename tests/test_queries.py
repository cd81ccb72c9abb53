"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import canon, duckdb_views  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from vetline.plans import queries  # noqa: E402

QUERIES = queries.QUERIES  # the entry may add those of packages with tests of their own
ORACLES = queries.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "rule_name", "column", "value"]
    assert df.count() > 0


# DuckDB type names and the Spark type each one must match.
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "FLOAT": "float"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLES[name])
    d_cols = list(rel.columns)
    assert sorted(df.columns) == sorted(d_cols)
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(d_cols, rel.types)} == s_types
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(d_cols, rel.fetchall())
