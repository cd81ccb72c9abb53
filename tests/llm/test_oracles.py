import duckdb
import pytest

from vetline.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)
