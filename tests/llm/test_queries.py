import duckdb
import pytest

from cinerank.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(SQL[name])
    assert cols == sorted(want.columns)
    assert sorted(map(tuple, df.select(cols).collect())) == sorted(want.select(*cols).fetchall())
