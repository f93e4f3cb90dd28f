"""Queries with SQL give DuckDB's rows."""

import duckdb
import pytest

from tidemark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(oracle_sql()[name])
    theirs = [d[0] for d in res.description]
    assert sorted(theirs) == cols
    want = [tuple(r[theirs.index(c)] for c in cols) for r in res.fetchall()]
    assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, want))
