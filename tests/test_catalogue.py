"""Every query with an oracle gives DuckDB's rows at the smallest size."""

import duckdb
import pytest

import __spark_entry__
from tidemark.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_oracle(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*cols).collect()]
    res = duck.execute(catalogue.ORACLE[name])
    theirs = [d[0] for d in res.description]
    assert sorted(theirs) == cols
    want = [tuple(r[theirs.index(c)] for c in cols) for r in res.fetchall()]
    assert ordered(got) == ordered(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
