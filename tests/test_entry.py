import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def rows(df):
    df = df[sorted(df.columns)]
    plain = lambda x: None if x is None or x != x else round(x, 6) if isinstance(x, float) else str(x)
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_queries_equal_their_sql(spark, duck):
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries)
    for name, sql in oracle.items():
        got, want = queries[name](spark, DATA).toPandas(), duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns), name
        assert rows(got) == rows(want), name


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
