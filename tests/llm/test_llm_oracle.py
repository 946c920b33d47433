"""Queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from dealwise.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = sorted(repr(tuple(r)) for r in df.collect())
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    at = [cols.index(c) for c in df.columns]
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in res.fetchall())


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
