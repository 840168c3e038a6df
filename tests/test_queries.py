"""Every query that has SQL gives the same rows as it, on the smallest tables."""

import duckdb
import pytest

from tidemark.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events labels".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    found = oracle.execute(ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    want = [tuple(r[names.index(c)] for c in columns) for r in found.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
