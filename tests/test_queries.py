"""Every registered query against its SQL twin, on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry_points
from tools.check_queries import TABLES, compare

DATA = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    if name in ORACLE:
        assert compare(rows, df.columns, con.sql(ORACLE[name])) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry_points.entry(spark).count() > 0
