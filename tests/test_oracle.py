"""Every registered query against its SQL in DuckDB, over the whole test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from pagemill.plans import catalog

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = catalog.QUERIES, catalog.SQL
TABLES = [f[: -len(".parquet")] for f in sorted(os.listdir(SF_DIR)) if f.endswith(".parquet")]
# Spark type to the DuckDB types it may stand for.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda row: [(v is None, str(v)) for v in row]
    return sorted((tuple(row[i] for i in order) for row in rows), key=key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    result = QUERIES[name](spark, SF_DIR)
    described = {r[0]: r[1] for r in db.execute(f"describe {SQL[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in result.dtypes} == described
    expected = db.execute(SQL[name])
    names = [d[0] for d in expected.description]
    want = sorted_rows(names, expected.fetchall())
    got = sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    assert len(got) == len(want)
    assert got or SF_DIR.endswith("sf0.001")  # no title is busy enough for a trend there
    for g, w in zip(got, want):
        assert g == w or all(
            a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-15))
            for a, b in zip(g, w)
        )


def test_all_queries_have_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= driver.queries().keys()


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["title", "ratio", "edits", "accesses"]
    assert result.count() > 0
