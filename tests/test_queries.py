"""Every registered query against its check SQL on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusloom.queries.views import TABLES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQLS = entry.queries(), entry.oracle_sql()


def norm(value):
    return float(f"{value:.6g}") if isinstance(value, float) else value


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted((tuple(norm(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    rel = con.sql(SQLS[name])
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    assert rows == sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["object_count"] > 0


def test_every_check_has_a_query():
    assert set(SQLS) <= set(QUERIES)
