"""Every registered query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from changetide.plans import oracle
from changetide.plans.queries import registered

FOLDER = "/root/testdata/sf0.001"
# The operators on training text are tested in tests/llm.
QUERIES, SQL = registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    ours = sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=repr)
    order = [names.index(c) for c in sorted(names)]
    theirs = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    assert ours == theirs


def test_entry(spark):
    assert entry_points.entry(spark).count() == 845
