"""Operators that SQL can express, against it."""

import glob
import os

import duckdb
import pytest

from changetide.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as database:
        for path in glob.glob(f"{FOLDER}/*.parquet"):
            database.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        result = queries.registered()[name](spark, FOLDER)
        columns = sorted(result.columns)
        want = database.execute(f"SELECT {', '.join(columns)} FROM ({oracle.oracle_sql()[name]}) AS t").fetchall()
    assert sorted(map(repr, map(tuple, result.select(*columns).collect()))) == sorted(map(repr, want))
