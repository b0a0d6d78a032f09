"""Every registered query against its SQL equivalent in DuckDB, at the small scale."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from starflow.plans.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle_sql()
QUERIES = {n: q for n, q in queries().items() if n in all_queries()}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_registry_is_complete():
    assert set(QUERIES) == set(all_queries()) <= set(ORACLES)


def test_entry_is_lazy_and_has_columns(spark):
    columns = entry(spark).columns
    assert (columns[0], columns[-1]) == ("user_id", "dt")


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    left = sorted(repr(tuple(r[c] for c in columns)) for r in got.collect())
    index = [want.columns.index(c) for c in columns]
    right = sorted(repr(tuple(r[i] for i in index)) for r in want.fetchall())
    assert left == right
