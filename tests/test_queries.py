"""Every named query against its SQL on the smallest tables."""

import duckdb
import pytest
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, canonical
from transqa.plans.queries import QUERIES

SQL = oracle_sql()
# Joins of all pairs, row-at-a-time Python and groups handed whole to Python.
UNWANTED = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas",
)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    result = queries()[name](spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    got = result.toArrow().to_pandas()
    want = db.sql(SQL[name]).to_arrow_table().to_pandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry(spark).count() == 10
