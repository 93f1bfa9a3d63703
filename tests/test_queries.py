"""Every registered query against its SQL on DuckDB, with ANSI mode on and off."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as driver
from duebook import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = catalog.QUERIES
ANSWERS = catalog.ANSWERS
SLOW = {"train_propensity"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _text(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return str(value)


def _bag(columns, rows):
    return sorted(tuple(_text(row[c]) for c in columns) for row in rows)


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_matches_sql(spark, sf_dir, duck, ansi, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    answer = duck.execute(ANSWERS[name])
    found = [d[0] for d in answer.description]
    assert columns == sorted(found)
    expected = _bag(columns, [dict(zip(found, row)) for row in answer.fetchall()])
    assert expected
    assert _bag(columns, df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ANSWERS) - SLOW))
def test_gives_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry_has_rows(spark):
    assert not driver.entry(spark).isEmpty()


def test_every_answer_has_a_query():
    assert set(ANSWERS) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in plan
