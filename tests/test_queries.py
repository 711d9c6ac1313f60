"""Every registered query against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import DATA
from tripmart.catalog import oracle, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, SQL = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    order = sorted(df.columns)
    assert order == sorted(names)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    at = [names.index(c) for c in order]
    want = sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_pairs_no_rows_and_stays_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for word in ("Cartesian", "NestedLoop", "Python", "InPandas", "Arrow"):
        assert word not in plan


def test_entry_registers_them(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
