"""Registered queries of the package against their SQL, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tripmart.llm import oracle, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_all_are_registered():
    names = set(queries.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names}
    assert names | {"pipeline"} <= set(entry.queries()) and set(oracle.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    cursor = duck.execute(oracle.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    order = sorted(df.columns)
    assert order == sorted(names)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    at = [names.index(c) for c in order]
    assert got == sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["op3_url_templates", "op5_adaptive_quality", "op6_ring_sharding"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
