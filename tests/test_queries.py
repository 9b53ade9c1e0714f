"""Every registered query with oracle SQL gives the oracle's rows on the smallest data."""

import os

import pytest

import __spark_entry__ as spark_entry
from checks.registry import ORACLE

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("CHECK_SF_DIR", spark_entry.SMOKE_DIR)
TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, oracle, name):
    found = spark_entry.queries()[name](spark, DATA)
    expected = oracle.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert table(found.columns, found.collect()) == table(columns, expected.fetchall())


def test_flagship_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_plan_is_free_of_cross_joins_and_python(spark, name):
    plan = spark_entry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert node not in plan
