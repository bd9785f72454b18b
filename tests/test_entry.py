"""The queries against the same queries in SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from oracle_check import difference, duck
from regforge import constants as C
from workloads.oracle import ORACLE_SQL as SQL
from workloads.queries import QUERIES

WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def connection():
    return duck("/root/testdata/sf0.001")


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL and not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, smoke_folder, connection, name):
    assert difference(QUERIES[name](spark, smoke_folder), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_runs(spark, smoke_folder, name):
    assert QUERIES[name](spark, smoke_folder).count() > 0


def test_the_entry_point_lists_them():
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["instruction", "input", "output", "task"]
    tasks = {r["task"] for r in df.select("task").distinct().collect()}
    assert tasks == {C.TASK_STATUS, C.TASK_REACTIONS, C.TASK_STRUCTURE, C.TASK_IDENTIFY, C.TASK_FAILURE}
