"""Every registered query against its SQL, over whole tables."""

import os
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert differences(df, duck, SQL[name]) == []


def test_queries_without_sql_have_a_test_of_their_own():
    tests = "".join(p.read_text() for p in Path(__file__).parent.glob("llm/test_*.py"))
    assert [name for name in queries() if name not in SQL and name not in tests] == []


def test_entry_has_rows(spark):
    rows = entry(spark)
    assert rows.columns == ["sample_id", "row_key", "type", "question", "response"]
    assert rows.limit(1).count() == 1
