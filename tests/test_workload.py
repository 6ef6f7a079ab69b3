"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from tillwise import workload

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
#: tested elsewhere: hashed n-grams (tests/test_text_model.py)
NO_SQL = {"e05_text_model"}
QUERIES, SQL = workload.all_queries(), workload.all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name in NO_SQL:
        assert df.count() > 0
        return
    msg = compare(df, con, SQL[name])
    assert msg is None, msg


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(SQL) == NO_SQL


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "user_id" and df.count() > 0
