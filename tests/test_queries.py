"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as registered
from tallyline.queries.registry import REGISTRY
from tests.compare import spark_rows, sql_engine, sql_rows
from tests.plans import planned

FOLDER = "/root/testdata/sf0.001"
SQL = registered.oracle_sql()
# nothing joins every row with every row, and no row leaves the JVM
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.fixture(scope="module")
def engine():
    return sql_engine(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees_with_sql(spark, engine, name):
    result = registered.queries()[name](spark, FOLDER)
    plan = planned(result)
    assert not [node for node in FORBIDDEN if node in plan]
    if name not in SQL:
        assert len(result.columns) > 0 and not result.isEmpty()
        return
    names, rows = spark_rows(result)
    expected_names, expected = sql_rows(engine, SQL[name])
    assert names == expected_names
    assert rows == expected
    assert rows


def test_entry(spark):
    report = registered.entry(spark)
    assert report.columns == [
        "BRANCH_ID",
        "BRANCH_NAME",
        "TOTAL_TRANSACTIONS",
        "TOTAL_AMOUNT",
        "REGION",
        "LAST_AUDIT_DATE",
    ]
    assert report.count() > 0
