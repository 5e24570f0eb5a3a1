import pytest
from conftest import SF
from oracle import differences, duck

import __spark_entry__ as contract
from hitledger.workbook import QUERIES
from hitledger.workbook_sql import SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract():
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()
    assert set(QUERIES) == set(SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        assert differences(got.toPandas(), con.execute(SQL[name]).df()) == ""
    else:
        assert got.count() > 0
