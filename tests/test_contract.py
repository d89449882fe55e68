"""Registered queries against their SQL, and the shape of their plans."""

import pytest

import __spark_entry__ as entry
from conftest import plan_of
from contract.compare import connect, difference, to_pandas
from contract.oracles import all_oracles
from contract.queries import all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    plan = plan_of(result)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    problem = difference(to_pandas(result), to_pandas(duck.sql(ORACLES[name]).to_arrow_table()))
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["nation", "annee"]
