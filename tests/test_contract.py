"""Every query against its SQL oracle, and the plans of all of them."""

import contract
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
# The corpus queries have tests of their own.
QUERIES = {name: query for name, query in driver.queries().items() if name not in driver.CORPUS_QUERIES}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name not in driver.CORPUS_SQL}


@pytest.fixture(scope="module")
def con():
    return contract.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    got = contract.spark_result(QUERIES[name](spark, SF_DIR))
    want = contract.oracle_result(con, ORACLES[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", [q for q in QUERIES if not q.startswith(("partitioned", "snapshot", "csv", "raw", "daily_rebuild"))])
def test_plan_stays_inside_spark(spark, name):
    """No Python, no nested-loop or cartesian join, no forced broadcast."""
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    for word in ("Python", "ArrowEval", "CartesianProduct", "NestedLoop", "strategy=broadcast"):
        assert word not in plan
