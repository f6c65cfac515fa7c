"""The corpus queries against their SQL, and what they have in common."""

import contract
import pytest

import __spark_entry__ as driver
from footfall.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_its_sql(spark, name):
    got = contract.spark_result(queries.QUERIES[name](spark, SF_DIR))
    want = contract.oracle_result(contract.connect(SF_DIR), queries.ORACLE_SQL[name])
    assert got == want


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(queries.ORACLE_SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", ["op4_lines", "op8_mixing", "op10_syncmers"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExternalRDD"))
