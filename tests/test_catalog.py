"""Every registered payroll query against its SQL, over the whole small tables."""

import pytest

import __spark_entry__ as contract
from checks import catalog, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    result = contract.queries()[name](spark, FOLDER)
    assert compare.spark_rows(result) == compare.oracle_rows(FOLDER, contract.oracle_sql()[name])
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "Window", "Python", "Pandas"):
        assert node not in plan


def test_entry(spark):
    detail = contract.entry(spark)
    assert len(detail.columns) == 28 and detail.count() > 0


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() <= contract.queries().keys()
    assert catalog.QUERIES.keys() <= contract.oracle_sql().keys()
