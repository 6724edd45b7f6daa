"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import differences, oracle_connection
from checks.oracles import ORACLES
from checks.spark_queries import QUERIES

SMALL = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def oracle():
    with oracle_connection(SMALL) as connection:
        yield connection


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["star_mart", "fact_keys"])
def test_star_joins_keep_their_keys(spark, name):
    """Whatever the sizes, no join of the star compares every row with every row."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() == 247


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    count, problems = differences(spark, oracle, name, SMALL)
    assert not problems
    assert count > 0
