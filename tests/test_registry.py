import importlib

import pytest

from feedstat.plans import registry
from oracle import connect, differences, plan

entry_module = importlib.import_module("__spark_entry__")
QUERIES, ORACLES = registry.all_queries(), registry.all_oracles()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, connection, ORACLES[name]) == []
    assert not any(join in plan(df) for join in ("CartesianProduct", "BroadcastNestedLoopJoin"))
