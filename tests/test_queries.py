"""All registered queries of the conversation operators against DuckDB."""

import pytest

from talkmill.plans.queries import ORACLES, QUERIES
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, same, name):
    same(QUERIES[name](spark, DATA), ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).columns


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
