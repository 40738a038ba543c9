"""Every registered query against its SQL on whole tables."""

import pytest
from landed import SF
from oracle import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from landfall.samples.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(queries()[name](spark, SF), con, oracle_sql()[name]) == []


def test_entry(spark):
    loaded = entry(spark)
    assert loaded.count() > 0
    assert "NumRows" in loaded.columns
