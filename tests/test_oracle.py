"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from showcase.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
