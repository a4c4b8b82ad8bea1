"""Every registered query against its SQL oracle, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from roster.plans.oracles import ORACLES
from roster.plans.queries import QUERIES
from tests.compare import assert_same, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    rows = assert_same(QUERIES[name](spark, SF), connection, ORACLES[name])
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 165
