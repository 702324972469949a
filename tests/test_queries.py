"""Every registered query against its SQL twin."""

import oracle
import pytest

import __spark_entry__ as driver
from bedfeed.plans.base import ORACLES as SQL
from bedfeed.plans.base import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert oracle.compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
