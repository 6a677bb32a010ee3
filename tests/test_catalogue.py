import os

import pytest
from compare import connect, differences, rows_of

import __spark_entry__ as driver
from sluiceway import catalogue

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalogue.oracles()) == set(catalogue.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    mine = rows_of(driver.queries()[name](spark, SF_DIR))
    assert differences(mine, rows_of(duck.execute(driver.oracle_sql()[name]))) == []


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
