"""Every registered query against its SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests.check import connect, differences
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = driver.SMOKE_DIR
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are missing")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(driver.queries()[name](spark, SF_DIR), duck, driver.oracle_sql()[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() == 10
