"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from check import compare

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, name):
    good, note = compare(spark, SF, name)
    assert good, note
