"""Every registered query against its oracle, values compared exactly."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks import catalog, compare

QUERIES, ORACLE = catalog.queries(), driver.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) and set(QUERIES) <= set(driver.queries())


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert compare.differences(df, duck, ORACLE[name]) == []
