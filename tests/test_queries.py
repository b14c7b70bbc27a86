"""Every registered query against its SQL, whole results, at the smallest scale."""

from __future__ import annotations

import pytest

import compare
from zonewright.plans.catalog import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    assert name in CHECKS
    assert compare.difference(got, compare.duck_rows(duck, CHECKS[name])) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
