"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry
from skyops.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
