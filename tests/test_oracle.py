"""Every query agrees with its SQL twin on the given tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    # No endpoint gets far enough in tables this small.
    few = name in ("f2_endpoints_to_evict", "g4_evicted_at")
    assert compare(spark, con, SF, name, may_be_empty=few) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"rule", "n_links"}


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
