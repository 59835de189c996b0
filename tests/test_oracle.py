"""Every registered query against its SQL twin."""

import pytest
from conftest import SF_DIR
from oracle import connect, differences

import __spark_entry__ as entry_file

ORACLES = entry_file.search_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(entry_file.search_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    frame = entry_file.queries()[name](spark, SF_DIR)
    assert differences(frame, duck, ORACLES[name]) == []


def test_entry_returns_hits(spark):
    assert entry_file.entry(spark).count() > 0
