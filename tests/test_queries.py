"""Every registered query against its reference SQL on the same tables."""

import pytest

import __spark_entry__ as entry
from cubeweave.registry import ORACLES, QUERIES
from oracle import compare, connect


# the smallest tables hold no complete forecast cycle and nothing in the fixed box
EMPTY_WHEN_SMALL = {"stac_search", "forecast_combine", "forecast_refused", "bbox_subset"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


# queries on training text have tests of their own
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    rows, _ = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), sf_dir)
    assert rows > 0 or name in EMPTY_WHEN_SMALL


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_reference():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())
