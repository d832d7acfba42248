"""Every named query against DuckDB on the small tables."""

import pytest

from catalog import ORACLES, QUERIES
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    assert difference(spark, con, name, sf) is None


def test_names():
    assert set(ORACLES) <= set(QUERIES)
