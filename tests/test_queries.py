"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

from maskwright.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, folder, name):
    assert compare(spark, con, folder, name) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
