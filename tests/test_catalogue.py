"""Every registered query equals its SQL twin."""

import pytest
from oracle import connect, differences

from feedmill.catalogue import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name], spark, sf_dir, con) is None
