"""Every registered query against its SQL check."""

import pytest

from registry.oracle import CHECKS
from registry.compare import connect, differences
from registry.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    connection = connect(SMALL)
    yield connection
    connection.close()


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_check(registered, con, name):
    assert differences(registered(name), con, name) == []
