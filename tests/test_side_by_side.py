"""Queries against their SQL counterparts on the smallest tables.

The headline queries run always, all others with TEST_ALL_QUERIES=1.
"""

import os

import pytest

from bench import HEADLINES
from sluice.plans.catalog import ORACLES, QUERIES
from tests.side_by_side import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


NAMES = sorted(QUERIES) if os.environ.get("TEST_ALL_QUERIES") else HEADLINES


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, con, name):
    problem, _, rows = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert problem is None
    assert rows > 0
