"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import connect, difference

from dialogue_engine.registry.oracles import ORACLES
from dialogue_engine.registry.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert difference(spark, db, QUERIES[name], ORACLES[name], SF_DIR) is None
