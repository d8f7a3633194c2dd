"""Every registered query against its SQL on the small tables."""

import os

import pytest

from modelwatch.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == []
    else:
        assert df.collect()
