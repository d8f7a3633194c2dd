"""Queries of the subpackage that SQL can express."""

import pytest

from modelwatch.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
