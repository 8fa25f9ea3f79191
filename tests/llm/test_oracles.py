"""Queries of the corpus operators that SQL can express, against their SQL."""

import pytest
from oracle import differences

from lotloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    ours, theirs, more, fewer = differences(spark, QUERIES[name], ORACLES[name], SMALL)
    assert ours == theirs and not more and not fewer
