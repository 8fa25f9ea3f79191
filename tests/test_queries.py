"""Every registered query of the ledger against its SQL."""

import pytest
from oracle import differences

from lotloom.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    ours, theirs, more, fewer = differences(spark, QUERIES[name], ORACLES[name], SMALL)
    assert ours == theirs and not more and not fewer


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).columns[0] == "processing_id"
