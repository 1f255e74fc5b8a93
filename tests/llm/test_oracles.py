"""Queries of this package that SQL can express, against their oracles."""

import pytest

from convolens.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, sf_dir, name):
    got, want = compare(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
