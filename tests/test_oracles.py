"""Every registered query of the main package against its oracle."""

import pytest

from convolens import plans

from .oracle import compare


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query(spark, sf_dir, name):
    got, want = compare(spark, sf_dir, plans.QUERIES[name], plans.ORACLE_SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_query_runs(spark, sf_dir, name):
    assert plans.QUERIES[name](spark, sf_dir).columns
