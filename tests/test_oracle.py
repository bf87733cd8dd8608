"""Every registered query against its SQL over the same tables."""

import pytest

import __spark_entry__ as entry
from ticketlake.plans.registry import ORACLE, QUERIES
from compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, con, sf, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], sf) is None


def test_flagship(spark):
    assert entry.entry(spark).count() == 3
