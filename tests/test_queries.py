"""Every registered query agrees with its SQL on the smallest tables."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from gridclear.plans import all_queries, comparison_sql

QUERIES, SQL = all_queries(), comparison_sql()


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 847


def test_known_counts(spark, sf_dir):
    rows = QUERIES["marginal_prices"](spark, sf_dir).select("marginal_price", "match_tier").collect()
    assert sum(r.marginal_price is None for r in rows) == 639
    tiers = [sum(r.match_tier == t for r in rows) for t in (1, 2, 3, None)]
    assert tiers == [113, 272, 98, 364]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert differences(spark, con, name, QUERIES[name], SQL[name], sf_dir) is None
