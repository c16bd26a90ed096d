"""Reconciliation by content."""

import pytest
from gridclear.operators import reconcile as rc

ROWS = "day int, source string, a string, b string"
BASE = [(1, "x", "p", "q"), (1, "x", "p", "q"), (1, "x", None, "q"), (2, "x", "r", "s"), (None, "y", "t", None)]


def statuses(spark, before, after):
    found = rc.reconcile_content(spark.createDataFrame(before, ROWS), spark.createDataFrame(after, ROWS).repartition(3), ["day", "source"], ["a", "b"])
    return {(r.day, r.source): r.status for r in found.collect()}


def test_order_does_not_matter(spark):
    assert set(statuses(spark, BASE, BASE[::-1]).values()) == {"equal"}


@pytest.mark.parametrize(
    "changed",
    [
        [(1, "x", "q", "p"), *BASE[1:]],  # exchanged within a row
        [(1, "x", "p", "q"), (1, "x", None, "q"), (1, "x", None, "q"), *BASE[3:]],  # another row repeated
        [(1, "x", "p", "q"), (1, "x", "p", "q"), (1, "x", "q", None), *BASE[3:]],  # a NULL in another place
    ],
)
def test_changes_with_equal_counts_are_found(spark, changed):
    assert statuses(spark, BASE, changed) == {(1, "x"): "changed", (2, "x"): "equal", (None, "y"): "equal"}


def test_groups_of_one_side(spark):
    assert statuses(spark, BASE[:3], BASE[3:]) == {(1, "x"): "missing", (2, "x"): "new", (None, "y"): "new"}
    assert statuses(spark, [], []) == {}
