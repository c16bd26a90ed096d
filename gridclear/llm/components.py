"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node reachable from it, itself included.

    Loops, repeated edges and both directions are allowed; edges with a null end are ignored; no edges give no rows.  Each
    round is two aggregations and two joins by node and stores its edges in the shared folder, so lineage stays
    short.  Rounds grow with the logarithm of the longest path.
    """
    current = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = fingerprint(current)
    while state[0]:
        current = written(small_star(large_star(current)), "edges")
        before, state = state, fingerprint(current)
        if state == before:
            break
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionAll(roots)


def fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return row[0], int(row[1] or 0)


def large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to the least of its neighbours and itself."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the least of them; every edge has u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
