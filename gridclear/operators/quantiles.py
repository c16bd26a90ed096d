"""Exact quantiles of a column of any size.

Spark's exact ``percentile`` keeps all distinct values in one task.  Here a pass counts values in 1,024
buckets and narrows each wanted rank to the bucket that holds it; all ranks share the pass, and a pass
returns at most 1,024 rows per rank.  Once few enough values are left they are read in order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
SMALL = 10_000

Range = tuple[float, float, int]


def _pick(parts: list[tuple], rank: int) -> tuple[tuple, int]:
    """The part that holds a 0-based rank, and the rank within it; the second field of a part is its count."""
    for part in parts:
        if rank < part[1]:
            return part, rank
        rank -= part[1]
    raise AssertionError("rank beyond the counted values")


def _values_at(values: DataFrame, ranks: set[int], whole: Range) -> dict[int, float]:
    """The values with the given 0-based ranks; all values lie in ``whole`` (lowest, highest, count)."""
    found: dict[int, float] = {}
    pending: dict[int, tuple[Range, int]] = {rank: (whole, rank) for rank in ranks}
    while True:
        for rank, ((lo, hi, _), _) in list(pending.items()):
            if lo == hi:
                found[rank] = lo
                del pending[rank]
        if not pending:
            return found
        # Ranges come from splitting the same range, so they are equal or disjoint.
        ranges = sorted({part for part, _ in pending.values()})
        v = F.col("v")
        which = F.coalesce(*[F.when(v.between(lo, hi), i) for i, (lo, hi, _) in enumerate(ranges)])
        inside = values.withColumn("part", which).filter(F.col("part").isNotNull())
        if all(count <= SMALL for _, _, count in ranges):
            counted = inside.groupBy("part", "v").agg(F.count("*").alias("n")).orderBy("v").collect()
            for rank, (part, position) in pending.items():
                rows = [(r["v"], r["n"]) for r in counted if r["part"] == ranges.index(part)]
                found[rank] = _pick(rows, position)[0][0]
            return found
        slots = []
        for i, (lo, hi, _) in enumerate(ranges):
            width = hi / BUCKETS - lo / BUCKETS or hi - lo  # the difference itself may exceed all numbers
            slots.append(F.when(F.col("part") == i, F.least(F.floor((v - lo) / width), F.lit(BUCKETS - 1))))
        split = (
            inside.groupBy("part", F.coalesce(*slots).alias("slot"))
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("lo")
            .collect()
        )
        for rank, (part, position) in pending.items():
            rows = [((r["lo"], r["hi"], r["n"]), r["n"]) for r in split if r["part"] == ranges.index(part)]
            (narrower, _), rest = _pick(rows, position)
            pending[rank] = (narrower, rest)


def exact_quantiles(df: DataFrame, column: Column, probabilities: list[float]) -> list[float | None]:
    """Interpolated quantiles of the values that are neither NULL nor NaN, as SQL's ``percentile_cont`` defines them.

    Infinite values are only counted: they are the first and the last in order.  Every pass narrows the finite ranges to a slot of
    1,024, so their number is bounded by the digits of a double.
    """
    numbers = df.select(column.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    least, most = F.lit(-math.inf), F.lit(math.inf)
    finite = (F.col("v") > least) & (F.col("v") < most)
    count, below, inside, lo, hi = numbers.agg(
        F.count("*"), F.count_if(F.col("v") == least), F.count_if(finite), F.min(F.when(finite, F.col("v"))), F.max(F.when(finite, F.col("v")))
    ).first()
    if count == 0:
        return [None for _ in probabilities]
    positions = [p * (count - 1) for p in probabilities]
    ranks = {f(x) for x in positions for f in (math.floor, math.ceil)}
    middle = {r - below for r in ranks if below <= r < below + inside}
    found = _values_at(numbers.filter(finite), middle, (lo, hi, inside)) if middle else {}
    at = {r: -math.inf if r < below else math.inf if r >= below + inside else found[r - below] for r in ranks}

    def between(x: float) -> float:
        a, b = at[math.floor(x)], at[math.ceil(x)]
        return a if a == b or x == math.floor(x) else a + (x - math.floor(x)) * (b - a)

    return [between(x) for x in positions]
