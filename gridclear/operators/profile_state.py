"""Column profiles of any period from states per day that are stored once and merged.

A state has, per column, filled rows, extremes in the column's own type, a sketch of its distinct values and, for numbers, one of their
quantiles.  States merge in any order and grouping; their size does not depend on the rows: at most some 16 KB for distinct values and 50 KB for quantiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.schema import quoted

#: Distinct values are estimated with a standard error of 0.8 percent (2 ** 14 registers), ranks of quantiles with less than half a percent.
DISTINCT_LG_K, QUANTILE_K = 14, 1000


def _number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _counted(value: Column, kind: T.DataType) -> Column:
    """What stands for a value in the sketch of distinct ones, which passes over empty texts; both zeros of a float are one value."""
    told = value + F.lit(0.0) if isinstance(kind, (T.DoubleType, T.FloatType)) else value
    return F.when(value.isNotNull(), F.xxhash64(told))


def profile_states(rows: DataFrame, period: str, columns: list[str]) -> DataFrame:
    """``(<period>, total_count, columns)``: a state for each value of the column ``period``, NULL included.

    One aggregation, combined before the shuffle.  NULLs count for ``total_count`` alone; NaN is a distinct value and the largest, but in no quantile.
    """
    if not columns:
        raise ValueError("no columns to profile")
    states = []
    for name in columns:
        value, kind = quoted(name), rows.schema[name].dataType
        parts = [F.count(value).alias("filled"), F.min(value).alias("low"), F.max(value).alias("high")]
        parts.append(F.hll_sketch_agg(_counted(value, kind), DISTINCT_LG_K).alias("distinct"))
        if _number(kind):
            parts.append(F.kll_sketch_agg_double(value.cast("double"), QUANTILE_K).alias("quantiles"))
        states.append(F.struct(*parts).alias(name))
    return rows.groupBy(quoted(period).alias(period)).agg(F.count("*").alias("total_count"), F.struct(*states).alias("columns"))


def _fields(states: DataFrame) -> list[T.StructField]:
    return states.schema["columns"].dataType.fields


def merged_states(states: DataFrame, *by: Column) -> DataFrame:
    """States of longer periods, one per ``by``; without it one for all.  They can be merged again."""
    merged = []
    for field in _fields(states):
        state = F.col("columns").getField(field.name)
        parts = [F.sum(state.getField("filled")).alias("filled"), F.min(state.getField("low")).alias("low"), F.max(state.getField("high")).alias("high"),
                 F.hll_union_agg(state.getField("distinct")).alias("distinct")]
        if "quantiles" in field.dataType.names:
            parts.append(F.kll_merge_agg_double(state.getField("quantiles")).alias("quantiles"))
        merged.append(F.struct(*parts).alias(field.name))
    return states.groupBy(*by).agg(F.coalesce(F.sum("total_count"), F.lit(0)).alias("total_count"), F.struct(*merged).alias("columns"))


def profile_of(states: DataFrame, probabilities: list[float] = [0.25, 0.5, 0.75]) -> DataFrame:
    """Per column of all states together: rows, NULLs, extremes as text, estimates of distinct values and of quantiles.

    Quantiles are NULL for columns without numbers; without any state all counts are zero.
    """
    one = merged_states(states)
    rows = []
    for field in _fields(states):
        state = F.col("columns").getField(field.name)
        filled = F.coalesce(state.getField("filled"), F.lit(0))
        found = F.lit(None).cast("array<double>")
        if "quantiles" in field.dataType.names:
            sketch = state.getField("quantiles")
            ranks = F.array(*[F.lit(float(p)) for p in probabilities])
            found = F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"), F.col("total_count"), filled.alias("filled_count"), (F.col("total_count") - filled).alias("null_count"),
                state.getField("low").cast("string").alias("min_value"), state.getField("high").cast("string").alias("max_value"),
                F.when(filled > 0, F.hll_sketch_estimate(state.getField("distinct"))).otherwise(0).alias("unique_estimate"), found.alias("quantiles"),
            )
        )
    return one.select(F.inline(F.array(*rows)))
