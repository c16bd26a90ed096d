"""Named queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.schema import quoted

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def report(df: DataFrame) -> DataFrame:
    """Output form of a query: dates and times as ISO text, decimals as doubles."""
    columns = []
    for field in df.schema.fields:
        column, kind = quoted(field.name), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(kind, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a function ``(spark, sf_dir) -> DataFrame`` under its own name, with its SQL if it has one."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, sf_dir: report(function(spark, sf_dir))
        if sql is not None:
            ORACLE[key] = sql
        return function

    return register
