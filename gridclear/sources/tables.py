"""Tables by name or path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class UnknownTable(ValueError):
    """No table of that name."""


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or temporary view; a name with a slash is a folder of Parquet files."""
    if "/" in name:
        return spark.read.parquet(name)
    if not spark.catalog.tableExists(name):
        raise UnknownTable(name)
    return spark.table(name)


def catalog_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """All tables and views of a database by name, for ``list_tables`` and the summaries."""
    return {t.name: spark.table(t.name) for t in spark.catalog.listTables(database)}


def create_or_replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """The rows as a catalog table, at ``path`` if given."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
