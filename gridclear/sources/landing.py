"""Files as they arrive: listings, and what their names say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORKBOOK_GLOB = "*.[xX][lL][sS][xX]"
ZIPPED_WORKBOOK_GLOB = "*.[xX][lL][sS][xX].[zZ][iI][pP]"

# Fixed value: how published bid files are named.
BID_FILE_NAME = (
    r"RESULT_LIST_ANONYM_([A-Z]+)_MARKET_([A-Za-z]+)_DE_(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})\.xlsx(?:\.zip)?$"
)


def read_binary(spark: SparkSession, path: str, glob: str = WORKBOOK_GLOB, recursive: bool = False) -> DataFrame:
    """``path, modificationTime, length, content`` of the matching files."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def discover_landing_files(spark: SparkSession, path: str, glob: str = WORKBOOK_GLOB, recursive: bool = False) -> DataFrame:
    """Listing of the matching files by path; the contents are not read."""
    return (
        read_binary(spark, path, glob, recursive)
        .select("path", file_name(F.col("path")).alias("file_name"), "length", "modificationTime")
        .orderBy("path")
    )


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_name_lineage(path: Column) -> Column:
    """``market, product_type, period_start, period_end`` a bid file's name states, NULL where it states none."""

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(path, BID_FILE_NAME, i), F.lit(""))

    return F.struct(
        part(1).alias("market"),
        part(2).alias("product_type"),
        F.try_to_date(part(3), "yyyy-MM-dd").alias("period_start"),
        F.try_to_date(part(4), "yyyy-MM-dd").alias("period_end"),
    )


def outside_named_period(rows: DataFrame, path: str = "source_file", date: str = "delivery_date") -> DataFrame:
    """Rows whose date lies outside the period in their file's name."""
    named = file_name_lineage(F.col(path))
    return rows.filter(
        named["period_start"].isNotNull() & ~F.col(date).between(named["period_start"], named["period_end"])
    )
