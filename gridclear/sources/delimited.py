"""Delimited text: activation files, bid files, and checks before loading."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.schema import apply_aliases, trim_column_names
from gridclear.sources.landing import file_name

# Separators tried, in order of preference.
SEPARATORS = [";", ",", "\t"]
CORRUPT = "_corrupt_record"


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def scan_activation_csv(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Activation files as text columns with trimmed names and their ``source_file``.

    Types are never guessed; the header of every file must agree.
    """
    raw = (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("encoding", encoding)
        .csv(path)
    )
    return trim_column_names(raw.select("*", file_name(F.col("_metadata.file_path")).alias("source_file")))


def file_headers(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> DataFrame:
    """(path, header): the first line of each file that has one."""
    whole = spark.read.schema("value string").option("sep", "\u0001").option("quote", "").option("encoding", encoding).csv(paths)
    lines = whole.filter(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value"
    )
    return lines.filter("block = 0").groupBy("path").agg(F.min_by("value", "line").alias("header"))


def scan_by_header(
    spark: SparkSession, headers: dict[str, str], columns: list[str], sep: str = ";", encoding: str = "UTF-8"
) -> DataFrame:
    """``columns`` of files as text, each found by its own file's header (path to header line), with ``source_file`` and ``load_timestamp``.

    Files of one header are read together by the CSV source, so quoted separators and line ends are its matter; there are as many scans as headers.
    """
    groups: dict[str, list[str]] = {}
    for path, header in headers.items():
        groups.setdefault(header, []).append(path)
    found = spark.createDataFrame([], text_schema([*columns, "source_file"])).withColumn("load_timestamp", F.lit(None).cast("timestamp"))
    for header, paths in sorted(groups.items()):
        names = header_names(header, sep)
        reader = spark.read.schema(text_schema([f"c{i}" for i in range(len(names))])).option("sep", sep).option("header", True)
        rows = reader.option("encoding", encoding).csv(sorted(paths))
        found = found.unionByName(
            rows.select(
                *[F.col(f"c{names.index(c)}").alias(c) for c in columns],
                file_name(F.col("_metadata.file_path")).alias("source_file"),
                F.col("_metadata.file_modification_time").alias("load_timestamp"),
            )
        )
    return found


def header_names(header: str, sep: str) -> list[str]:
    """Names of a header line, without quotes, blanks and a byte order mark."""
    return [name.strip().strip('"').strip() for name in header.lstrip("\ufeff").split(sep)]


def scan_bid_csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """The named columns of bid files as text, found by each file's own header, NULL where a file lacks one.

    A line with more values than its header, or fewer, goes whole into ``_corrupt_record``.
    """
    # Whole lines: the text source knows UTF-8 only, the CSV source any encoding.
    whole = spark.read.schema("value string").option("sep", "\u0001").option("quote", "").option("encoding", encoding).csv(path)
    lines = (
        whole.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"), "value")
        .filter(F.trim("value") != "")
    )
    first = F.when(F.col("block") == 0, F.col("line"))
    heads = lines.groupBy("path").agg(F.min(first).alias("head"), F.min_by(F.when(first.isNotNull(), F.col("value")), first).alias("header"))
    names = F.transform(_values(F.col("header"), sep), F.trim)
    data = lines.join(heads.select("path", "head", names.alias("names")), "path").filter(F.col("line") != F.col("head"))
    parsed = data.select("path", "names", "value", _values(F.col("value"), sep).alias("values"))
    fits = F.size("names") == F.size("values")
    wanted = []
    for c in columns:
        place = F.array_position("names", c)
        wanted.append(F.when(fits & (place > 0), F.nullif(F.get("values", (place - 1).cast("int")), F.lit(""))).alias(c))
    found = parsed.select(*wanted, F.when(~fits, F.col("value")).alias(CORRUPT), file_name(F.col("path")).alias("source_file"))
    return apply_aliases(found)


def _values(line: Column, sep: str) -> Column:
    """Values of a line; a separator inside quotes does not part them, and a doubled quote stands for one."""
    part = re.escape(sep)
    outside = f'{part}(?=(?:[^"]*"[^"]*")*[^"]*$)'
    return F.transform(F.split(line, outside), lambda v: F.replace(F.regexp_replace(v, '^"|"$', ""), F.lit('""'), F.lit('"')))


def validate_delimited_files(spark: SparkSession, path: str, required: list[str], recursive: bool = False) -> DataFrame:
    """One row per file: separator, encoding, missing columns, rows, and whether it can be loaded.

    The separator is the one the header line holds most of.  Text that is no UTF-8 is taken for Latin-1.
    """
    lines = (
        spark.read.option("recursiveFileLookup", str(recursive).lower())
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
    )
    first_block = F.col("block") == 0
    per_file = lines.groupBy("path").agg(
        F.min_by(F.when(first_block, F.col("value")), F.when(first_block, F.col("line"))).alias("header"),
        F.count_if(F.trim("value") != "").alias("lines"),
        F.max(~F.is_valid_utf8("value")).alias("undecodable"),
    )
    found = [
        F.struct(
            (F.length("header") - F.length(F.replace(F.col("header"), F.lit(s), F.lit("")))).alias("n"),
            F.lit(-i).alias("preference"),
            F.lit(s).alias("sep"),
        )
        for i, s in enumerate(SEPARATORS)
    ]
    columns = F.transform(
        F.split(F.col("header"), F.concat(F.lit("["), F.col("sep"), F.lit("]"))),
        lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))),
    )
    known_type = F.lower("path").rlike(r"\.(csv|txt)$")
    return (
        per_file.withColumn("sep", F.greatest(*found)["sep"])
        .withColumn("missing_columns", F.array_except(F.array(*[F.lit(c) for c in required]), columns))
        .withColumn("row_count", F.greatest(F.col("lines") - 1, F.lit(0)))
        .select(
            "path",
            file_name(F.col("path")).alias("file_name"),
            "sep",
            F.when(F.col("undecodable"), "latin1").otherwise("utf-8").alias("encoding"),
            "missing_columns",
            "row_count",
            (known_type & (F.size("missing_columns") == 0) & (F.col("row_count") > 0)).alias("is_valid"),
        )
    )


def export_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False) -> None:
    """Header and rows as CSV; ``single_file`` is for extracts of a day or a month only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)

