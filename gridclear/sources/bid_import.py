"""One import of bid sheets: parsed once, split into what can be loaded and what not, and stored without losing either."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclear.operators.cleaning import accepted_bids, read_bids, refused_bids, route_invalid_sheets
from gridclear.operators.reconcile import load_errors, load_summary
from gridclear.session import compiled_in_parts, scratch_dir
from gridclear.sources.period_table import PeriodTable
from gridclear.sources.workbooks import sheet_manifest, to_raw_bids, unreadable_sheets

DEAD_LETTERS = "source_file string, sheet string, reason string, raw string"


class BidImport:
    """Sheet rows (of ``scan_sheets``) and the files (path) they come from.

    The rows are stored once as parsed and once as read, so that checks, load, quarantine and counts parse nothing again.
    """

    def __init__(self, spark: SparkSession, rows: DataFrame, files: DataFrame):
        staging = scratch_dir(spark, "staging")
        with compiled_in_parts(spark):
            rows.write.parquet(f"{staging}/rows")
        self.rows = spark.read.parquet(f"{staging}/rows")
        self.manifest = sheet_manifest(self.rows)
        self.unreadable = unreadable_sheets(files, self.rows)
        self.first_unreadable = self.unreadable.head()
        valid, _ = route_invalid_sheets(self.rows)
        with compiled_in_parts(spark):
            as_it_came = F.when(F.col("reason").isNotNull(), F.col("raw"))  # of refused bids only
            read_bids(to_raw_bids(valid)).withColumn("raw", as_it_came).write.parquet(f"{staging}/read")
        self.read = spark.read.parquet(f"{staging}/read")

    def summary(self) -> DataFrame:
        return load_summary(self.manifest, self.unreadable)

    def sheet_errors(self) -> DataFrame:
        """(source_file, sheet, error) of sheets that cannot be loaded at all."""
        return load_errors(self.manifest, self.unreadable)

    def refused(self) -> DataFrame:
        return refused_bids(self.read)

    def errors(self) -> DataFrame:
        """(source_file, sheet, error): ``sheet_errors``, and the refused bids of the other sheets by reason."""
        counted = self.refused().groupBy("source_file", "sheet", "reason").agg(F.count("*").alias("n"))
        error = F.concat_ws(" ", F.col("n").cast("string"), F.lit("rows in quarantine:"), "reason")
        return self.sheet_errors().unionByName(counted.select("source_file", "sheet", error.alias("error")))

    def dead_letters(self) -> DataFrame:
        """(source_file, sheet, reason, raw): a row per refused bid, with what it said as JSON, and per sheet that cannot be loaded."""
        bids = self.read.filter("reason IS NOT NULL").select("source_file", "raw.sheet", "reason", F.to_json("raw").alias("raw"))
        sheets = self.sheet_errors().select("source_file", "sheet", F.col("error").alias("reason"), F.lit(None).cast("string").alias("raw"))
        return bids.unionByName(sheets)

    def store(self, table: PeriodTable, operation: str, source_files: Iterable[str] = ()) -> None:
        """Replaces the days of the accepted bids, and empties days between them that the import lacks.

        A day is not lacking because its bids were refused: it keeps what is stored.  Where it isn't known what days are meant, as a
        date or a sheet cannot be read, no day is emptied.
        """
        accepted = accepted_bids(self.read)
        days = {row[0] for row in self.read.filter("reason IS NOT NULL").select("delivery_date").distinct().collect()}  # calendar days
        if None in days or not self.sheet_errors().isEmpty():
            table.replace_partitions(accepted, operation, source_files)
        else:
            table.replace_range(accepted, operation, source_files, spare=days)
