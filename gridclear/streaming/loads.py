"""Landing folders read as streams: each run takes the files no earlier run has taken.

The effect of a batch is a replacement of periods, so a batch that is repeated after a failure changes
nothing more.  Loads by file (``load_activation_files``, ``bid_workbook_load``) check each file and row on its own: what cannot be loaded
goes to the table's dead letters, the rest is loaded, and a ledger knows the batches that are done.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclear.functions.parsing import GERMAN_DATE, layout_pattern
from gridclear.operators.cleaning import ZONE_COLUMN, activation_problem, to_activations
from gridclear.operators.reconcile import latest_per_interval
from gridclear.schema import conform_to_schema, quoted
from gridclear.session import scratch_dir
from gridclear.sources.bid_import import DEAD_LETTERS, BidImport
from gridclear.sources.delimited import file_headers, header_names, scan_by_header, text_schema
from gridclear.sources.landing import file_name
from gridclear.sources.period_table import PeriodTable
from gridclear.sources.small_files import move_into
from gridclear.sources.workbooks import scan_sheets
from gridclear.streaming.ledger import Ledger

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
FILES_PER_BATCH = 1000  # names of files that the driver handles at a time
INTERVAL_KEY = ["date", "quarter_no", "time_zone"]


def _drain(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def activation_stream(
    spark: SparkSession, landing: str, columns: list[str], archive: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """New activation files of a landing folder, as text; processed files move to ``archive`` if given.

    The header of every file must name ``columns`` in this order: another one fails the batch instead of swapping columns.
    """
    reader = spark.readStream.schema(text_schema(columns)).option("sep", ";").option("header", True)
    reader = reader.option("enforceSchema", False).option("encoding", encoding)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(landing).select(
        "*",
        file_name(F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_modification_time").alias("load_timestamp"),
    )


def replace_days(table: PeriodTable, new: DataFrame, operation: str = "replace_days", merged: list[dt.date] | None = ()) -> None:
    """Replaces the days that ``new`` has rows for; all other days stay, whatever the table's partitions.

    Of the days ``merged`` (None: of all), stored intervals that ``new`` doesn't bring stay too.
    """
    days = new.select("date").distinct()
    whole = days.limit(0) if merged is None else days.filter(~F.col("date").isin(list(merged))) if merged else days
    kept = _touched(table, new).join(whole, "date", "left_anti")
    if merged is None or merged:
        brought = new.select(*[F.col(c).alias(f"new_{c}") for c in INTERVAL_KEY])
        kept = kept.join(brought, [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in INTERVAL_KEY], "left_anti")
    table.replace_partitions(kept.unionByName(new.select(*kept.columns)), operation)


def _touched(table: PeriodTable, new: DataFrame) -> DataFrame:
    """All rows of the partitions that ``new`` falls in: a write swaps whole partitions."""
    parts = new.select(*table.partition_by).distinct()
    return table.read().join(parts, table.partition_by, "left_semi").select(*[f.name for f in table.schema.fields])


def incremental_landing_load(stream: DataFrame, table: PeriodTable, checkpoint: str) -> None:
    """Loads what is new; the days that a batch has rows for are replaced."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = conform_to_schema(to_activations(batch), table.schema)
        replace_days(table, rows, f"stream batch {batch_id}")

    _drain(stream, checkpoint, apply)


def _paths(spark: SparkSession, landing: str) -> DataFrame:
    """Names of new files; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", FILES_PER_BATCH).load(landing).select("path")


def _drain_files(
    stream: DataFrame, landing: str, table: PeriodTable, checkpoint: str, load: Callable[[list[str], int, Ledger], dict], archive: str | None, rejected: str | None
) -> None:
    """``load`` takes the paths of a batch and returns its entry in the ledger, with the paths ``loaded`` and ``refused``."""
    ledger = Ledger(table, checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        entry = ledger.entry(batch_id)
        if entry is None:
            paths = sorted(row["path"] for row in batch.collect())  # FILES_PER_BATCH at most
            if not paths:
                return
            entry = load(paths, batch_id, ledger)
            ledger.record(batch_id, entry)
        for files, folder in ((entry["loaded"], archive), (entry["refused"], rejected)):
            if folder:
                move_into(table.spark, files, folder, landing)

    _drain(stream, checkpoint, apply)


def load_activation_files(
    spark: SparkSession,
    landing: str,
    table: PeriodTable,
    checkpoint: str,
    zone: str = ZONE_COLUMN,
    archive: str | None = None,
    rejected: str | None = None,
    encoding: str = "UTF-8",
) -> None:
    """Loads new activation files, each by its own header; files loaded move to ``archive``, others to ``rejected``, if given.

    A file without the columns is refused whole, a row that cannot be read by itself; both are dead letters with their reason.  Days that a batch has
    rows for are replaced.  A day with refused rows is merged instead: intervals that the batch doesn't bring stay; so are all days of a batch with a
    refused row whose date cannot be read.
    """
    columns = ["Datum", "Zeitzone", "von", "bis", zone]
    needed = [c for c in columns if c != "Zeitzone"]

    def load(paths: list[str], batch_id: int, ledger: Ledger) -> dict:
        found = {r["path"]: r["header"] for r in file_headers(spark, paths, encoding).collect()}
        by_name = {unquote(p.removeprefix("file:")).lstrip("/"): h for p, h in found.items()}
        headers, refused = {}, []
        for path in paths:
            header = by_name.get(unquote(path.removeprefix("file:")).lstrip("/"))
            absent = [c for c in needed if c not in header_names(header, ";")] if header else needed
            if absent:
                refused.append((path, f"columns absent: {', '.join(absent)}" if header else "no header row"))
            else:
                headers[path] = header
        with_zone = {p: h for p, h in headers.items() if "Zeitzone" in header_names(h, ";")}
        without = {p: h for p, h in headers.items() if p not in with_zone}
        raw = scan_by_header(spark, with_zone, columns, encoding=encoding).unionByName(
            scan_by_header(spark, without, needed, encoding=encoding).withColumn("Zeitzone", F.lit(None).cast("string"))
        )
        staging = scratch_dir(spark, "activations")
        raw.withColumn("reason", activation_problem(zone)).write.parquet(staging)
        read = spark.read.parquet(staging)
        bad = read.filter("reason IS NOT NULL")
        letters = bad.select("source_file", F.lit(None).cast("string").alias("sheet"), "reason", F.to_json(F.struct(*[quoted(c) for c in columns])).alias("raw"))
        named = [(p.rsplit("/", 1)[-1], None, reason, None) for p, reason in refused]
        ledger.write_dead_letters(batch_id, letters.unionByName(spark.createDataFrame(named, DEAD_LETTERS)))
        day = F.when(F.col("Datum").rlike(layout_pattern(GERMAN_DATE)), F.try_to_date(F.trim("Datum"), GERMAN_DATE))
        days = [r[0] for r in bad.select(day).distinct().collect()]  # calendar days
        rows = conform_to_schema(to_activations(read.filter("reason IS NULL"), zone), table.schema)
        replace_days(table, rows, f"stream batch {batch_id}", merged=None if None in days else days)
        return {"loaded": sorted(headers), "refused": [p for p, _ in refused]}

    _drain_files(_paths(spark, landing), landing, table, checkpoint, load, archive, rejected)


def bid_workbook_load(
    spark: SparkSession,
    landing: str,
    table: PeriodTable,
    checkpoint: str,
    archive: str | None = None,
    on_rejected: Callable[[DataFrame], None] | None = None,
    rejected: str | None = None,
) -> None:
    """Loads new sheets of bid workbooks; ``on_rejected`` gets (source_file, sheet, error) of those that cannot be loaded.

    Such sheets and refused bids are dead letters; neither empties a stored day.  Files of which nothing could be read move to ``rejected``, the
    others to ``archive``, if given.
    """

    def load(paths: list[str], batch_id: int, ledger: Ledger) -> dict:
        found = BidImport(spark, scan_sheets(spark, *paths, base=landing), spark.createDataFrame([(p,) for p in paths], "path string"))
        if on_rejected is not None:
            on_rejected(found.sheet_errors())
        ledger.write_dead_letters(batch_id, found.dead_letters())
        found.store(table, f"stream batch {batch_id}")
        bad = {(r["source_file"], r["sheet"]) for r in found.unreadable.collect()}  # sheets of FILES_PER_BATCH files

        def is_bad(path: str) -> bool:
            parts = dict(p.split("=", 1) for p in unquote(path).split("/") if "=" in p)
            return (parts.get("source_file"), parts.get("sheet")) in bad

        return {"loaded": [p for p in paths if not is_bad(p)], "refused": [p for p in paths if is_bad(p)]}

    _drain_files(_paths(spark, landing), landing, table, checkpoint, load, archive, rejected)


def merge_latest(table: PeriodTable, new: DataFrame, operation: str = "upsert_interval") -> None:
    """One row per interval, the one loaded last; the partitions that the import falls in are read and rewritten as a whole."""
    merged = latest_per_interval(_touched(table, new).unionByName(new), INTERVAL_KEY, ["load_timestamp", "source_file"])
    table.replace_partitions(merged, operation)


def latest_activation_stream(stream: DataFrame, table: PeriodTable, checkpoint: str) -> None:
    """A corrected value replaces the earlier one of its interval."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_latest(table, conform_to_schema(to_activations(batch), table.schema), f"stream batch {batch_id}")

    _drain(stream, checkpoint, apply)
