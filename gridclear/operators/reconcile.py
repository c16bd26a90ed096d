"""Reports about loads: what was imported, from which file, and whether tables agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclear.functions.parsing import parse_date, to_german_text
from gridclear.schema import quoted


def import_date_range(rows: DataFrame, date_column: str = "DELIVERY_DATE") -> DataFrame:
    """First and last date per (file, sheet), and over all in the row without a file.

    Dates are compared as dates; unreadable and empty ones are left out.
    """
    per_sheet = rows.groupBy("source_file", "sheet").agg(
        F.min(parse_date(quoted(date_column))).alias("min_date"), F.max(parse_date(quoted(date_column))).alias("max_date")
    )
    overall = per_sheet.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date")).select(
        F.lit(None).cast("string").alias("source_file"), F.lit(None).cast("string").alias("sheet"), "min_date", "max_date"
    )
    return per_sheet.unionByName(overall)


def load_summary(sheets: DataFrame, unreadable: DataFrame | None = None) -> DataFrame:
    """Files, loaded sheets, loaded rows and number of errors of one import, rows also as report text.

    ``sheets`` has ``source_file``, ``sheet``, ``row_count``, ``is_valid`` and ``missing_columns``; ``unreadable`` has
    ``source_file`` and ``sheet``: such sheets count as processed and as errors.
    """
    every = sheets.select("source_file", "sheet", "is_valid", "row_count")
    if unreadable is not None:
        failed = unreadable.select("source_file", "sheet", F.lit(False).alias("is_valid"), F.lit(0).cast("long").alias("row_count"))
        every = every.join(failed.select("source_file", "sheet"), ["source_file", "sheet"], "left_anti").unionByName(failed)
    summary = every.agg(
        F.count_distinct("source_file").alias("files_processed"),
        F.count_if("is_valid").alias("sheets_loaded"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("row_count"))), F.lit(0)).alias("rows_loaded"),
        F.count_if(~F.col("is_valid")).alias("error_count"),
    )
    return summary.withColumn("rows_loaded_text", to_german_text(F.col("rows_loaded"), 0))


def load_errors(sheets: DataFrame, unreadable: DataFrame | None = None) -> DataFrame:
    """One row per rejected sheet with the reason."""
    lacking = F.concat(F.lit("required columns absent: "), F.array_join("missing_columns", ", "))
    reason = F.when(F.size("missing_columns") > 0, lacking).otherwise(F.lit("values beyond the header"))
    found = sheets.filter("NOT is_valid").select("source_file", "sheet", reason.alias("error"))
    return found if unreadable is None else found.unionByName(unreadable.select("source_file", "sheet", "error"))


def files_by_date_range(bids: DataFrame) -> DataFrame:
    """Per source file: date range, rows, days and distinct products."""
    per_product = bids.groupBy("source_file", "delivery_date", "product").agg(F.count("*").alias("rows"))
    return per_product.groupBy("source_file").agg(
        F.min("delivery_date").alias("min_date"),
        F.max("delivery_date").alias("max_date"),
        F.sum("rows").alias("row_count"),
        F.count_distinct("delivery_date").alias("days"),
        F.count_distinct("product").alias("products"),
    )


def load_reconciliation(source: DataFrame, target: DataFrame, date_column: str, key: list[str] | None = None) -> DataFrame:
    """Rows per date in source and target, whether they agree, and keys the target holds twice."""

    def per_date(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(quoted(date_column).alias("date")).agg(F.count("*").alias(name))

    both = per_date(source, "source_rows").join(per_date(target, "target_rows"), "date", "full_outer")
    result = both.select(
        "date",
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
    ).withColumn("is_equal", F.col("source_rows") == F.col("target_rows"))
    if key is None:
        return result
    keys = [date_column, *[k for k in key if k != date_column]]
    repeated = (
        target.groupBy(*[quoted(k) for k in keys])
        .agg(F.count("*").alias("n"))
        .groupBy(quoted(date_column).alias("date"))
        .agg(F.count_if(F.col("n") > 1).alias("repeated_keys"))
    )
    return result.join(repeated, "date", "left").withColumn("repeated_keys", F.coalesce("repeated_keys", F.lit(0)))


def numbered(rows: DataFrame, period: Column, order: list[str], name: str) -> DataFrame:
    """``rows`` with their position 1, 2, 3 ... by ``order``, whose first column ``period`` rises with.

    Rows are ordered within their period; the counts of the periods before, one row each, give where it begins.
    """
    placed = rows.withColumn("_period", period)
    before = Window.orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_period").agg(F.count("*").alias("_rows"))
    starts = counts.select("_period", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_period").orderBy(*[quoted(c) for c in order]))
    found = placed.withColumn("_within", within).join(starts.withColumnRenamed("_period", "_of"), F.col("_period").eqNullSafe(F.col("_of")))
    return found.select((F.col("_start") + F.col("_within")).cast("long").alias(name), *[quoted(c) for c in rows.columns])


def upload_order(rows: DataFrame, load_columns: list[str]) -> DataFrame:
    """Loads numbered 1, 2, 3 ... in order, with the rows each brought; there is one row per load.

    The first of ``load_columns`` is a date or a time.
    """
    loads = rows.groupBy(*[quoted(c) for c in load_columns]).agg(F.count("*").alias("row_count"))
    return numbered(loads, F.to_date(quoted(load_columns[0])), load_columns, "version_id")


def latest_per_interval(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key by ``order``; other columns break ties, so the result is always the same.

    An aggregate rather than a ranking window: copies of one key combine before the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    position = F.struct(*[quoted(c) for c in order], *[quoted(c) for c in rest if c not in order])
    picked = rows.groupBy(*[quoted(k) for k in keys]).agg(
        F.max_by(F.struct(*[quoted(c) for c in rest]), position).alias("_row")
    )
    return picked.select(*[quoted(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(*rows.columns)


def audit_columns(versions: DataFrame, keys: list[str], load_column: str = "load_timestamp") -> DataFrame:
    """Adds ``ingested_at``, ``effective_from`` and ``effective_to`` to rows kept from several loads.

    The window runs over the distinct load times of a key, which are as few as its loads.
    """
    loads = versions.select(*[quoted(k) for k in keys], quoted(load_column)).distinct()
    by_key = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(quoted(load_column))
    validity = loads.withColumn("effective_to", F.lead(quoted(load_column)).over(by_key))
    return versions.join(validity, [*keys, load_column]).select(
        *[quoted(c) for c in versions.columns],
        quoted(load_column).alias("ingested_at"),
        quoted(load_column).alias("effective_from"),
        "effective_to",
    )


def content_checksums(rows: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Per ``group``: rows, and two sums over them that don't depend on their order, of hashes of ``columns``.

    They tell multisets of rows apart: one is a plain sum, so repeated rows count, the other a bitwise one of a second hash.  NULLs are part of a
    hash by their place.  Both combine before the shuffle, so a group of any size is one row per task.
    """
    told = [part for c in columns for part in (quoted(c), quoted(c).isNull())]
    return rows.groupBy(*[quoted(c).alias(c) for c in group]).agg(
        F.count("*").alias("rows"),
        F.sum(F.xxhash64(*told).cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit("second"), *told)).alias("xor"),
    )


def reconcile_content(before: DataFrame, after: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Per ``group`` of either table: rows before and after, and whether their contents are ``equal``, ``changed``, ``missing`` or ``new``.

    Values that were exchanged or altered are found though counts agree.  Columns must have the same types on both sides.
    """
    old = content_checksums(before, group, columns).alias("old")
    new = content_checksums(after, group, columns).alias("new")
    same_group = [F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in group]
    same = (F.col("old.rows") == F.col("new.rows")) & (F.col("old.sum") == F.col("new.sum")) & (F.col("old.xor") == F.col("new.xor"))
    status = F.when(F.col("old.rows").isNull(), "new").when(F.col("new.rows").isNull(), "missing").when(same, "equal").otherwise("changed")
    return old.join(new, same_group, "full").select(
        *[F.coalesce(F.col(f"old.`{c}`"), F.col(f"new.`{c}`")).alias(c) for c in group],
        F.coalesce("old.rows", F.lit(0)).alias("rows_before"), F.coalesce("new.rows", F.lit(0)).alias("rows_after"), status.alias("status"),
    )
