"""Profiles and quality checks that work on any table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.operators.quantiles import exact_quantiles
from gridclear.schema import quoted

# Words that mark a note as an error, and words counted in note statistics.
ERROR_WORDS = ["error", "fail", "invalid", "missing", "cannot", "wrong"]
NOTE_KEYWORDS = ["error", "warning", "invalid", "missing", "correction"]


def row_key(names: list[str]) -> Column:
    """256 bits that stand for the values of some columns, NULL like any other value: no text goes through a shuffle."""
    values = F.to_json(F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(names)]), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(values, 256))


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, duplicates, and the columns.

    One aggregation by a hash of the whole row; copies of a row combine before the shuffle.
    """
    names = df.columns
    per_row = df.groupBy(row_key(names).alias("_key")).agg(F.count("*").alias("_copies"))
    return per_row.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"), F.count("*").alias("distinct_rows")
    ).select(
        "row_count",
        "distinct_rows",
        (F.col("row_count") - F.col("distinct_rows")).alias("duplicate_rows"),
        F.lit(len(names)).alias("column_count"),
        F.lit(",".join(names)).alias("columns"),
    )


def table_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, whether it may be NULL."""
    fields = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*fields)))


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, value, n)`` for every distinct value of every column, values as text.

    Each column is counted by itself, in its own type, from a scan of that column alone; equal values combine before the shuffle.
    """
    counted = [
        df.groupBy(quoted(c).alias("value"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(c).alias("column_name"), F.col("value").cast("string").alias("value"), "n")
        for c in columns or df.columns
    ]
    return reduce(DataFrame.unionByName, counted)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, unique_values)``, each from a scan of one column; texts are told apart by a hash of 256 bits."""
    kinds = dict(df.dtypes)
    counted = []
    for c in columns:
        value = F.unhex(F.sha2(quoted(c), 256)) if kinds[c] == "string" else quoted(c)
        distinct = df.filter(quoted(c).isNotNull()).select(value.alias("value")).distinct()
        counted.append(distinct.agg(F.count("*").alias("unique_values")).select(F.lit(c).alias("column_name"), "unique_values"))
    return reduce(DataFrame.unionByName, counted)


def column_profile(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Per column: rows, distinct values, NULLs, extremes, uniqueness and completeness.

    All but the distinct values come from one aggregation; ``approximate`` estimates these there too.
    """
    names = columns or df.columns
    aggs = []
    for i, c in enumerate(names):
        value = quoted(c)
        aggs += [F.count(value).alias(f"f{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
        if approximate:
            aggs.append(F.approx_count_distinct(value, 0.01).alias(f"d{i}"))
    rows = []
    for i, c in enumerate(names):
        fields = [
            F.lit(c).alias("column_name"), F.col("total").alias("total_count"), F.col(f"f{i}").alias("filled_count"),
            F.col(f"lo{i}").cast("string").alias("min_value"), F.col(f"hi{i}").cast("string").alias("max_value"),
        ]
        rows.append(F.struct(*fields, *([F.col(f"d{i}").alias("unique_values")] if approximate else [])))
    counts = df.agg(F.count("*").alias("total"), *aggs).select(F.inline(F.array(*rows)))
    if not approximate:
        counts = counts.join(distinct_counts(df, names), "column_name")
    ratio = F.coalesce(F.try_divide(F.col("unique_values").cast("double"), F.col("filled_count")), F.lit(0.0))
    full = F.coalesce(F.try_divide(F.col("filled_count").cast("double"), F.col("total_count")), F.lit(0.0))
    return counts.select(
        "column_name",
        "total_count",
        "unique_values",
        (F.col("total_count") - F.col("filled_count")).alias("null_count"),
        "filled_count",
        "min_value",
        "max_value",
        ratio.alias("uniqueness_ratio"),
        full.alias("completeness_ratio"),
    )


def data_quality_issues(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(issue, column_name, metric)``: many NULLs, few distinct values, or nearly unique values."""
    nulls = F.col("null_count") * F.lit(100.0) / F.col("total_count")
    few = (F.col("unique_values") > 1) & (F.col("unique_values") < 5) & (F.col("total_count") > 100)
    findings = [
        F.when((F.col("null_count") > 0) & (nulls > 10), F.struct(F.lit("missing_values").alias("issue"), nulls.alias("metric"))),
        F.when(few, F.struct(F.lit("low_cardinality").alias("issue"), F.col("unique_values").cast("double").alias("metric"))),
        F.when(
            F.col("uniqueness_ratio") > 0.9,
            F.struct(F.lit("potential_id_columns").alias("issue"), F.col("uniqueness_ratio").alias("metric")),
        ),
    ]
    return (
        column_profile(df, columns)
        .select("column_name", F.explode(F.array_compact(F.array(*findings))).alias("f"))
        .select(F.col("f.issue").alias("issue"), "column_name", F.col("f.metric").alias("metric"))
    )


def describe_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: filled rows, distinct values, the most frequent value and its count, and the mean of numbers."""
    names = columns or df.columns
    kinds = dict(df.dtypes)
    top = F.max_by(
        F.struct("value", "n"),
        F.struct(F.when(F.col("value").isNotNull(), F.col("n")).alias("n"), F.col("value")),
    )
    counts = (
        value_counts(df, names)
        .filter(F.col("value").isNotNull())
        .groupBy("column_name")
        .agg(F.sum("n").alias("count"), F.count("*").alias("unique"), top.alias("top"))
    )

    def is_number(name: str) -> bool:
        return kinds[name].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

    means = df.agg(
        *[
            (F.avg(quoted(c)).cast("double") if is_number(c) else F.lit(None).cast("double")).alias(f"m{i}")
            for i, c in enumerate(names)
        ]
    ).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mean")) for i, c in enumerate(names)]
            )
        )
    )
    return (
        means.join(counts, "column_name", "left")
        .select(
            "column_name",
            F.coalesce("count", F.lit(0)).alias("count"),
            F.coalesce("unique", F.lit(0)).alias("unique"),
            F.col("top.value").alias("top"),
            F.col("top.n").alias("freq"),
            "mean",
        )
    )


def column_distribution(df: DataFrame, column: str, n: int = 100) -> DataFrame:
    """The ``n`` most frequent values with their share of all rows, NULL rows included in the total."""
    total = df.agg(F.count("*")).scalar()
    return (
        df.filter(quoted(column).isNotNull())
        .groupBy(quoted(column).alias("value"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "value")
        .limit(n)
        .withColumn("percentage", F.col("count") * F.lit(100.0) / total)
    )


def outliers(df: DataFrame, column: str, method: str = "iqr", multiplier: float | None = None) -> DataFrame:
    """Rows outside ``q1 - k*iqr .. q3 + k*iqr``, or outside ``mean -/+ k*std``.

    The fences become literals, so the scan filters on them.  Mean and deviation are those of the finite values; infinite values lie
    outside, NaN and NULL are no outliers.
    """
    number = quoted(column).cast("double")
    if method == "iqr":
        k = 1.5 if multiplier is None else multiplier
        q1, q3 = exact_quantiles(df, quoted(column), [0.25, 0.75])
        fences = None if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    elif method == "stddev":
        k = 3.0 if multiplier is None else multiplier
        finite = F.when(F.abs(number) < F.lit(float("inf")), number)
        mean, std = df.agg(F.avg(finite), F.stddev_samp(finite)).first()
        fences = None if std is None else (mean - k * std, mean + k * std)
    else:
        raise ValueError("method must be 'iqr' or 'stddev'")
    if fences is None:
        return df.limit(0)
    return df.filter(~F.isnan(number) & ((number < fences[0]) | (number > fences[1])))


def note_analysis(df: DataFrame, note: str = "note", n: int | None = 10) -> DataFrame:
    """Distinct non-empty notes by frequency, whether each reads like an error, and counts of both kinds.

    Without a note column: one row with ``exists`` false.  ``n`` None returns every note.
    """
    if note not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit(False).alias("exists"),
            F.lit(None).cast("string").alias("note"),
            *[F.lit(None).cast("long").alias(c) for c in ("frequency",)],
            F.lit(None).cast("boolean").alias("is_error"),
            *[F.lit(None).cast("long").alias(c) for c in ("total_notes", "error_count", "non_error_count")],
        )
    filled = df.filter(quoted(note).isNotNull() & (quoted(note) != "")).select(quoted(note).alias("note"))
    # Totals go by hashes, so texts are shuffled for the frequencies alone.
    kinds = _with_error_flag(filled).groupBy(F.unhex(F.sha2("note", 256)).alias("key")).agg(F.max("is_error").alias("is_error"))
    totals = kinds.agg(
        F.struct(
            F.count("*").alias("total_notes"),
            F.count_if("is_error").alias("error_count"),
            F.count_if(~F.col("is_error")).alias("non_error_count"),
        )
    )
    notes = filled.groupBy("note").agg(F.count("*").alias("frequency"))
    ranked = notes if n is None else notes.orderBy(F.desc("frequency"), "note").limit(n)
    return (
        _with_error_flag(ranked)
        .select(F.lit(True).alias("exists"), "note", "frequency", "is_error", totals.scalar().alias("t"))
        .select("exists", "note", "frequency", "is_error", "t.*")
    )


def _with_error_flag(notes: DataFrame) -> DataFrame:
    """Whether a note holds any of the error words; each note is lower-cased once."""
    hits = [F.col("_lower").contains(word) for word in ERROR_WORDS]
    return (
        notes.withColumn("_lower", F.lower("note"))
        .withColumn("is_error", reduce(Column.__or__, hits))
        .drop("_lower")
    )


def note_statistics(df: DataFrame, note: str = "note") -> DataFrame:
    """``(section, item, n)``: fill counts, length histogram and keyword counts of a note column, in one scan."""
    text = quoted(note)
    flags = {
        ("basic", "total_rows"): F.lit(True),
        ("basic", "non_null_notes"): text.isNotNull(),
        ("basic", "null_notes"): text.isNull(),
        ("basic", "non_empty_notes"): F.trim(text) != "",
        ("basic", "empty_notes"): F.trim(text) == "",
        **{("keyword", word): text.contains(word) for word in NOTE_KEYWORDS},
    }
    counted = df.groupBy(F.length(text).alias("length")).agg(
        F.count("*").alias("rows"), *[F.count_if(flag).alias(f"f{i}") for i, flag in enumerate(flags.values())]
    )
    histogram = counted.filter("length IS NOT NULL").select(
        F.lit("length").alias("section"), F.col("length").cast("string").alias("item"), F.col("rows").alias("n")
    )
    totals = counted.agg(*[F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(flags))])
    rows = [
        F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"), F.col(f"f{i}").alias("n"))
        for i, (section, item) in enumerate(flags)
    ]
    return histogram.unionByName(totals.select(F.inline(F.array(*rows))))


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once, with the count; NULL keys count as equal.

    Keys are counted by a hash, with partial sums, then joined back.  A key that holds much of the table makes one
    large join partition on the row side only, which adaptive execution splits.
    """
    keyed = df.withColumn("_key", row_key(keys))
    counts = keyed.groupBy("_key").agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")
    return keyed.join(counts, "_key").drop("_key")


def missing_dates(df: DataFrame, column: str) -> DataFrame:
    """Days between the first and last date on which the table has no row."""
    days = df.select(quoted(column).cast("date").alias("day")).distinct()
    span = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = span.filter("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    return calendar.join(days, "day", "left_anti").select(F.col("day").alias("missing_date"))


def first_time_column(df: DataFrame) -> str | None:
    """The first column of a date or timestamp type."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return next((f.name for f in df.schema.fields if isinstance(f.dataType, kinds)), None)


def table_summary(name: str, df: DataFrame) -> DataFrame:
    """One row: columns with types, rows, and the range of the first date or time column."""
    time_column = first_time_column(df)
    aggs = [F.count("*").alias("row_count")]
    if time_column:
        aggs += [F.min(quoted(time_column)).alias("lo"), F.max(quoted(time_column)).alias("hi")]
    result = df.agg(*aggs)
    if not time_column:
        result = result.withColumn("lo", F.lit(None)).withColumn("hi", F.lit(None))
    return result.select(
        F.lit(name).alias("table_name"),
        F.lit(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)).alias("columns"),
        "row_count",
        F.lit(time_column).cast("string").alias("range_column"),
        F.col("lo").cast("string").alias("range_min"),
        F.col("hi").cast("string").alias("range_max"),
    )


def table_summaries(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_summary(name, df) for name, df in tables.items()])


def table_samples(tables: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """The first ``n`` rows of every table as JSON."""
    rows = [
        df.limit(n).select(F.lit(name).alias("table_name"), F.to_json(F.struct(*[quoted(c) for c in df.columns])).alias("row"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def export_database_summary(tables: dict[str, DataFrame], path: str, n: int = 5) -> None:
    """Summaries and sample rows of all tables as JSON, in ``tables`` and ``samples`` under ``path``."""
    table_summaries(tables).write.mode("overwrite").json(f"{path}/tables")
    table_samples(tables, n).write.mode("overwrite").json(f"{path}/samples")


def list_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Table names with row and column counts; Parquet answers the row count from file footers."""
    rows = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# --- looking at rows -----------------------------------------------------------------------------


def search_rows(df: DataFrame, column: str, pattern: str, limit: int = 100, order: list[str] | None = None) -> DataFrame:
    """Up to ``limit`` rows whose column is ``LIKE`` the pattern, the first ones if an order is given."""
    found = df.filter(quoted(column).cast("string").like(pattern))
    return (found.orderBy(*[quoted(c) for c in order]) if order else found).limit(limit)


def non_empty_rows(df: DataFrame, column: str, limit: int = 100, order: list[str] | None = None, trim: bool = False) -> DataFrame:
    """Up to ``limit`` rows in which the column is filled."""
    text = quoted(column).cast("string")
    found = df.filter((F.trim(text) if trim else text) != "")
    return (found.orderBy(*[quoted(c) for c in order]) if order else found).limit(limit)


def preview_rows(df: DataFrame, n: int = 10, offset: int = 0, order: list[str] | None = None) -> DataFrame:
    """``n`` rows from position ``offset``."""
    ordered = df.orderBy(*[quoted(c) for c in order]) if order else df
    return (ordered.offset(offset) if offset else ordered).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column).alias("value")).distinct()

