"""Raw text rows to typed activations and bids, and the checks on the way."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.functions import parsing as ps
from gridclear.functions import timecode as tc
from gridclear.operators.rules import Rule, check_rules
from gridclear.schema import (
    ACTIVATION_COLUMNS,
    BIDS,
    BIDS_RAW,
    POWER,
    PRICE,
    REQUIRED_BID_COLUMNS,
    apply_aliases,
    conform_to_schema,
    quoted,
    trim_column_names,
)

ZONE_COLUMN = "50Hertz (Negativ)"
# How times of day and product codes are spelt.
TIME_PATTERN = r"^\d{2}:\d{2}(:\d{2})?$"
PRODUCT_PATTERN = r"^[A-Z]+_\d+"


# --- activations ---------------------------------------------------------------------------------


def select_activation_columns(raw: DataFrame, zone: str = ZONE_COLUMN) -> DataFrame:
    """Date, start, end and the volume of one control zone; fails if a column is absent."""
    trimmed = trim_column_names(raw)
    wanted = ["Datum", "von", "bis", zone]
    missing = [name for name in wanted if name not in trimmed.columns]
    if missing:
        raise ValueError(f"missing activation columns: {missing}")
    return trimmed.select(*[quoted(name) for name in wanted])


def clean_activations(selected: DataFrame, zone: str = ZONE_COLUMN) -> DataFrame:
    """Typed date (a bad one fails), times with seconds, and the volume as a number (a bad one is NULL)."""
    return selected.withColumns(
        {
            "Datum": ps.german_date(F.col("Datum")),
            "von": ps.with_seconds(F.col("von")),
            "bis": ps.with_seconds(F.col("bis")),
            zone: ps.decimal_comma(quoted(zone)),
        }
    )


def validate_activations(cleaned: DataFrame, zone: str = ZONE_COLUMN) -> DataFrame:
    """One row: ``valid``, and as ``message`` the code of the first rule that fails with the rows at fault, else ``ok``."""
    columns = [*ACTIVATION_COLUMNS[:3], zone]
    missing = [name for name in columns if name not in cleaned.columns]
    if missing:
        message = F.lit(f"columns_absent: {', '.join(missing)}")
        return cleaned.sparkSession.range(1).select(F.lit(False).alias("valid"), message.alias("message"))

    def bad_times(name: str) -> Column:
        return F.count_if(~F.coalesce(F.col(name).rlike(TIME_PATTERN), F.lit(False)))

    typed_date = dict(cleaned.dtypes)["Datum"] in ("date", "timestamp", "timestamp_ntz")
    undated = F.count_if(F.lit(not typed_date))
    return first_failure(
        cleaned, {"date_not_typed": undated, "start_time": bad_times("von"), "end_time": bad_times("bis"), "volume_not_numeric": F.count_if(quoted(zone).isNull())}
    )


def first_failure(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row (valid, message) from counts of the rows that break each rule, in one pass; ``no_rows`` if there are none."""
    counts = df.agg(F.count("*").alias("rows"), *[count.alias(name) for name, count in rules.items()])
    message = F.when(F.col("rows") == 0, "no_rows")
    for name in rules:
        message = message.when(F.col(name) > 0, F.concat(F.lit(f"{name}: "), F.col(name).cast("string")))
    return counts.select(message.isNull().alias("valid"), F.coalesce(message, F.lit("ok")).alias("message"))


def to_activations(raw: DataFrame, zone: str = ZONE_COLUMN) -> DataFrame:
    """Raw activation text to the canonical table; the time-zone column is kept if the file has one."""
    trimmed = trim_column_names(raw)
    zone_name = F.col("Zeitzone") if "Zeitzone" in trimmed.columns else F.lit(None).cast("string")
    date, quarter = F.col("date"), F.col("quarter_no")
    return (
        trimmed.select(
            ps.german_date(F.col("Datum")).alias("date"),
            tc.quarter_of_time(F.col("von")).alias("quarter_no"),
            ps.decimal_comma(quoted(zone)).alias("activated_volume_mw"),
            zone_name.alias("time_zone"),
            *[F.col(c) for c in ("source_file", "load_timestamp") if c in trimmed.columns],
        )
        .withColumns(
            {
                "interval_start": tc.interval_start(date, quarter),
                "quarter_hour_start": tc.quarter_start(quarter),
                "quarter_hour_end": tc.quarter_end(quarter),
                "month": F.month(date),
                "year": F.year(date),
            }
        )
    )


def activation_problem(zone: str = ZONE_COLUMN) -> Column:
    """Why a raw activation row cannot be loaded, NULL if it can: a date, time of day or volume that is not to be read as it is."""
    date, volume = F.trim("Datum"), quoted(zone)
    readable = date.rlike(ps.layout_pattern(ps.GERMAN_DATE)) & F.try_to_date(date, ps.GERMAN_DATE).isNotNull()
    reason = F.when(~F.coalesce(readable, F.lit(False)), "unreadable date")
    for name in ("von", "bis"):
        reason = reason.when(~F.coalesce(ps.with_seconds(F.col(name)).rlike(TIME_PATTERN), F.lit(False)), "unreadable time")
    return reason.when(ps.decimal_comma(volume).isNull() | ps.unreadable_number(volume), "unreadable volume")


def add_month_year(df: DataFrame, date_column: str = "date") -> DataFrame:
    return df.withColumns({"month": F.month(date_column), "year": F.year(date_column)})


def outside_month(df: DataFrame, month: int, year: int, date_column: str = "date") -> DataFrame:
    """Rows an import of one month must not contain."""
    return df.filter((F.month(date_column) != month) | (F.year(date_column) != year) | F.col(date_column).isNull())


def duplicate_intervals(activations: DataFrame) -> DataFrame:
    """Quarter-hours listed more than once, as on the night clocks go back."""
    return (
        activations.groupBy("date", "quarter_no")
        .agg(F.count("*").alias("row_count"), F.count_distinct("time_zone").alias("time_zones"))
        .filter("row_count > 1")
    )


def standardize_date_column(df: DataFrame, column: str, layout: str | None = None, strict: bool = True) -> DataFrame:
    """Text to timestamp.  Without a layout the known ones are tried; an absent column changes nothing.

    ``strict`` fails on an unreadable value, otherwise it becomes NULL.
    """
    if column not in df.columns:
        return df
    text = quoted(column)
    if layout and strict:
        parsed = F.to_timestamp_ntz(text, F.lit(layout))
    elif layout:
        parsed = F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")
    else:
        known = [F.when(text.rlike(ps.layout_pattern(p)), F.try_to_timestamp(text, F.lit(p))) for p in ps.DATE_LAYOUTS]
        parsed = F.coalesce(*known).cast("timestamp_ntz")
        if strict:
            unreadable = F.concat(F.lit(f"unreadable date in {column}: "), text)
            parsed = F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(
                F.raise_error(unreadable).cast("timestamp_ntz")
            )
    return df.withColumn(column, parsed)


# --- bids ----------------------------------------------------------------------------------------


def drop_positive_products(df: DataFrame, product: str = "PRODUCT") -> DataFrame:
    """Rows whose product does not begin with ``POS_``; rows without a product are left out (see ``without_product``)."""
    return df.filter(~quoted(product).startswith("POS_"))


#: Numbers of a bid: where the raw text is, the typed column, and what a number that cannot be read is called.
BID_NUMBERS = [
    ("ENERGY_PRICE_[EUR/MWh]", "energy_price_eur_mwh", "unreadable price"),
    ("ALLOCATED_CAPACITY_[MW]", "allocated_capacity_mw", "unreadable capacity"),
    ("OFFERED_CAPACITY_[MW]", "offered_capacity_mw", "unreadable capacity"),
]


def bid_problem() -> Column:
    """Why a raw bid cannot be loaded, NULL if it can: no product, or a date or number that is not to be read as it is.

    Asked of typed columns beside the raw text, so nothing is parsed for it.
    """
    reason = F.when(F.col("product").isNull() | (F.trim("product") == ""), "no product")
    reason = reason.when(F.col("delivery_date").isNull(), "unreadable date")
    for text, typed, problem in BID_NUMBERS:
        wide = F.col(f"{typed}_wide")
        exact = F.col(typed).isNotNull() | F.coalesce(wide.try_cast(PRICE) == wide, F.lit(False))
        reason = reason.when((F.trim(F.col("raw")[text]) != "") & ~exact, problem)
    return reason


def quarantined_bids(raw: DataFrame) -> DataFrame:
    """Raw bids that ``clean_bids`` leaves out, as they came, with the ``reason``."""
    return refused_bids(read_bids(raw))


def without_product(df: DataFrame, product: str = "PRODUCT") -> DataFrame:
    """Rows to quarantine because they name no product."""
    return df.filter(quoted(product).isNull())


def read_bids(raw: DataFrame) -> DataFrame:
    """Raw bid text read once: the typed columns of the canonical table, the ``reason`` why a bid cannot be loaded, and the row as it came.

    Store the result where loaded bids, refused ones and counts are all wanted.
    """
    named = conform_to_schema(apply_aliases(raw), BIDS_RAW)
    wide = T.DecimalType(38, 12)
    parsed = named.select(
        F.struct(*[quoted(f.name) for f in BIDS_RAW.fields]).alias("raw"),
        ps.parse_date(F.col("DELIVERY_DATE")).alias("delivery_date"),
        F.col("PRODUCT").alias("product"),
        *[ps.short_decimal_comma(quoted(text)).alias(typed) for text, typed, _ in BID_NUMBERS],
        *[F.when(ps.short_decimal_comma(quoted(text)).isNull(), ps.decimal_comma(quoted(text), wide)).alias(f"{typed}_wide") for text, typed, _ in BID_NUMBERS],
        F.col("ENERGY_PRICE_PAYMENT_DIRECTION").alias("payment_direction"),
        F.col("TYPE_OF_RESERVES").alias("type_of_reserves"),
        F.col("COUNTRY").alias("country"),
        F.col("NOTE").alias("note"),
        "source_file",
        tc.quarter_of_product(F.col("PRODUCT")).alias("quarter"),
    )
    typed = {name: F.coalesce(name, F.col(f"{name}_wide").try_cast(POWER)) for _, name, _ in BID_NUMBERS}
    typed["energy_price_eur_mwh"] = ps.signed_price(typed["energy_price_eur_mwh"].cast(PRICE), F.col("payment_direction")).cast(PRICE)
    columns = [c for c in parsed.columns if not c.endswith("_wide")]
    return parsed.select(*[typed.get(c, F.col(c)).alias(c) for c in columns], bid_problem().alias("reason"))


def accepted_bids(read: DataFrame) -> DataFrame:
    """The canonical table of bids that ``read_bids`` found nothing against, without positive products.

    How many rows are read and refused is observed, for listeners of the session.  Filters do not pass an observation, so the optimizer
    doesn't repeat the parsing in them.
    """
    counts = [F.count("*").alias("read"), F.count("reason").alias("refused")]
    typed = drop_positive_products(read.observe(f"bids-{uuid.uuid4().hex}", *counts).filter("reason IS NULL"), "product")
    date, quarter = F.col("delivery_date"), F.col("quarter")
    return typed.withColumns(
        {"block_start": tc.block_start(date, quarter), "block_end": tc.block_end(date, quarter), "load_timestamp": F.current_timestamp()}
    ).select(*[f.name for f in BIDS.fields])


def refused_bids(read: DataFrame) -> DataFrame:
    """Bids that ``read_bids`` found a reason against, as they came."""
    return read.filter("reason IS NOT NULL").select("raw.*", "reason")


def clean_bids(raw: DataFrame) -> DataFrame:
    """Raw bid text to the canonical table: negative products, signed prices, typed dates and numbers.

    No value is rounded or replaced: bids with one that cannot be read are those of ``quarantined_bids``.  Empty numbers stay NULL.
    """
    return accepted_bids(read_bids(raw))


def sort_clean_bids(bids: DataFrame) -> DataFrame:
    """By delivery date, then signed price, cheapest first; further columns split equal prices over tasks."""
    rest = [c for c in ("product", "allocated_capacity_mw", "source_file") if c in bids.columns]
    return bids.orderBy(
        F.col("delivery_date").asc_nulls_last(), F.col("energy_price_eur_mwh").asc_nulls_last(), *rest
    )


def tag_lineage(df: DataFrame, file_column: Column | None = None) -> DataFrame:
    """Source file and load time of every row."""
    source = F.col("_metadata.file_path") if file_column is None else file_column
    return df.select("*", source.alias("source_file"), F.current_timestamp().alias("load_timestamp"))


def period_bucket(bids: DataFrame) -> DataFrame:
    """The four-hour block of every bid: index, label, start and end."""
    quarter = tc.quarter_of_product(F.col("product"))
    index = tc.block_index(quarter)
    return bids.withColumns(
        {
            "block_index": index,
            "block": tc.block_label(index),
            "block_start": tc.block_start(F.col("delivery_date"), quarter),
            "block_end": tc.block_end(F.col("delivery_date"), quarter),
        }
    )


def missing_columns(df: DataFrame, required: list[str] = REQUIRED_BID_COLUMNS) -> list[str]:
    return [name for name in required if name not in df.columns]


def validate_bid_columns(sheets: DataFrame, required: list[str] = REQUIRED_BID_COLUMNS) -> DataFrame:
    """Per (file, sheet) with an array column ``header``: the required columns it lacks."""
    absent = F.array_except(F.array(*[F.lit(c) for c in required]), F.col("header"))
    return sheets.withColumn("missing_columns", absent).withColumn("is_valid", F.size("missing_columns") == 0)


class InvalidSheets(ValueError):
    """An all-or-nothing import met a sheet without the required columns."""


def route_invalid_sheets(
    rows: DataFrame, required: list[str] = REQUIRED_BID_COLUMNS, all_or_nothing: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows of valid sheets, and rows of the others; with ``all_or_nothing`` any invalid sheet fails the import.

    Every row carries its sheet's header, so both parts are filters of one scan, without a join.
    """
    complete = F.size(F.array_except(F.array(*[F.lit(c) for c in required]), F.col("header"))) == 0
    is_valid = F.coalesce(complete, F.lit(False))  # rows of a sheet without a header are not valid
    if all_or_nothing:
        first = rows.filter(~is_valid).select("source_file", "sheet").head(1)
        if first:
            raise InvalidSheets(f"{first[0]['source_file']} [{first[0]['sheet']}] lacks required columns")
    return rows.filter(is_valid), rows.filter(~is_valid)


def validate_bids(bids: DataFrame) -> DataFrame:
    """One row: ``valid``, and as ``message`` the code of the first rule that fails with the rows at fault, else ``ok``."""
    needed = ["delivery_date", "product", "energy_price_eur_mwh", "allocated_capacity_mw"]
    absent = [name for name in needed if name not in bids.columns]
    if absent:
        raise ValueError(f"columns absent after cleaning: {absent}")
    rules = {f"{name}_absent": F.count_if(F.col(name).isNull()) for name in needed if name != "product"}
    rules["product_code"] = F.count_if(~F.coalesce(F.col("product").rlike(PRODUCT_PATTERN), F.lit(False)))
    return first_failure(bids, rules)


def quality_rules(
    bids: DataFrame,
    first_date: str,
    last_date: str,
    price_limits: tuple[float, float] = (-99999.0, 99999.0),
    max_capacity_mw: float = 5000.0,
) -> DataFrame:
    """Rows failing each rule, all rules in one pass: ``(rule, failed_rows, checked_rows)``.  ``bid_rules`` are the rules."""
    return check_rules(bids, bid_rules(first_date, last_date, price_limits, max_capacity_mw))


def bid_rules(
    first_date: str,
    last_date: str,
    price_limits: tuple[float, float] = (-99999.0, 99999.0),
    max_capacity_mw: float = 5000.0,
) -> list[Rule]:
    """The rules for bids, which can be stored as rows of a table and extended there."""
    price, capacity = "energy_price_eur_mwh", "allocated_capacity_mw"
    return [
        Rule("date_in_range", "range", ("delivery_date",), first_date, last_date),
        Rule("product_pattern", "pattern", ("product",), pattern=PRODUCT_PATTERN),
        Rule("price_in_range", "range", (price,), *map(str, price_limits)),
        Rule("capacity_in_range", "range", (capacity,), "0", str(max_capacity_mw)),
        Rule("no_nulls", "not_null", ("delivery_date", "product", price, capacity)),
    ]
