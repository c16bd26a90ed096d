"""Quarter-hour numbers 1..96, product codes, four-hour blocks and calendars as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTERS_PER_DAY = 96
QUARTERS_PER_BLOCK = 16


def quarter_of_timestamp(ts: Column) -> Column:
    return (F.hour(ts) * 4 + F.floor(F.minute(ts) / 15) + 1).cast("int")


def quarter_of_time(hhmm: Column) -> Column:
    """``HH:mm`` or ``HH:mm:ss`` text to its quarter-hour number, NULL if unreadable."""
    parts = F.split(F.trim(hhmm), ":")
    hour = F.get(parts, F.lit(0)).try_cast("int")
    minute = F.get(parts, F.lit(1)).try_cast("int")
    return (hour * 4 + F.floor(minute / 15) + 1).cast("int")


def product_code(quarter_no: Column, prefix: str = "NEG") -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.lpad(quarter_no.cast("string"), 3, "0"))


def quarter_of_product(product: Column) -> Column:
    """The number in characters 5 to 7 of a product code, NULL if they are no number."""
    return F.substring(product, 5, 3).try_cast("int")


def clock(minutes: Column) -> Column:
    """Minutes since midnight as ``HH:mm``; midnight at the end of a day reads ``00:00``."""
    hours = F.lpad(F.floor(F.pmod(minutes, F.lit(1440)) / 60).cast("string"), 2, "0")
    rest = F.lpad(F.pmod(minutes, F.lit(60)).cast("string"), 2, "0")
    return F.concat(hours, F.lit(":"), rest)


def quarter_start(quarter_no: Column) -> Column:
    return clock((quarter_no - 1) * 15)


def quarter_end(quarter_no: Column) -> Column:
    return clock(quarter_no * 15)


def interval_start(date: Column, quarter_no: Column) -> Column:
    """Local wall time at which the quarter-hour begins."""
    return F.timestamp_add("MINUTE", (quarter_no - 1) * 15, date.cast("timestamp_ntz"))


def block_index(quarter_no: Column) -> Column:
    return F.floor((quarter_no - 1) / QUARTERS_PER_BLOCK).cast("int")


def block_start(date: Column, quarter_no: Column) -> Column:
    return F.timestamp_add("HOUR", block_index(quarter_no) * 4, date.cast("timestamp_ntz"))


def block_end(date: Column, quarter_no: Column) -> Column:
    return F.timestamp_add("HOUR", block_index(quarter_no) * 4 + 4, date.cast("timestamp_ntz"))


def block_label(index: Column) -> Column:
    def full_hour(hour: Column) -> Column:
        return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))

    return F.concat(full_hour(index * 4), F.lit("-"), full_hour(index * 4 + 4))


def calendar_points(span: DataFrame, step: str = "day") -> DataFrame:
    """Days, first days of months or first days of years touched by ``lo``..``hi`` of each row of ``span``,
    with the last day of their month."""
    units = {"day": "DAY", "month": "MONTH", "year": "YEAR"}
    first = F.col("lo") if step == "day" else F.trunc("lo", units[step]).cast("date")
    points = F.sequence(first, F.col("hi"), F.expr(f"INTERVAL 1 {units[step]}"))
    return span.select(F.explode(points).alias("date")).withColumn("month_end", F.last_day("date"))
