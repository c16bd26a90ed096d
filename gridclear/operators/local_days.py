"""Days of a time zone: 92, 96 or 100 quarter-hours, told apart by date, number and the zone's name at that time.

Slots come from the zone's own rules: a day is cut between two local midnights in steps of real time, and each step is read off the
local clock.  On the day clocks go forward numbers are missing, on the day they go back numbers occur twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclear.functions import timecode as tc

ZONE = "Europe/Berlin"
# Names of standard and summer time in inputs.
ZONE_NAMES = ("CET", "CEST")
QUARTER_SECONDS, DAY_SECONDS = 900, 86400
SLOT = ["date", "quarter_no", "time_zone"]


def _wall_seconds(date: Column) -> Column:
    """Local midnight as if it were UTC, whatever the session's zone."""
    return F.unix_date(date).cast("long") * DAY_SECONDS


def _real_seconds(wall: Column, zone: str) -> Column:
    """Seconds since 1970 at which a local clock shows ``wall``: the earlier time if it does twice, and a later reading if it never does."""
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(wall), zone))


def _shown_seconds(real: Column, zone: str) -> Column:
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(real), zone))


def _zone_name(real: Column, zone: str, names: tuple[str, str]) -> Column:
    """The second name while clocks are ahead of where they are on New Year's Day."""
    shown = _shown_seconds(real, zone)
    new_year = _wall_seconds(F.trunc(F.date_from_unix_date(F.floor(shown / DAY_SECONDS).cast("int")), "year"))
    standard = new_year - _real_seconds(new_year, zone)
    return F.when(shown - real > standard, F.lit(names[1])).otherwise(F.lit(names[0]))


def zone_at(date: Column, quarter_no: Column, zone: str = ZONE, names: tuple[str, str] = ZONE_NAMES) -> Column:
    """The zone's name at a quarter-hour of the local clock; of one that occurs twice, the first time."""
    return _zone_name(_real_seconds(_wall_seconds(date) + (quarter_no - 1) * QUARTER_SECONDS, zone), zone, names)


def day_slots(days: DataFrame, zone: str = ZONE, names: tuple[str, str] = ZONE_NAMES) -> DataFrame:
    """(date, quarter_no, time_zone, elapsed_hours) of every quarter-hour of the distinct ``days`` (date), whatever clocks do.

    ``elapsed_hours`` is real time since local midnight.  Days without a date have no slots.
    """
    start = _real_seconds(_wall_seconds(F.col("date")), zone)
    end = _real_seconds(_wall_seconds(F.col("date")) + DAY_SECONDS, zone)
    real = F.sequence(start, end - QUARTER_SECONDS, F.lit(QUARTER_SECONDS).cast("long"))
    cut = days.select("date").filter("date IS NOT NULL").distinct().select("date", start.alias("start"), F.explode(real).alias("real"))
    shown = F.pmod(_shown_seconds(F.col("real"), zone), F.lit(DAY_SECONDS))
    return cut.select(
        "date",
        (F.floor(shown / QUARTER_SECONDS) + 1).cast("int").alias("quarter_no"),
        _zone_name(F.col("real"), zone, names).alias("time_zone"),
        ((F.col("real") - F.col("start")) / 3600).alias("elapsed_hours"),
    )


def _keyed(prices: DataFrame, zone: str, names: tuple[str, str]) -> DataFrame:
    """Prices with their quarter-hour number, and with a zone where they have none."""
    quarter = tc.quarter_of_time(F.col("quarter_hour_start"))
    named = F.col("time_zone") if "time_zone" in prices.columns else F.lit(None).cast("string")
    return prices.withColumn("quarter_no", quarter).withColumn("time_zone", F.coalesce(named, zone_at(F.col("date"), F.col("quarter_no"), zone, names)))


def day_grid(prices: DataFrame, zone: str = ZONE, names: tuple[str, str] = ZONE_NAMES) -> DataFrame:
    """All quarter-hours that the days with results really have, with the price where there is one.

    A price without a zone belongs to the first of two equal quarter-hours.
    """
    known = _keyed(prices, zone, names).select(*SLOT, "activated_volume_mw", "marginal_price")
    slots = day_slots(prices, zone, names).withColumn("quarter_hour_start", tc.quarter_start(F.col("quarter_no")))
    return slots.join(known, SLOT, "left")


def elapsed_price_gaps(prices: DataFrame, max_gap_hours: float = 0.25, zone: str = ZONE, names: tuple[str, str] = ZONE_NAMES) -> DataFrame:
    """Priced quarter-hours numbered by unbroken segment of real time: no gap where clocks jump, repeated hours one after the other.

    Prices at times that the local clock never shows are left out, as nothing can be said about their place.  A day has 100
    quarter-hours at most.
    """
    priced = _keyed(prices, zone, names).filter(F.col("marginal_price").isNotNull())
    placed = priced.select(*SLOT, "quarter_hour_start", "marginal_price").join(day_slots(priced, zone, names), SLOT)
    day = Window.partitionBy("date").orderBy("elapsed_hours")
    return (
        placed.withColumn("gap_hours", F.col("elapsed_hours") - F.lag("elapsed_hours").over(day))
        .withColumn("connected", F.coalesce(F.col("gap_hours") <= max_gap_hours, F.lit(False)))
        .withColumn("segment", F.sum(F.when(F.col("connected"), 0).otherwise(1)).over(day))
    )


def incomplete_days(activations: DataFrame, zone: str = ZONE, names: tuple[str, str] = ZONE_NAMES) -> DataFrame:
    """Per day of ``activations`` (date, quarter_no, time_zone): its quarter-hours, those missing, and rows at times that it doesn't have."""
    zoned = activations.withColumn("time_zone", F.coalesce("time_zone", zone_at(F.col("date"), F.col("quarter_no"), zone, names)))
    held = zoned.groupBy(*SLOT).agg(F.count("*").alias("rows"))
    both = day_slots(activations, zone, names).withColumn("is_slot", F.lit(1)).join(held, SLOT, "full")
    return both.groupBy("date").agg(
        F.count("is_slot").alias("slots"),
        F.count_if(F.col("is_slot").isNotNull() & F.col("rows").isNull()).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("is_slot").isNull(), F.col("rows"))), F.lit(0)).alias("impossible"),
    ).filter(F.col("date").isNotNull())
