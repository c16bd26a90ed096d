"""Days of 92, 96 and 100 quarter-hours."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from gridclear.operators import local_days as ld


def by_clock(day, zone):
    """Slots of a day by stepping through real time."""
    start = dt.datetime.combine(day, dt.time(), ZoneInfo(zone)).astimezone(dt.timezone.utc)
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), ZoneInfo(zone)).astimezone(dt.timezone.utc)
    out, now = [], start
    while now < end:
        local = now.astimezone(ZoneInfo(zone))
        out.append((str(day), local.hour * 4 + local.minute // 15 + 1, local.dst() != dt.timedelta(0), (now - start).total_seconds() / 3600))
        now += dt.timedelta(minutes=15)
    return out


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("session_zone", ["UTC", "Pacific/Auckland"])
def test_slots_follow_the_clock(spark, zone, session_zone):
    days = [dt.date(2024, 3, 9) + dt.timedelta(days=k) for k in (0, 1, 2, 21, 22, 23, 114, 231, 232, 233, 238, 239)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        slots = ld.day_slots(spark.createDataFrame([(d,) for d in [*days, days[0], None]], "date date"), zone).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    got = sorted((str(r.date), r.elapsed_hours, r.quarter_no, r.time_zone == "CEST") for r in slots)
    assert got == sorted((d, e, q, s) for day in days for d, q, s, e in by_clock(day, zone))


def prices(spark, *rows):
    schema = "date date, quarter_hour_start string, time_zone string, activated_volume_mw double, marginal_price double"
    return spark.createDataFrame([(dt.date.fromisoformat(d), t, z, 1.0, p) for d, t, z, p in rows], schema)


def test_no_false_gap_and_repeated_hours_apart(spark):
    spring = [("2024-03-31", t, None, 1.0) for t in ("01:30", "01:45", "03:00", "03:15")]
    autumn = [("2024-10-27", t, z, p) for t, z, p in (("02:45", "CEST", 1.0), ("02:00", "CET", 2.0), ("02:45", "CET", 3.0), ("03:00", None, 4.0), ("02:30", None, 5.0))]
    found = ld.elapsed_price_gaps(prices(spark, *spring, *autumn)).orderBy("date", "elapsed_hours").collect()
    assert [(r.quarter_hour_start, r.segment) for r in found[:4]] == [("01:30", 1), ("01:45", 1), ("03:00", 1), ("03:15", 1)]
    assert [(r.marginal_price, r.segment) for r in found[4:]] == [(5.0, 1), (1.0, 1), (2.0, 1), (3.0, 2), (4.0, 2)]
    grid = ld.day_grid(prices(spark, *spring, *autumn))
    counts = {str(r.date): (r["count(1)"], r.priced) for r in grid.groupBy("date").agg(F.count("*"), F.count("marginal_price").alias("priced")).collect()}
    assert counts == {"2024-03-31": (92, 4), "2024-10-27": (100, 5)}
    assert ld.day_grid(prices(spark).drop("time_zone")).count() == 0


def test_incomplete_days(spark):
    rows = [(dt.date(2024, 3, 31), q, None) for q in range(1, 97)] + [(dt.date(2024, 10, 27), q, None) for q in range(1, 97)] + [(None, 1, None)]
    found = {str(r.date): tuple(r)[1:] for r in ld.incomplete_days(spark.createDataFrame(rows, "date date, quarter_no int, time_zone string")).collect()}
    # Four rows of March are at times that no clock showed; October lacks the second of its repeated hours.
    assert found["2024-10-27"] == (100, 4, 0)
    assert found["2024-03-31"][0] == 92 and found["2024-03-31"][2] == 4
