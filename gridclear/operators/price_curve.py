"""Cumulative price curves that are stored once and looked up for any demand, without reading bids.

``curve_levels`` has a row per price level of an interval, ``curve_bands`` one per price band.  A volume finds its band by the greatest
sum reached up to each, then its level among those of the band, so a look-up never goes over all levels of an interval.  The bounds are
greatest sums so far: where a capacity is negative, and sums fall again, the level that first reaches the volume is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.functions.matching import with_match
from gridclear.operators.merit_order import INTERVAL, ZERO_VOLUME, band_sums, negative_bids, scenarios, with_band
from gridclear.schema import POWER, PRICE


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


KEY = {"date": T.DateType(), "quarter_no": T.IntegerType(), "match_tier": T.IntegerType(), "band": T.LongType()}
CURVE_LEVELS = _struct(
    **KEY, price=PRICE, level_mw=POWER, reached=POWER, through=POWER, available_mw=POWER, priced_mw=POWER, top_price=PRICE
)
CURVE_BANDS = _struct(
    **KEY, reached_before=POWER, reached=POWER, most_mw=POWER, available_mw=POWER, priced_mw=POWER, top_price=PRICE, is_last=T.BooleanType()
)


def curve_levels(bids: DataFrame, capacity: Column | None = None) -> DataFrame:
    """Price levels of the best tier of every interval.

    ``through`` is the capacity up to a level, ``reached`` the most that any lower level of its band reaches (NULL for the lowest).
    An interval whose bids all lack a price has one row, without band and price.
    """
    stack = negative_bids(bids, capacity)
    sums = with_band(with_match(stack.filter(F.col("price").isNotNull()))).groupBy(*INTERVAL, "tier", "band", "price")
    levels = sums.agg(F.sum("capacity_mw").alias("level_mw"))
    bands = band_sums(stack).withColumnRenamed("match_tier", "tier")
    below = Window.partitionBy(*INTERVAL, "band").orderBy("price")
    return (
        bands.join(levels, [*INTERVAL, "tier", "band"], "left")
        .withColumn("through", F.col("mw_before") + F.sum("level_mw").over(below.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("reached", F.max("through").over(below.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumnRenamed("tier", "match_tier")
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CURVE_LEVELS.fields])
    )


def curve_bands(levels: DataFrame) -> DataFrame:
    """Bands of every interval of ``levels``; volumes above ``reached_before``, and up to ``reached``, clear in a band."""
    of_interval = Window.partitionBy(*INTERVAL)
    ordered = of_interval.orderBy("band")
    same = ["match_tier", "available_mw", "priced_mw", "top_price"]  # in all rows of an interval
    return (
        levels.groupBy(*INTERVAL, "band")
        .agg(F.coalesce(F.max("through"), F.lit(0)).alias("reached"), *[F.max(c).alias(c) for c in same])
        .withColumn("reached_before", F.max("reached").over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("most_mw", F.max("reached").over(of_interval))
        .withColumn("is_last", F.lead("reached").over(ordered).isNull())
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CURVE_BANDS.fields])
    )


def look_up(demand: DataFrame, bands: DataFrame, levels: DataFrame, on_short: str = "null") -> DataFrame:
    """What ``merit_order.clear`` gives for ``demand``, from stored curves."""
    if on_short not in ("null", "last"):
        raise ValueError(f"on_short must be 'null' or 'last', not {on_short!r}")
    volume = F.col("d.activated_volume_mw")
    active = F.coalesce(F.abs(volume) >= ZERO_VOLUME, F.lit(True))
    in_band = (volume <= F.col("b.reached")) & (F.col("b.reached_before").isNull() | (volume > F.col("b.reached_before")))
    beyond = F.col("b.is_last") & (volume.isNull() | (volume > F.col("b.most_mw")))
    same_interval = [F.col(f"d.{c}") == F.col(f"b.{c}") for c in INTERVAL]
    located = (
        demand.alias("d")
        .join(bands.alias("b"), same_interval[0] & same_interval[1] & active & (in_band | beyond), "left")
        .select(
            "d.*",
            F.struct("b.match_tier", "b.band", "b.available_mw", "b.priced_mw", "b.top_price").alias("_band"),
            F.coalesce(volume > F.col("b.most_mw"), F.lit(False)).alias("_short"),
        )
        .alias("c")
    )
    volume, found = F.col("c.activated_volume_mw"), F.col("c._band")
    first = (volume <= F.col("l.through")) & (F.col("l.reached").isNull() | (F.col("l.reached") < volume))
    same_band = (F.col("c.date") == F.col("l.date")) & (F.col("c.quarter_no") == F.col("l.quarter_no")) & (found["band"] == F.col("l.band"))
    rows = located.join(levels.alias("l"), same_band & ~F.col("c._short") & first, "left")
    cleared = F.when(F.col("c._short"), found["priced_mw"]).when(found["available_mw"].isNull(), F.lit(0)).otherwise(F.col("l.through"))
    return rows.select(
        *[F.col(f"c.`{name}`") for name in demand.columns],
        F.coalesce(found["available_mw"], F.lit(0)).cast(POWER).alias("available_mw"),
        cleared.cast(POWER).alias("cleared_mw"),
        F.when(F.col("c._short"), found["top_price"] if on_short == "last" else F.lit(None)).otherwise(F.col("l.price")).alias("price"),
        found["match_tier"].alias("match_tier"),
        F.col("c._short").alias("is_short"),
    )


def what_if_from_curve(
    activations: DataFrame,
    bands: DataFrame,
    levels: DataFrame,
    factors: dict[str, float],
    absolute_mw: dict[str, float] | None = None,
    on_short: str = "null",
) -> DataFrame:
    """Clearing prices of modified demand, read off stored curves."""
    return look_up(scenarios(activations, factors, absolute_mw), bands, levels, on_short)
