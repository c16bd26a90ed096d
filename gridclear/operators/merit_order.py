"""Merit-order clearing: the price of the bid at which accumulated capacity covers the activated volume.

An interval may hold a third of all bids, so no task ever sees all bids of an interval, nor even all of
its price levels.  Prices are DECIMAL with three digits; a *band* is 10 EUR/MWh wide (the one around zero
20) and so has at most 20,000 levels.

1. Bids are summed per (date, quarter-hour, tier, band); the sums combine before the shuffle.
2. Running sums over the bands of an interval, and one equi-join with the activations, tell in which
   band each interval clears.
3. Bids are read again and reduced to those of clearing bands (at most one band per activation, so the
   list is as small as the activations).  They are summed per price level, and the running sum within the
   band gives the price.

Raw bids are never shuffled as rows, and read twice.  Where a capacity is negative, running sums can fall again, and a band's sum does
not tell whether they reached the volume inside it: of such intervals, which an input error makes, the second reading takes all
bands, and the running sum goes over the whole interval.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclear.functions.matching import UNMATCHED, with_match
from gridclear.functions.timecode import (
    block_index,
    interval_start,
    product_code,
    quarter_end,
    quarter_of_product,
    quarter_start,
)
from gridclear.operators.overlap import overlap_join  # noqa: F401
from gridclear.schema import POWER

BAND_WIDTH = 10
ZERO_VOLUME = 0.001
CELL_BIDS = 50_000  # bids of a cell, about, which a task holds in memory while quarter-hours meet them
INTERVAL = ["date", "quarter_no"]
CELL = ["date", "cell", "part"]


def total_capacity() -> Column:
    """Default capacity of a bid: what was offered, else what was allocated."""
    return F.coalesce(F.col("offered_capacity_mw"), F.col("allocated_capacity_mw"))


def negative_bids(bids: DataFrame, capacity: Column | None = None) -> DataFrame:
    """Bids whose product may mean a quarter-hour, reduced to what clearing needs.

    A missing capacity counts as 0 MW; a negative one is summed as it is.
    """
    capacity = total_capacity() if capacity is None else capacity
    product = F.col("product")
    return bids.filter(
        (product.startswith("NEG") | product.startswith("neg")) & F.col("delivery_date").isNotNull()
    ).select(
        F.col("delivery_date").alias("date"),
        "product",
        F.col("energy_price_eur_mwh").alias("price"),
        F.coalesce(capacity, F.lit(0)).cast(POWER).alias("capacity_mw"),
    )


def with_band(df: DataFrame) -> DataFrame:
    """Adds ``band``, a number that never falls as the price rises; NULL without a price."""
    return df.withColumn("band", F.expr(f"cast(price as bigint) div {BAND_WIDTH}"))


def _usable() -> Column:
    """Whether a group's product codes mean a quarter-hour, as an aggregate.

    A filter on the tier itself would be repeated on every bid that is later joined by tier.
    """
    return F.bool_or(F.col("tier") < UNMATCHED).alias("usable")


def band_sums(stack: DataFrame) -> DataFrame:
    """Best-tier bands of every interval with the capacity before, up to and beyond them.

    Bids without a price never clear: they count in ``available_mw``, not in ``priced_mw``.  An interval with no other bids
    keeps one row, with band NULL and 0 MW.
    """
    per_band = (
        with_match(with_band(stack))
        .groupBy(*INTERVAL, "tier", "band")
        .agg(
            F.sum("capacity_mw").alias("band_mw"),
            F.max("price").alias("band_top"),
            F.bool_or((F.col("capacity_mw") < 0) & F.col("price").isNotNull()).alias("falls"),
            _usable(),
        )
    )
    interval = Window.partitionBy(*INTERVAL)
    ordered = interval.orderBy(F.col("band").asc_nulls_last())
    return (
        per_band.withColumn("best_tier", F.min("tier").over(interval))
        .filter((F.col("tier") == F.col("best_tier")) & F.col("usable"))
        .withColumn("available_mw", F.sum("band_mw").over(interval))
        .withColumn("top_price", F.max("band_top").over(interval))
        .withColumn("band_mw", F.when(F.col("band").isNull(), F.lit(0)).otherwise(F.col("band_mw")))
        .withColumn("priced_mw", F.sum("band_mw").over(interval))
        .withColumn("falls", F.max("falls").over(interval))
        .filter(F.col("band").isNotNull() | F.col("top_price").isNull())
        .withColumn("mw_through", F.sum("band_mw").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("mw_before", F.col("mw_through") - F.col("band_mw"))
        .withColumn("is_first", F.row_number().over(ordered) == 1)
        .withColumn("is_last", F.lead("tier").over(ordered).isNull())
        .select(
            *INTERVAL,
            F.col("tier").alias("match_tier"),
            "band",
            "mw_before",
            "mw_through",
            "available_mw",
            "priced_mw",
            "top_price",
            "falls",
            "is_first",
            "is_last",
        )
    )


def clear(
    demand: DataFrame,
    bids: DataFrame,
    capacity: Column | None = None,
    on_short: str = "null",
) -> DataFrame:
    """One row per row of ``demand`` with its clearing price.

    ``demand`` has ``date``, ``quarter_no``, ``activated_volume_mw`` and any further columns, which are
    kept.  Added: ``available_mw``, ``cleared_mw``, ``price``, ``match_tier``, ``is_short``.  A volume
    below 0.001 MW, or an interval without bids, has no price and 0 MW.  If all bids with a price together do
    not cover the volume, ``on_short`` chooses between no price (``"null"``) and the highest bid (``"last"``).
    """
    if on_short not in ("null", "last"):
        raise ValueError(f"on_short must be 'null' or 'last', not {on_short!r}")
    stack = negative_bids(bids, capacity)

    volume = F.col("activated_volume_mw")
    active = F.coalesce(F.abs(volume) >= ZERO_VOLUME, F.lit(True))
    in_band = (volume <= F.col("b.mw_through")) & ((volume > F.col("b.mw_before")) | F.col("b.is_first"))
    beyond = F.col("b.is_last") & (volume.isNull() | (volume > F.col("b.mw_through")))
    bands = band_sums(stack).alias("b")
    same_interval = (F.col("d.date") == F.col("b.date")) & (F.col("d.quarter_no") == F.col("b.quarter_no"))
    # Of an interval with falling sums every band is needed, of all others the one that clears.
    wanted = F.when(F.col("b.falls"), F.lit(True)).otherwise(in_band | beyond)
    located = (
        demand.alias("d")
        .join(bands, same_interval & active & wanted, "left")
        .select(
            "d.*",
            *[F.col(f"b.{name}") for name in ("match_tier", "band", "mw_before", "available_mw", "priced_mw", "top_price", "is_last")],
            F.coalesce(volume > F.col("b.priced_mw"), F.lit(False)).alias("beyond_all"),
            F.coalesce(F.col("b.falls"), F.lit(False)).alias("falls"),
        )
    )
    needed = (
        located.filter((F.col("falls") | ~F.col("beyond_all")) & F.col("band").isNotNull())
        .select(*INTERVAL, F.col("match_tier").alias("tier"), "band", "falls")
        .distinct()
    )
    # Sums run within a band, or over the whole interval where they can fall.
    segment = F.when(F.col("falls"), F.lit(None)).otherwise(F.col("band"))
    by_price = Window.partitionBy(*INTERVAL, segment).orderBy("price")
    levels = (
        with_match(with_band(stack))
        .join(needed, [*INTERVAL, "tier", "band"])
        .groupBy(*INTERVAL, "band", "falls", "price")
        .agg(F.sum("capacity_mw").alias("level_mw"))
        .withColumn("through", F.sum("level_mw").over(by_price.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("reached", F.max("through").over(by_price.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("segment", segment)
        .alias("l")
    )
    base = F.when(F.col("falls"), F.lit(0)).otherwise(F.col("mw_before"))
    rows = located.filter(~F.col("falls") | F.col("is_last")).withColumns({"base": base, "segment": segment}).alias("c")
    rest = F.col("c.activated_volume_mw") - F.col("c.base")
    first = (rest <= F.col("l.through")) & (F.col("l.reached").isNull() | (F.col("l.reached") < rest))
    same = [F.col(f"c.{name}") == F.col(f"l.{name}") for name in INTERVAL]
    same_segment = F.col("c.segment").eqNullSafe(F.col("l.segment")) & (F.col("c.falls") == F.col("l.falls"))
    found = rows.join(levels, same[0] & same[1] & same_segment & (F.col("c.falls") | ~F.col("c.beyond_all")) & first, "left")
    unreached = F.col("l.price").isNull() & F.col("c.activated_volume_mw").isNotNull()
    short = F.when(F.col("c.falls"), unreached).otherwise(F.col("c.beyond_all"))
    short_price = F.col("c.top_price") if on_short == "last" else F.lit(None)
    return found.select(
        *[F.col(f"c.`{name}`") for name in demand.columns],
        F.coalesce(F.col("c.available_mw"), F.lit(0)).cast(POWER).alias("available_mw"),
        F.when(short, F.col("c.priced_mw"))
        .when(F.col("c.available_mw").isNull(), F.lit(0))
        .otherwise(F.col("c.base") + F.col("l.through"))
        .cast(POWER)
        .alias("cleared_mw"),
        F.when(short, short_price).otherwise(F.col("l.price")).alias("price"),
        "c.match_tier",
        short.alias("is_short"),
    )


def marginal_prices(
    activations: DataFrame,
    bids: DataFrame,
    start: str | None = None,
    end: str | None = None,
    capacity: Column | None = None,
    on_short: str = "null",
) -> DataFrame:
    """The clearing price of every activated quarter-hour in ``start``..``end`` (both included, None = open).

    ``time_zone`` tells the two hours of the night apart on which clocks go back; it is NULL where activations have none.
    """
    wanted = date_range(activations, "date", start, end)
    if "time_zone" not in wanted.columns:
        wanted = wanted.withColumn("time_zone", F.lit(None).cast("string"))
    cleared = clear(wanted, date_range(bids, "delivery_date", start, end), capacity, on_short)
    return cleared.select(
        "date",
        interval_start(F.col("date"), F.col("quarter_no")).alias("timestamp"),
        quarter_start(F.col("quarter_no")).alias("quarter_hour_start"),
        quarter_end(F.col("quarter_no")).alias("quarter_hour_end"),
        "activated_volume_mw",
        F.col("available_mw").alias("available_capacity_mw"),
        F.col("cleared_mw").alias("cleared_capacity_mw"),
        F.col("price").alias("marginal_price"),
        product_code(F.col("quarter_no")).alias("product_code"),
        "match_tier",
        "is_short",
        "time_zone",
    )


def date_range(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Rows with ``start <= column <= end``; a missing bound is open."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast("date"))
    return df


def activation_demand(activations: DataFrame) -> DataFrame:
    return activations.select(
        "date", "quarter_no", "quarter_hour_start", "quarter_hour_end", "activated_volume_mw"
    )


def active_intervals(activations: DataFrame) -> DataFrame:
    """Intervals with a volume worth clearing; the others get no price."""
    return activations.filter(F.coalesce(F.abs(F.col("activated_volume_mw")) >= ZERO_VOLUME, F.lit(True)))


def zero_activations(activations: DataFrame) -> DataFrame:
    return activations.filter(F.abs(F.col("activated_volume_mw")) < ZERO_VOLUME)


def match_bids_exact(activations: DataFrame, bids: DataFrame) -> DataFrame:
    """Every bid of every activated quarter-hour, by the exact product code."""
    demand = activations.select(
        *INTERVAL, "activated_volume_mw", product_code(F.col("quarter_no")).alias("product")
    )
    return negative_bids(bids).join(demand, ["date", "product"])


def product_matches(bids: DataFrame) -> DataFrame:
    """The negative products of every date with the quarter-hour they mean and the tier of the match."""
    return with_match(negative_bids(bids).select("date", "product").distinct())


def best_match_tier(bids: DataFrame) -> DataFrame:
    """The best tier that has any bid, per interval."""
    best = product_matches(bids).groupBy(*INTERVAL).agg(F.min("tier").alias("match_tier"), _usable())
    return best.filter("usable").drop("usable")


def match_bids_tiered(activations: DataFrame, bids: DataFrame) -> DataFrame:
    """Every bid of every activated quarter-hour, of the best tier that has bids."""
    demand = activations.select(*INTERVAL, "activated_volume_mw")
    # At most one row per activation, so as small as the activations.
    wanted = demand.join(best_match_tier(bids), INTERVAL).withColumn("tier", F.col("match_tier"))
    matched = with_match(negative_bids(bids))
    return matched.join(wanted, [*INTERVAL, "tier"]).drop("tier")


def available_capacity(bids: DataFrame, capacity: Column | None = None) -> DataFrame:
    """Capacity and number of the best-tier bids per interval."""
    per_product = negative_bids(bids, capacity).groupBy("date", "product").agg(
        F.sum("capacity_mw").alias("mw"), F.count("*").alias("bids")
    )
    per_tier = with_match(per_product).groupBy(*INTERVAL, "tier").agg(
        F.sum("mw").alias("mw"), F.sum("bids").alias("bids")
    )
    # At most three rows per interval are left, one per tier.
    best = per_tier.groupBy(*INTERVAL).agg(
        F.min("tier").alias("match_tier"),
        F.min_by("mw", "tier").alias("available_capacity_mw"),
        F.min_by("bids", "tier").alias("bid_count"),
        _usable(),
    )
    return best.filter("usable").drop("usable")


def intervals_without_bids(activations: DataFrame, bids: DataFrame) -> DataFrame:
    """Activated intervals no bid matches, with up to five negative products that day does have."""
    day_products = (
        bids.filter(F.col("product").contains("NEG") | F.col("product").contains("neg"))
        .select(F.col("delivery_date").alias("date"), "product")
        .distinct()
        .withColumn("rank", F.row_number().over(Window.partitionBy("date").orderBy("product")))
        .filter("rank <= 5")
        .groupBy("date")
        .agg(F.array_join(F.sort_array(F.collect_list("product")), ",").alias("neg_products"))
    )
    covered = product_matches(bids).select(*INTERVAL)
    return (
        active_intervals(activations)
        .select(*INTERVAL, "activated_volume_mw")
        .join(covered, INTERVAL, "left_anti")
        .join(day_products, "date", "left")
        .withColumn("product_code", product_code(F.col("quarter_no")))
        .withColumn("neg_products", F.coalesce("neg_products", F.lit("")))
    )


def merit_order_curve(bids: DataFrame, capacity: Column | None = None) -> DataFrame:
    """Price levels of every interval with the capacity available up to each price."""
    stack = negative_bids(bids, capacity).filter(F.col("price").isNotNull())
    per_product = stack.groupBy("date", "product", "price").agg(
        F.sum("capacity_mw").alias("mw"), F.count("*").alias("bids")
    )
    levels = with_band(with_match(per_product)).groupBy(*INTERVAL, "tier", "price", "band").agg(
        F.sum("mw").alias("level_mw"), F.sum("bids").alias("bid_count")
    )
    bands = band_sums(stack).select(*INTERVAL, F.col("match_tier").alias("tier"), "band", "mw_before")
    in_band = Window.partitionBy(*INTERVAL, "tier", "band").orderBy("price")
    return levels.join(bands, [*INTERVAL, "tier", "band"]).select(
        *INTERVAL,
        F.col("tier").alias("match_tier"),
        "price",
        "level_mw",
        "bid_count",
        (
            F.col("mw_before") + F.sum("level_mw").over(in_band.rowsBetween(Window.unboundedPreceding, 0))
        ).cast(POWER).alias("cumulative_mw"),
    )


def capacity_shortfall(activations: DataFrame, bids: DataFrame, capacity: Column | None = None) -> DataFrame:
    """Intervals whose volume exceeds all matched capacity."""
    supply = available_capacity(bids, capacity).select(*INTERVAL, "available_capacity_mw")
    return (
        active_intervals(activations)
        .select(*INTERVAL, "activated_volume_mw")
        .join(supply, INTERVAL)
        .filter(F.col("activated_volume_mw") > F.col("available_capacity_mw"))
        .withColumn("shortfall_mw", F.col("activated_volume_mw") - F.col("available_capacity_mw"))
    )


def scenarios(activations: DataFrame, factors: dict[str, float], absolute_mw: dict[str, float] | None = None) -> DataFrame:
    """Activations once per scenario, with the volume scaled by a factor or replaced by a fixed one."""
    volume = F.col("activated_volume_mw")
    variants = [
        F.struct(F.lit(name).alias("scenario"), (volume * F.lit(str(factor)).cast("decimal(9,4)")).cast(POWER).alias("mw"))
        for name, factor in factors.items()
    ] + [
        F.struct(F.lit(name).alias("scenario"), F.lit(str(mw)).cast(POWER).alias("mw"))
        for name, mw in (absolute_mw or {}).items()
    ]
    return (
        activations.select(*INTERVAL, volume, F.explode(F.array(*variants)).alias("v"))
        .select(*INTERVAL, F.col("v.scenario").alias("scenario"), F.col("v.mw").alias("activated_volume_mw"))
    )


def what_if_price(
    activations: DataFrame,
    bids: DataFrame,
    factors: dict[str, float],
    absolute_mw: dict[str, float] | None = None,
    **options,
) -> DataFrame:
    """Clearing prices of modified demand; the bid stack is read no more often than for one scenario."""
    return clear(scenarios(activations, factors, absolute_mw), bids, **options)


def active_bids(activations: DataFrame, bids: DataFrame) -> DataFrame:
    """Every bid whose four-hour block covers the end of an activated quarter-hour, a row per interval and bid.

    An interval that ends with its block is covered by that block.  A day's block of bids meets its sixteen quarter-hours at most, so
    rows grow with the bids.  Store the result where it is asked for often.

    Bids are dealt out by cells before they meet the quarter-hours, so a sixteenth of the rows is shuffled and sorted; rows come by date, quarter-hour
    and price within a cell.  A cell is a day, or a part of a block of a day with more than ``CELL_BIDS`` bids; only exact copies from one input task stay together.
    """
    offered = bids.select(
        F.col("delivery_date").alias("date"),
        block_index(quarter_of_product(F.col("product"))).alias("block_index"),
        "product",
        F.col("energy_price_eur_mwh").alias("price"),
        total_capacity().alias("capacity_mw"),
    ).filter(F.col("date").isNotNull() & F.col("block_index").isNotNull())
    wanted = activations.select(*INTERVAL, "activated_volume_mw").withColumn("block_index", block_index(F.col("quarter_no")))
    cells = F.broadcast(_bid_cells(offered))  # at most a row per block of the calendar
    copies = F.xxhash64("product", "price", "capacity_mw", F.spark_partition_id())
    dealt = offered.join(cells, ["date", "block_index"]).withColumn("part", F.pmod(copies, "parts").cast("int"))
    asked = wanted.join(cells, ["date", "block_index"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left, right = _by_cell(asked, "quarter_no").alias("a"), _by_cell(dealt, "price").alias("b")
    # Equal blocks, but no key of the join: a day that is one cell stays in one task.
    same_block = F.col("a.block_index").between(F.col("b.block_index"), F.col("b.block_index"))
    same_cell = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in CELL])
    return left.hint("merge").join(right, same_cell & same_block).select(
        "a.date", "a.block_index", "a.quarter_no", "a.activated_volume_mw", "b.product", "b.price", "b.capacity_mw"
    )


def _bid_cells(offered: DataFrame) -> DataFrame:
    """Per day and block with bids: its ``cell``, -1 where the day is one, and the number of ``parts`` of it."""
    counts = offered.groupBy("date", "block_index").agg(F.count("*").alias("n"))
    small = F.sum("n").over(Window.partitionBy("date")) <= CELL_BIDS
    return counts.select(
        "date",
        "block_index",
        F.when(small, -1).otherwise(F.col("block_index")).alias("cell"),
        F.when(small, 1).otherwise(F.ceil(F.col("n") / CELL_BIDS)).cast("int").alias("parts"),
    )


def _by_cell(rows: DataFrame, order: str) -> DataFrame:
    """Whole cells in tasks, in order.

    The number of tasks is fixed, as few bytes of bids become many rows; a task without a cell costs next to nothing.  The observed
    count is not needed: it keeps the optimizer from dropping the order, as it does below a join.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, *CELL).sortWithinPartitions(*CELL, order)
    return dealt.observe(f"cells by {order} {uuid.uuid4().hex}", F.count("*").alias("n"))


def bids_overlapping_interval(activations: DataFrame, bids: DataFrame) -> DataFrame:
    """Quarter-hours with the number and capacity of all bids whose four-hour block covers them.

    Quarter-hours nest in blocks, so the overlap is an equality of blocks.  Bids are summed per block
    before the join.
    """
    blocks = (
        bids.select(
            F.col("delivery_date").alias("date"),
            block_index(quarter_of_product(F.col("product"))).alias("block_index"),
            total_capacity().alias("capacity_mw"),
            F.col("energy_price_eur_mwh").alias("price"),
        )
        .groupBy("date", "block_index")
        .agg(
            F.count("*").alias("active_bids"),
            F.sum("capacity_mw").alias("active_capacity_mw"),
            F.min("price").alias("lowest_price"),
            F.max("price").alias("highest_price"),
        )
    )
    return (
        activations.select(*INTERVAL, "activated_volume_mw")
        .withColumn("block_index", block_index(F.col("quarter_no")))
        .join(blocks, ["date", "block_index"], "left")
        .withColumn("active_bids", F.coalesce("active_bids", F.lit(0)))
    )
