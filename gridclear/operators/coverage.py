"""Descriptive reports on bids, activations and marginal prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclear.functions import timecode as tc

POWER_SUM = "decimal(38,3)"


def _is_neg(column: str = "product") -> Column:
    return F.col(column).startswith("NEG")


# --- bids ----------------------------------------------------------------------------------------


def provider_overview(bids: DataFrame) -> DataFrame:
    """First and last delivery date, number of days and of bids."""
    per_day = bids.groupBy("delivery_date").agg(F.count("*").alias("rows"))
    return per_day.agg(
        F.min("delivery_date").alias("min_date"),
        F.max("delivery_date").alias("max_date"),
        F.count("delivery_date").alias("num_days"),
        F.sum("rows").alias("total_records"),
    )


def product_distribution(bids: DataFrame) -> DataFrame:
    return bids.groupBy("product").agg(F.count("*").alias("bid_count"))


def products_by_day(bids: DataFrame) -> DataFrame:
    """Number and list of distinct products per day."""
    pairs = bids.select(F.col("delivery_date").alias("date"), "product").distinct()
    return pairs.groupBy("date").agg(
        F.count("product").alias("product_count"),
        F.array_join(F.sort_array(F.collect_list("product")), ",").alias("products"),
    )


def neg_product_stats(bids: DataFrame, day: str | None = None) -> DataFrame:
    """Offers and average price per negative product, of one day or of all days."""
    if day is not None:
        bids = bids.filter(F.col("delivery_date") == F.lit(day).cast("date"))
    return (
        bids.filter(_is_neg())
        .groupBy("product")
        .agg(
            F.count("*").alias("offer_count"),
            (F.sum("energy_price_eur_mwh").cast("double") / F.count("energy_price_eur_mwh")).alias("avg_price"),
        )
    )


def reserve_types(bids: DataFrame) -> DataFrame:
    return bids.groupBy("type_of_reserves").agg(F.count("*").alias("bid_count"))


def offers_per_product(bids: DataFrame, day: str | None = None) -> DataFrame:
    """Offers per product and day, marking negative products whatever their case."""
    if day is not None:
        bids = bids.filter(F.col("delivery_date") == F.lit(day).cast("date"))
    return (
        bids.groupBy(F.col("delivery_date").alias("date"), "product")
        .agg(F.count("*").alias("offer_count"))
        .withColumn("is_neg", F.lower("product").contains("neg"))
    )


def product_presence(bids: DataFrame) -> DataFrame:
    """On how many days each product occurs."""
    pairs = bids.select("product", "delivery_date").distinct()
    return pairs.groupBy("product").agg(F.count("delivery_date").alias("days"))


def bid_count_per_interval(bids: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Bids per day and negative product with its interval number, start time and four-hour block."""
    wanted = bids.filter(_is_neg() & (F.length("product") > 3))
    if start is not None:
        wanted = wanted.filter(F.col("delivery_date") >= F.lit(start).cast("date"))
    if end is not None:
        wanted = wanted.filter(F.col("delivery_date") <= F.lit(end).cast("date"))
    number = tc.quarter_of_product(F.col("product"))
    index = tc.block_index(number)
    return (
        wanted.groupBy(F.col("delivery_date").alias("date"), "product")
        .agg(F.count("*").alias("bid_count"))
        .select(
            "date",
            "product",
            "bid_count",
            number.alias("interval_number"),
            tc.quarter_start(number).alias("time"),
            index.alias("block_index"),
            tc.block_label(index).alias("block"),
        )
    )


def block_statistics(counts: DataFrame) -> DataFrame:
    """Spread of bid counts within each four-hour block of a day; input from ``bid_count_per_interval``."""
    return counts.groupBy("date", "block").agg(
        F.min("bid_count").alias("min_bids"),
        F.max("bid_count").alias("max_bids"),
        F.avg("bid_count").alias("mean_bids"),
        F.stddev_samp("bid_count").alias("std_bids"),
        F.count("*").alias("products"),
    )


def block_inconsistencies(counts: DataFrame) -> DataFrame:
    """Products whose bid count differs from the lowest of their block."""
    block = Window.partitionBy("date", "block")
    return (
        counts.withColumn("block_min", F.min("bid_count").over(block))
        .withColumn("block_max", F.max("bid_count").over(block))
        .filter("bid_count <> block_min")
        .select("date", "block", "product", "time", "bid_count", "block_min", "block_max")
    )


def neg_coverage_by_day(bids: DataFrame) -> DataFrame:
    """Bids and distinct products per day, in all and negative ones."""
    per_product = bids.groupBy(F.col("delivery_date").alias("date"), "product").agg(F.count("*").alias("rows"))
    neg = F.coalesce(_is_neg(), F.lit(False))
    return (
        per_product.groupBy("date")
        .agg(
            F.sum("rows").alias("total_records"),
            F.sum(F.when(neg, F.col("rows")).otherwise(0)).alias("neg_records"),
            F.count("product").alias("distinct_products"),
            F.count_if(neg).alias("distinct_neg"),
        )
        .withColumn("has_neg", F.col("neg_records") > 0)
    )


def products_of_first_day_without_neg(bids: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent products of the first day that has no negative product."""
    day = neg_coverage_by_day(bids).filter("NOT has_neg").agg(F.min("date"))
    return top_products(bids.filter(F.col("delivery_date") == day.scalar()), n)


def top_products(bids: DataFrame, n: int = 10) -> DataFrame:
    return product_distribution(bids).orderBy(F.desc("bid_count"), "product").limit(n)


def sample_products(bids: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` negative product codes, to see how they are spelled."""
    neg = bids.filter(_is_neg() | F.col("product").startswith("neg"))
    return neg.select("product").distinct().orderBy("product").limit(n)


def expected_products(bids: DataFrame) -> DataFrame:
    """All 96 negative product codes for every day that has bids."""
    slots = F.explode(F.sequence(F.lit(1), F.lit(tc.QUARTERS_PER_DAY))).alias("slot")
    return (
        bids.select(F.col("delivery_date").alias("date"))
        .distinct()
        .select("date", slots)
        .withColumn("product", tc.product_code(F.col("slot")))
    )


def difference_products(bids: DataFrame) -> DataFrame:
    """(day, product) pairs expected but absent, as a set difference."""
    present = bids.select(F.col("delivery_date").alias("date"), "product").distinct()
    return expected_products(bids).select("date", "product").subtract(present)


def missing_products(bids: DataFrame) -> DataFrame:
    """Absent negative products with their hour, quarter of the hour, and the number of days that have them."""
    present = bids.select(F.col("delivery_date").alias("date"), "product").distinct()
    days = present.groupBy("product").agg(F.count("date").alias("days_with_product"))
    return (
        expected_products(bids)
        .join(present, ["date", "product"], "left_anti")
        .join(days, "product", "left")
        .select(
            "date",
            "product",
            F.floor((F.col("slot") - 1) / 4).cast("int").alias("hour"),
            F.pmod(F.col("slot") - 1, F.lit(4)).cast("int").alias("quarter"),
            F.coalesce("days_with_product", F.lit(0)).cast("long").alias("days_with_product"),
        )
    )


def missing_pattern(bids: DataFrame) -> DataFrame:
    """Per day: how many products are absent, and in which hours and quarters of the hour."""
    return (
        missing_products(bids)
        .groupBy("date")
        .agg(
            F.count("*").alias("missing_count"),
            F.array_join(F.sort_array(F.collect_set("hour")).cast("array<string>"), ",").alias("hours"),
            F.array_join(F.sort_array(F.collect_set("quarter")).cast("array<string>"), ",").alias("quarters"),
        )
    )


def records_per_date(df: DataFrame, date_column: str = "delivery_date") -> DataFrame:
    return df.groupBy(F.col(date_column).alias("date")).agg(F.count("*").alias("records"))


def table_stats(bids: DataFrame) -> DataFrame:
    """Lowest, highest and average price per day, with bids and source files."""
    per_file = bids.groupBy(F.col("delivery_date").alias("date"), "source_file").agg(
        F.count("*").alias("rows"),
        F.count("energy_price_eur_mwh").alias("priced"),
        F.sum("energy_price_eur_mwh").alias("price_sum"),
        F.min("energy_price_eur_mwh").alias("low"),
        F.max("energy_price_eur_mwh").alias("high"),
    )
    return per_file.groupBy("date").agg(
        F.sum("rows").alias("row_count"),
        F.count("source_file").alias("file_count"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        F.try_divide(F.sum("price_sum").cast("double"), F.sum("priced")).alias("avg_price"),
    )


# --- activations ---------------------------------------------------------------------------------


def active_days(activations: DataFrame) -> DataFrame:
    return activations.select("date").distinct()


def rows_in_range(activations: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (F.col("date") <= F.lit(end).cast("date"))
    return activations.filter(inside).agg(F.count("*").alias("row_count"))


def activation_summary(activations: DataFrame) -> DataFrame:
    """First and last date, number of days and rows."""
    per_day = records_per_date(activations, "date")
    return per_day.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count("date").alias("num_days"),
        F.sum("records").alias("total_records"),
    )


# --- marginal prices -----------------------------------------------------------------------------


def daily_price_summary(prices: DataFrame) -> DataFrame:
    return prices.groupBy("date").agg(
        F.count("*").alias("intervals"),
        F.min("marginal_price").alias("min_price"),
        F.try_divide(F.sum("marginal_price").cast("double"), F.count("marginal_price")).alias("avg_price"),
        F.max("marginal_price").alias("max_price"),
        F.sum("activated_volume_mw").alias("total_volume_mw"),
    )


def price_statistics(prices: DataFrame) -> DataFrame:
    """Mean, lowest and highest price, and how many intervals have one."""
    return prices.agg(
        F.count("*").alias("intervals"),
        F.count("marginal_price").alias("priced"),
        F.try_divide(F.count("marginal_price") * F.lit(100.0), F.count("*")).alias("priced_percent"),
        F.try_divide(F.sum("marginal_price").cast("double"), F.count("marginal_price")).alias("mean_price"),
        F.min("marginal_price").alias("min_price"),
        F.max("marginal_price").alias("max_price"),
    )


def price_coverage(prices: DataFrame) -> DataFrame:
    """Priced and unpriced intervals per day, and over all days in the row without a date."""
    priced, unpriced = F.count("marginal_price"), F.count_if(F.col("marginal_price").isNull())
    per_day = prices.groupBy("date").agg(
        F.count("*").alias("intervals"), priced.alias("with_price"), unpriced.alias("without_price")
    )
    overall = per_day.agg(
        F.lit(None).cast("date").alias("date"),
        F.coalesce(F.sum("intervals"), F.lit(0)).alias("intervals"),
        F.coalesce(F.sum("with_price"), F.lit(0)).alias("with_price"),
        F.coalesce(F.sum("without_price"), F.lit(0)).alias("without_price"),
        F.count("date").alias("days"),
    )
    rows = per_day.withColumn("days", F.lit(1).cast("long")).unionByName(overall)
    return rows.withColumn("priced_percent", F.try_divide(F.col("with_price") * F.lit(100.0), F.col("intervals")))


def priced_intervals(prices: DataFrame) -> DataFrame:
    """The price series of a chart."""
    return prices.filter(F.col("marginal_price").isNotNull()).select("timestamp", "marginal_price").orderBy("timestamp")


def view_marginal_prices(prices: DataFrame, day: str | None = None) -> DataFrame:
    if day is not None:
        prices = prices.filter(F.col("date") == F.lit(day).cast("date"))
    return prices.select(
        "date",
        "quarter_hour_start",
        "quarter_hour_end",
        "activated_volume_mw",
        "available_capacity_mw",
        "marginal_price",
        "product_code",
    ).orderBy("date", "quarter_hour_start")


def full_day_grid(prices: DataFrame) -> DataFrame:
    """All 96 quarter-hours of every day that has results, with the price where there is one."""
    slots = F.explode(F.sequence(F.lit(1), F.lit(tc.QUARTERS_PER_DAY))).alias("slot")
    grid = (
        prices.select("date")
        .distinct()
        .select("date", slots)
        .select(
            "date",
            tc.quarter_start(F.col("slot")).alias("quarter_hour_start"),
            ((F.col("slot") - 1) / 4).alias("hour"),
        )
    )
    known = prices.select("date", "quarter_hour_start", "activated_volume_mw", "marginal_price")
    return grid.join(known, ["date", "quarter_hour_start"], "left")


def price_gaps(prices: DataFrame, max_gap_hours: float = 0.25) -> DataFrame:
    """Priced quarter-hours numbered by unbroken segment; a day has 100 quarter-hours at most."""
    day = Window.partitionBy("date").orderBy("hour")
    hour = (tc.quarter_of_time(F.col("quarter_hour_start")) - 1) / 4
    return (
        prices.filter(F.col("marginal_price").isNotNull())
        .select("date", "quarter_hour_start", "marginal_price", hour.alias("hour"))
        .withColumn("gap_hours", F.col("hour") - F.lag("hour").over(day))
        .withColumn("connected", F.coalesce(F.col("gap_hours") <= max_gap_hours, F.lit(False)))
        .withColumn("segment", F.sum(F.when(F.col("connected"), 0).otherwise(1)).over(day))
    )
