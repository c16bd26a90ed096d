"""Activations, bids and prices derived from the given ``events`` and ``lineitem`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclear.functions import timecode as tc
from gridclear.functions.parsing import signed_price, to_decimal_comma
from gridclear.operators.merit_order import marginal_prices
from gridclear.schema import POWER, PRICE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def activations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day and quarter-hour with events; the volume is the sum of their values."""
    date, quarter = F.col("date"), F.col("quarter_no")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), tc.quarter_of_timestamp(F.col("ts")).alias("quarter_no"))
        .agg(F.sum(F.col("value").cast(POWER)).cast(POWER).alias("activated_volume_mw"))
        .select(
            date,
            quarter,
            tc.interval_start(date, quarter).alias("interval_start"),
            tc.quarter_start(quarter).alias("quarter_hour_start"),
            tc.quarter_end(quarter).alias("quarter_hour_end"),
            "activated_volume_mw",
            F.lit("CET").alias("time_zone"),
            F.month(date).alias("month"),
            F.year(date).alias("year"),
        )
    )


def raw_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unsigned bid per line item, with positive and negative products."""
    day = F.pmod(F.col("l_orderkey"), F.lit(30)).cast("int")
    quarter = (F.pmod(F.col("l_partkey"), F.lit(96)) + 1).cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("delivery_date"),
        F.concat(
            F.when(F.col("l_linestatus") == "F", "NEG_").otherwise("POS_"), F.lpad(quarter.cast("string"), 3, "0")
        ).alias("product"),
        (F.floor(F.col("l_extendedprice") / 10 + 0.5) / 100).cast(PRICE).alias("energy_price"),
        F.when(F.col("l_returnflag") == "A", "PROVIDER_TO_GRID").otherwise("GRID_TO_PROVIDER").alias("payment_direction"),
        F.col("l_quantity").cast(POWER).alias("allocated_capacity_mw"),
        F.when(F.col("l_linenumber") <= 4, "aFRR").otherwise("mFRR").alias("type_of_reserves"),
        F.concat(F.lit("file_"), F.pmod(F.col("l_suppkey"), F.lit(4)).cast("string")).alias("source_file"),
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_linestatus").alias("line_status"),
        quarter.alias("slot"),
        day.alias("day_no"),
    )


def all_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed bids of both directions in the canonical column names."""
    return raw_bids(spark, sf_dir).select(
        "delivery_date",
        "product",
        signed_price(F.col("energy_price"), F.col("payment_direction")).cast(PRICE).alias("energy_price_eur_mwh"),
        "payment_direction",
        "allocated_capacity_mw",
        F.lit(None).cast(POWER).alias("offered_capacity_mw"),
        "type_of_reserves",
        tc.block_start(F.col("delivery_date"), F.col("slot")).alias("block_start"),
        tc.block_end(F.col("delivery_date"), F.col("slot")).alias("block_end"),
        "source_file",
        "order_no",
        "line_no",
        "line_status",
        "slot",
        "day_no",
    )


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed negative-product bids."""
    return all_bids(spark, sf_dir).filter("line_status = 'F'")


def messy_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bids with product codes in five spellings; the bids of some intervals have a code that means none."""
    number = F.lpad(F.col("slot").cast("string"), 3, "0")
    style = F.pmod(F.col("day_no") + F.col("slot"), F.lit(5))
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("NEG_", "NEG-", "neg_", "NEG_", "NEG_X")]), style + 1)
    unusable = F.pmod(F.col("day_no") * 7 + F.col("slot"), F.lit(11)) == 0
    code = F.concat(prefix, F.when(style == 3, F.col("slot").cast("string")).otherwise(number))
    return bids(spark, sf_dir).withColumn("product", F.when(unusable, "NEG_000").otherwise(code))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marginal-price table of the messy bids."""
    return marginal_prices(activations(spark, sf_dir), messy_bids(spark, sf_dir))


def activation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_activation_text(activations(spark, sf_dir))


def as_activation_text(rows: DataFrame) -> DataFrame:
    """Activations as a raw file spells them: German dates, decimal commas, a blank after a column name."""
    volume = to_decimal_comma(F.col("activated_volume_mw"))
    return rows.select(
        F.date_format("date", "dd.MM.yyyy").alias("Datum "),
        F.col("time_zone").alias("Zeitzone"),
        F.col("quarter_hour_start").alias("von"),
        F.col("quarter_hour_end").alias("bis"),
        volume.alias("50Hertz (Negativ)"),
        volume.alias("Amprion (Negativ)"),
    )


def date_text(date: Column, day_no: Column) -> Column:
    """A delivery date in one of the three layouts inputs use."""
    iso = date.cast("string")
    american = F.concat_ws("/", F.substring(iso, 6, 2), F.substring(iso, 9, 2), F.substring(iso, 1, 4))
    style = F.pmod(day_no, F.lit(3))
    return (
        F.when(style == 0, iso)
        .when(style == 1, F.concat(iso, F.lit(" 00:00:00")))
        .otherwise(F.when(date.isNotNull(), american))
    )


def bid_text(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """Unsigned bids as raw sheets spell them, every value as text."""
    return raw_bids(spark, sf_dir).select(
        date_text(F.col("delivery_date"), F.col("day_no")).alias("DELIVERY_DATE"),
        F.col("product").alias("PRODUCT"),
        to_decimal_comma(F.col("energy_price")).alias("ENERGY_PRICE_[EUR/MWh]"),
        F.col("payment_direction").alias("ENERGY_PRICE_PAYMENT_DIRECTION"),
        to_decimal_comma(F.col("allocated_capacity_mw")).alias("ALLOCATED_CAPACITY_[MW]"),
        F.col("type_of_reserves").alias("TYPE_OF_RESERVES"),
        F.lit(None).cast("string").alias("NOTE"),
        "source_file",
        *(extra or []),
    )
