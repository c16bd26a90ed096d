"""Queries on activations, bids and marginal prices."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclear.functions import parsing as ps
from gridclear.functions import timecode as tc
from gridclear.operators import cleaning as cl
from gridclear.operators import coverage as cv
from gridclear.operators import local_days as ld
from gridclear.operators import merit_order as mo
from gridclear.operators import overlap as ov
from gridclear.operators import reconcile as rc
from gridclear.plans import market_views as mv
from gridclear.plans.oracle_views import (
    ACT,
    CODE,
    END,
    MESSY,
    START,
    cleared,
    clock,
    with_act,
    with_bids,
    with_market,
    with_prices,
)
from gridclear.plans.registry import query
from gridclear.schema import POWER, PRICE
from gridclear.session import scratch_dir

DAY = "2024-01-15"

# --- clearing ------------------------------------------------------------------------------------


@query(
    with_prices(
        """SELECT CAST(date AS VARCHAR) AS date, CAST(timestamp AS VARCHAR) AS timestamp, quarter_hour_start,
       quarter_hour_end, CAST(activated_volume_mw AS DOUBLE) AS activated_volume_mw,
       CAST(available_capacity_mw AS DOUBLE) AS available_capacity_mw,
       CAST(cleared_capacity_mw AS DOUBLE) AS cleared_capacity_mw, CAST(marginal_price AS DOUBLE) AS marginal_price,
       product_code, match_tier, is_short, time_zone FROM prices"""
    )
)
def marginal_prices(spark, sf):
    return mv.prices(spark, sf)


@query(
    with_market(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw,
       CAST(price AS DOUBLE) AS price, is_short FROM cleared_exact""",
        """exact_stack AS (
  SELECT delivery_date, slot AS quarter_no, price, mw,
         SUM(mw) OVER (PARTITION BY delivery_date, slot ORDER BY price) AS cum FROM bids)""",
        """cleared_exact AS (
  SELECT a.date, a.quarter_no, a.v,
         COALESCE(MIN(CASE WHEN s.cum >= a.v THEN s.price END), MAX(s.price)) AS price,
         COALESCE(a.v > SUM(s.mw), FALSE) AS is_short
  FROM act a LEFT JOIN exact_stack s ON s.delivery_date = a.date AND s.quarter_no = a.quarter_no
  GROUP BY a.date, a.quarter_no, a.v)""",
    )
)
def marginal_prices_last_bid_if_short(spark, sf):
    found = mo.clear(mv.activations(spark, sf), mv.bids(spark, sf), on_short="last")
    return found.select("date", "quarter_no", "activated_volume_mw", "price", "is_short")


SCENARIOS = {"base": 1.0, "half": 0.5, "double": 2.0}


@query(
    with_market(
        """SELECT scenario, CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw,
       CAST(price AS DOUBLE) AS price, is_short FROM what_if""",
        """demand AS (
  SELECT 'base' AS scenario, date, quarter_no, v AS mw FROM act
  UNION ALL SELECT 'half', date, quarter_no, round(v * 0.5, 3) FROM act
  UNION ALL SELECT 'double', date, quarter_no, v * 2 FROM act
  UNION ALL SELECT 'fixed', date, quarter_no, 138 FROM act)""",
        cleared("a.mw", "demand a", "a.scenario, a.date, a.quarter_no").replace("cleared AS", "what_if AS", 1),
    )
)
def what_if_price(spark, sf):
    found = mo.what_if_price(mv.activations(spark, sf), mv.messy_bids(spark, sf), SCENARIOS, {"fixed": 138})
    return found.select("scenario", "date", "quarter_no", "activated_volume_mw", "price", "is_short")


@query(
    with_bids(
        """SELECT CAST(a.date AS VARCHAR) AS date, a.quarter_no, b.product, CAST(b.price AS DOUBLE) AS price,
       CAST(b.mw AS DOUBLE) AS capacity_mw, CAST(a.v AS DOUBLE) AS activated_volume_mw
FROM act a JOIN bids b ON b.delivery_date = a.date AND b.slot = a.quarter_no""",
        ACT,
    )
)
def match_bids_exact(spark, sf):
    return mo.match_bids_exact(mv.activations(spark, sf), mv.bids(spark, sf))


@query(
    with_market(
        """SELECT CAST(a.date AS VARCHAR) AS date, a.quarter_no, s.product, CAST(s.price AS DOUBLE) AS price,
       CAST(s.mw AS DOUBLE) AS capacity_mw, CAST(a.v AS DOUBLE) AS activated_volume_mw, s.tier AS match_tier
FROM act a JOIN stack s ON s.delivery_date = a.date AND s.quarter_no = a.quarter_no"""
    )
)
def match_bids_tiered(spark, sf):
    return mo.match_bids_tiered(mv.activations(spark, sf), mv.messy_bids(spark, sf))


@query(
    with_market(
        "SELECT CAST(delivery_date AS VARCHAR) AS date, quarter_no, MIN(tier) AS match_tier FROM matched GROUP BY ALL"
    )
)
def best_match_tier(spark, sf):
    return mo.best_match_tier(mv.messy_bids(spark, sf))


@query(
    with_market(
        """SELECT CAST(a.date AS VARCHAR) AS date, a.quarter_no, CAST(a.v AS DOUBLE) AS activated_volume_mw,
       'NEG_' || lpad(CAST(a.quarter_no AS VARCHAR), 3, '0') AS product_code, COALESCE(d.products, '') AS neg_products
FROM act a LEFT JOIN day_products d ON d.date = a.date
WHERE abs(a.v) >= 0.001 AND NOT EXISTS (
  SELECT 1 FROM matched m WHERE m.delivery_date = a.date AND m.quarter_no = a.quarter_no)""",
        """day_products AS (
  SELECT delivery_date AS date, string_agg(product, ',' ORDER BY product) AS products FROM (
    SELECT delivery_date, product, row_number() OVER (PARTITION BY delivery_date ORDER BY product) AS r
    FROM (SELECT DISTINCT delivery_date, product FROM messy WHERE product LIKE '%NEG%' OR product LIKE '%neg%'))
  WHERE r <= 5 GROUP BY 1)""",
    )
)
def intervals_without_bids(spark, sf):
    return mo.intervals_without_bids(mv.activations(spark, sf), mv.messy_bids(spark, sf))


@query(
    with_market(
        """SELECT CAST(delivery_date AS VARCHAR) AS date, quarter_no, MIN(tier) AS match_tier,
       CAST(SUM(mw) AS DOUBLE) AS available_capacity_mw, COUNT(*) AS bid_count FROM stack GROUP BY 1, 2"""
    )
)
def available_capacity(spark, sf):
    return mo.available_capacity(mv.messy_bids(spark, sf))


@query(
    with_market(
        """SELECT CAST(delivery_date AS VARCHAR) AS date, quarter_no, tier AS match_tier, CAST(price AS DOUBLE) AS price,
       CAST(SUM(mw) AS DOUBLE) AS level_mw, COUNT(*) AS bid_count, CAST(MAX(cum) AS DOUBLE) AS cumulative_mw
FROM stack GROUP BY ALL"""
    )
)
def merit_order_curve(spark, sf):
    return mo.merit_order_curve(mv.messy_bids(spark, sf))


@query(
    with_market(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw,
       CAST(available AS DOUBLE) AS available_capacity_mw, CAST(v - available AS DOUBLE) AS shortfall_mw
FROM cleared WHERE is_short"""
    )
)
def capacity_shortfall(spark, sf):
    return mo.capacity_shortfall(mv.activations(spark, sf), mv.messy_bids(spark, sf))


@query(
    with_bids(
        """SELECT CAST(a.date AS VARCHAR) AS date, a.quarter_no, CAST(a.v AS DOUBLE) AS activated_volume_mw,
       CAST((a.quarter_no - 1) // 16 AS INTEGER) AS block_index, COUNT(b.mw) AS active_bids,
       CAST(SUM(b.mw) AS DOUBLE) AS active_capacity_mw, CAST(MIN(b.price) AS DOUBLE) AS lowest_price,
       CAST(MAX(b.price) AS DOUBLE) AS highest_price
FROM act a LEFT JOIN bids b ON b.delivery_date = a.date AND (b.slot - 1) // 16 = (a.quarter_no - 1) // 16
GROUP BY ALL""",
        ACT,
    )
)
def bids_overlapping_interval(spark, sf):
    return mo.bids_overlapping_interval(mv.activations(spark, sf), mv.bids(spark, sf))


@query(
    with_bids(
        """SELECT CAST(a.date AS VARCHAR) AS date, a.quarter_no, CAST(a.v AS DOUBLE) AS activated_volume_mw,
       CAST((a.quarter_no - 1) // 16 AS INTEGER) AS block_index, b.product, CAST(b.price AS DOUBLE) AS price, CAST(b.mw AS DOUBLE) AS capacity_mw
FROM act a JOIN bids b ON b.delivery_date = a.date AND (b.slot - 1) // 16 = (a.quarter_no - 1) // 16""",
        ACT,
    )
)
def active_bids(spark, sf):
    """The view is stored and read again, as reports that ask for it often do."""
    path = scratch_dir(spark, "active-bids")
    mo.active_bids(mv.activations(spark, sf), mv.bids(spark, sf)).write.partitionBy("date").parquet(path)
    return spark.read.parquet(path)


@query(
    """WITH spells AS (
  SELECT user_id, date_trunc('minute', MIN(ts)) AS lo, date_trunc('minute', MAX(ts)) + INTERVAL 1 MINUTE AS hi
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
blocks AS (
  SELECT CAST(ts AS DATE) + (extract(hour FROM ts) // 4) * INTERVAL 4 HOUR AS lo, COUNT(*) AS events
  FROM events GROUP BY 1)
SELECT CAST(b.lo AS VARCHAR) AS block_start, b.events, s.user_id, CAST(s.lo AS VARCHAR) AS spell_start
FROM blocks b JOIN spells s ON s.lo < b.lo + INTERVAL 4 HOUR AND s.hi > b.lo"""
)
def overlapping_ranges(spark, sf):
    events = mv.table(spark, sf, "events")
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    spells = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min(minute).alias("start_ts"), F.timestamp_add("MINUTE", F.lit(1), F.max(minute)).alias("end_ts")
    )
    block = tc.block_start(F.to_date("ts"), tc.quarter_of_timestamp(F.col("ts")))
    blocks = (
        events.groupBy(block.alias("start_ts"))
        .agg(F.count("*").alias("events"))
        .withColumn("end_ts", F.timestamp_add("HOUR", F.lit(4), F.col("start_ts")))
    )
    pairs = ov.overlap_join(
        blocks, spells.select("user_id", "start_ts", "end_ts", F.col("start_ts").alias("spell_start")), 240
    )
    return pairs.select(F.col("start_ts").alias("block_start"), "events", "user_id", "spell_start")


@query(
    """WITH ids AS (SELECT user_id, MIN(ts) AS lo, MAX(ts) + INTERVAL 10 YEAR AS hi FROM events GROUP BY user_id HAVING user_id % 10 = 0),
moments AS (
  SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-10 12:00:00' + (event_id % 3600) * INTERVAL 1 SECOND ELSE ts END AS lo FROM events),
spans AS (SELECT event_id, lo, lo + (1 + event_id % 90) * INTERVAL 1 SECOND AS hi FROM moments)
SELECT s.event_id % 100 AS part, COUNT(*) AS pairs, CAST(SUM(i.user_id) AS BIGINT) AS user_ids
FROM spans s JOIN ids i ON s.lo < i.hi AND s.hi > i.lo GROUP BY 1"""
)
def overlapping_long_ranges(spark, sf):
    """A third of all short ranges in one hour, and ranges of ten years."""
    events = mv.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    ids = events.groupBy("user_id").agg(F.min("ts").alias("start_ts"), F.timestamp_add("YEAR", F.lit(10), F.max("ts")).alias("end_ts"))
    hour = F.timestamp_add("SECOND", (F.col("event_id") % 3600).cast("int"), F.lit("2024-01-10 12:00:00").cast("timestamp_ntz"))
    spans = events.select("event_id", F.when(F.col("event_id") % 3 == 0, hour).otherwise(F.col("ts")).alias("start_ts"))
    spans = spans.withColumn("end_ts", F.timestamp_add("SECOND", (1 + F.col("event_id") % 90).cast("int"), F.col("start_ts")))
    pairs = ov.overlap_join(spans, ids.filter("user_id % 10 = 0"), 15, hot_rows=1000)
    return pairs.groupBy((F.col("event_id") % 100).alias("part")).agg(F.count("*").alias("pairs"), F.sum("user_id").alias("user_ids"))


# --- activations ---------------------------------------------------------------------------------


@query(
    with_act(
        f"""SELECT CAST(date AS VARCHAR) AS date, quarter_no, {START} AS quarter_hour_start, {END} AS quarter_hour_end,
       CAST(v AS DOUBLE) AS activated_volume_mw FROM act"""
    )
)
def activation_demand(spark, sf):
    return mo.activation_demand(mv.activations(spark, sf))


GERMAN = f"""SELECT strftime(date, '%d.%m.%Y') AS "Datum", {START} AS von, {END} AS bis,
       replace(CAST(v AS VARCHAR), '.', ',') AS "50Hertz (Negativ)" FROM act"""


@query(with_act(GERMAN))
def select_activation_columns(spark, sf):
    return cl.select_activation_columns(mv.activation_text(spark, sf))


@query(
    with_act(
        f"""SELECT CAST(date AS VARCHAR) AS "Datum", {START} || ':00' AS von, {END} || ':00' AS bis,
       CAST(v AS DOUBLE) AS "50Hertz (Negativ)" FROM act"""
    )
)
def clean_activations(spark, sf):
    return cl.clean_activations(cl.select_activation_columns(mv.activation_text(spark, sf)))


def _verdicts(frames, validate):
    """The verdict on each of several inputs by name."""
    found = [validate(df).withColumn("input", F.lit(name)) for name, df in frames.items()]
    return functools.reduce(DataFrame.unionByName, found)


@query(
    with_act(
        """SELECT 'as it is' AS input, TRUE AS valid, 'ok' AS message
UNION ALL SELECT 'empty', FALSE, 'no_rows'
UNION ALL SELECT 'late quarters without start', FALSE, 'start_time: ' || CAST(COUNT(*) FILTER (quarter_no > 90) AS VARCHAR) FROM act
UNION ALL SELECT 'early volumes as words', FALSE, 'volume_not_numeric: ' || CAST(COUNT(*) FILTER (quarter_no <= 10) AS VARCHAR) FROM act
UNION ALL SELECT 'no end', FALSE, 'columns_absent: bis'"""
    )
)
def validate_activations(spark, sf):
    text = mv.activation_text(spark, sf).withColumn("quarter", F.substring("von", 1, 2).cast("int") * 4 + F.substring("von", 4, 2).cast("int") / 15 + 1)
    zone = cl.ZONE_COLUMN
    wordy = text.withColumn(zone, F.when(F.col("quarter") <= 10, "abc").otherwise(F.col(f"`{zone}`")))
    no_start = text.withColumn("von", F.when(F.col("quarter") > 90, "noon").otherwise(F.col("von")))
    inputs = {"as it is": text, "empty": text.filter(F.lit(False)), "late quarters without start": no_start, "early volumes as words": wordy}
    frames = {name: cl.clean_activations(cl.select_activation_columns(df)) for name, df in inputs.items()}
    frames["no end"] = frames["as it is"].drop("bis")
    return _verdicts(frames, cl.validate_activations)


@query(with_act("SELECT CAST(date AS VARCHAR) AS date, quarter_no, month(date)::INT AS month, year(date)::INT AS year FROM act"))
def add_month_year(spark, sf):
    return cl.add_month_year(mv.activations(spark, sf).select("date", "quarter_no"))


@query(
    with_act(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw FROM act
WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""
    )
)
def date_range_filter(spark, sf):
    wanted = mo.date_range(mv.activations(spark, sf), "date", "2024-01-10", "2024-01-20")
    return wanted.select("date", "quarter_no", "activated_volume_mw")


@query(
    with_market(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(mw AS DOUBLE) AS activated_volume_mw,
       CAST(available AS DOUBLE) AS available_mw, CAST(price AS DOUBLE) AS price FROM thinned""",
        "demand AS (SELECT date, quarter_no, CASE WHEN v < 100 THEN CAST(0.0005 AS DECIMAL(38,4)) ELSE CAST(v AS DECIMAL(38,4)) END AS mw FROM act)",
        cleared("a.mw", "demand a").replace("cleared AS", "thinned AS", 1).replace("a.mw AS v", "a.mw AS mw", 1),
    )
)
def zero_activation_filter(spark, sf):
    low = F.when(F.col("activated_volume_mw") < 100, F.lit("0.0005").cast("decimal(18,4)"))
    demand = mv.activations(spark, sf).select(
        "date", "quarter_no", F.coalesce(low, F.col("activated_volume_mw")).alias("activated_volume_mw")
    )
    return mo.clear(demand, mv.messy_bids(spark, sf)).select(
        "date", "quarter_no", "activated_volume_mw", "available_mw", "price"
    )


@query(with_act(f"SELECT CAST(date AS VARCHAR) AS date, {START} AS quarter_hour_start, {CODE} AS product_code FROM act"))
def quarter_to_product(spark, sf):
    number = tc.quarter_of_time(F.col("quarter_hour_start"))
    return mv.activations(spark, sf).select("date", "quarter_hour_start", tc.product_code(number).alias("product_code"))


@query(with_act("SELECT DISTINCT CAST(date AS VARCHAR) AS date FROM act"))
def active_days(spark, sf):
    return cv.active_days(mv.activations(spark, sf))


@query(with_act("SELECT COUNT(*) AS row_count FROM act WHERE date >= DATE '2024-01-10'"))
def rows_in_range(spark, sf):
    return cv.rows_in_range(mv.activations(spark, sf), "2024-01-10")


@query(
    with_act(
        """SELECT CAST(MIN(date) AS VARCHAR) AS min_date, CAST(MAX(date) AS VARCHAR) AS max_date,
       COUNT(DISTINCT date) AS num_days, COUNT(*) AS total_records FROM act"""
    )
)
def activation_summary(spark, sf):
    return cv.activation_summary(mv.activations(spark, sf))


@query(with_act("SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS records FROM act GROUP BY 1"))
def activation_rows_per_day(spark, sf):
    return cv.records_per_date(mv.activations(spark, sf), "date")


@query(
    """WITH span AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders)
SELECT 'day' AS step, CAST(CAST(d AS DATE) AS VARCHAR) AS date, CAST(last_day(d) AS VARCHAR) AS month_end
FROM span, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) t(d)
UNION ALL SELECT 'month', CAST(CAST(d AS DATE) AS VARCHAR), CAST(last_day(d) AS VARCHAR)
FROM span, unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) t(d)
UNION ALL SELECT 'year', CAST(CAST(d AS DATE) AS VARCHAR), CAST(last_day(d) AS VARCHAR)
FROM span, unnest(generate_series(date_trunc('year', lo), hi, INTERVAL 1 YEAR)) t(d)"""
)
def calendar_points(spark, sf):
    day = F.to_date("o_orderdate")
    span = mv.table(spark, sf, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    parts = [tc.calendar_points(span, s).select(F.lit(s).alias("step"), "date", "month_end") for s in ("day", "month", "year")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- bids ----------------------------------------------------------------------------------------


@query(with_bids("SELECT product, COUNT(*) AS bids FROM all_bids WHERE NOT starts_with(product, 'POS_') GROUP BY 1"))
def drop_positive_products(spark, sf):
    return cl.drop_positive_products(mv.raw_bids(spark, sf), "product").groupBy("product").agg(F.count("*").alias("bids"))


@query(with_bids("SELECT order_no, line_no, payment_direction, CAST(price AS DOUBLE) AS price FROM all_bids"))
def signed_price(spark, sf):
    price = ps.signed_price(F.col("energy_price"), F.col("payment_direction"))
    return mv.raw_bids(spark, sf).select("order_no", "line_no", "payment_direction", price.alias("price"))


CLEAN_SELECT = """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, product, CAST(price AS DOUBLE) AS energy_price_eur_mwh,
       payment_direction, CAST(mw AS DOUBLE) AS allocated_capacity_mw, type_of_reserves,
       CAST(delivery_date + ((slot - 1) // 16) * INTERVAL 4 HOUR AS VARCHAR) AS block_start,
       CAST(delivery_date + ((slot - 1) // 16 + 1) * INTERVAL 4 HOUR AS VARCHAR) AS block_end, source_file FROM bids"""
CLEAN_COLUMNS = [
    "delivery_date",
    "product",
    "energy_price_eur_mwh",
    "payment_direction",
    "allocated_capacity_mw",
    "type_of_reserves",
    "block_start",
    "block_end",
    "source_file",
]


@query(with_bids(CLEAN_SELECT))
def clean_bids(spark, sf):
    return cl.clean_bids(mv.bid_text(spark, sf)).select(*CLEAN_COLUMNS)


@query(
    with_bids(
        """SELECT CASE WHEN order_no % 11 = 0 THEN 'no product' WHEN order_no % 7 = 0 THEN 'unreadable date'
         WHEN order_no % 5 = 0 THEN 'unreadable price' WHEN order_no % 3 = 0 THEN 'unreadable capacity' ELSE 'loaded' END AS reason,
       COUNT(*) FILTER (order_no % 11 = 0 OR order_no % 7 = 0 OR order_no % 5 = 0 OR order_no % 3 = 0 OR NOT starts_with(product, 'POS_')) AS n
FROM all_bids GROUP BY 1"""
    )
)
def quarantined_bids(spark, sf):
    """Bids with a missing product, an impossible date, a price that is no number, or too many decimals, by reason; and those loaded."""
    text = mv.bid_text(spark, sf, ["order_no"])

    def spoilt(name, divisor, value):
        return F.when(F.col("order_no") % divisor == 0, F.lit(value)).otherwise(F.col(f"`{name}`"))

    changes = {"PRODUCT": (11, None), "DELIVERY_DATE": (7, "31.31.2024"), "ENERGY_PRICE_[EUR/MWh]": (5, "1.234,56"), "ALLOCATED_CAPACITY_[MW]": (3, "1,2345")}
    raw = text.withColumns({name: spoilt(name, *change) for name, change in changes.items()})
    loaded = cl.clean_bids(raw).agg(F.lit("loaded").alias("reason"), F.count("*").alias("n"))
    return cl.quarantined_bids(raw).groupBy("reason").agg(F.count("*").alias("n")).unionByName(loaded)


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, CAST(price AS DOUBLE) AS energy_price_eur_mwh, product,
       CAST(mw AS DOUBLE) AS allocated_capacity_mw, source_file FROM bids ORDER BY ALL"""
    )
)
def sort_clean_bids(spark, sf):
    return cl.sort_clean_bids(
        mv.bids(spark, sf).select(
            "delivery_date", "energy_price_eur_mwh", "product", "allocated_capacity_mw", "source_file"
        )
    )


@query(
    with_market(
        """SELECT CAST(delivery_date AS VARCHAR) AS date, product, CAST(price AS DOUBLE) AS price, CAST(SUM(mw) AS DOUBLE) AS mw
FROM bids GROUP BY ALL"""
    )
)
def sort_merit_order(spark, sf):
    levels = mv.bids(spark, sf).groupBy(
        F.col("delivery_date").alias("date"), "product", F.col("energy_price_eur_mwh").alias("price")
    ).agg(F.sum("allocated_capacity_mw").alias("mw"))
    return levels.orderBy("date", "product", F.col("price").asc_nulls_last())


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, "DELIVERY_DATE_TEXT" AS date_text, order_no, line_no
FROM (SELECT *, CASE day_no % 3 WHEN 0 THEN strftime(delivery_date, '%Y-%m-%d')
      WHEN 1 THEN strftime(delivery_date, '%Y-%m-%d 00:00:00') ELSE strftime(delivery_date, '%m/%d/%Y') END
      AS "DELIVERY_DATE_TEXT" FROM all_bids)"""
    )
)
def parse_date_with_fallback(spark, sf):
    text = mv.date_text(F.col("delivery_date"), F.col("day_no"))
    return (
        mv.raw_bids(spark, sf)
        .select(text.alias("date_text"), "order_no", "line_no")
        .withColumn("delivery_date", ps.parse_date(F.col("date_text")))
    )


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) || ' 00:00:00' AS "DELIVERY_DATE", product AS "PRODUCT", order_no, line_no
FROM all_bids"""
    )
)
def standardize_date_column(spark, sf):
    rows = mv.bid_text(spark, sf, extra=["order_no", "line_no"])
    return cl.standardize_date_column(rows, "DELIVERY_DATE").select("DELIVERY_DATE", "PRODUCT", "order_no", "line_no")


@query(
    with_bids(
        """SELECT order_no, line_no, CAST(energy_price AS DOUBLE) AS price, CAST(mw AS DOUBLE) AS mw FROM all_bids"""
    )
)
def parse_decimal_comma(spark, sf):
    rows = mv.bid_text(spark, sf, extra=["order_no", "line_no"])
    return rows.select(
        "order_no",
        "line_no",
        ps.decimal_comma(F.col("`ENERGY_PRICE_[EUR/MWh]`"), PRICE).alias("price"),
        ps.decimal_comma(F.col("`ALLOCATED_CAPACITY_[MW]`")).alias("mw"),
    )


@query(
    with_bids(
        f"""SELECT product, slot AS quarter_no, {clock('(slot - 1) * 15')} AS time, CAST((slot - 1) // 16 AS INTEGER) AS block_index,
       lpad(CAST((slot - 1) // 16 * 4 AS VARCHAR), 2, '0') || ':00-' || lpad(CAST((slot - 1) // 16 * 4 + 4 AS VARCHAR), 2, '0')
         || ':00' AS block, COUNT(*) AS bids
FROM all_bids GROUP BY ALL"""
    )
)
def product_to_quarter(spark, sf):
    number = tc.quarter_of_product(F.col("product"))
    counts = mv.all_bids(spark, sf).groupBy("product").agg(F.count("*").alias("bids"))
    return counts.select(
        "product",
        number.alias("quarter_no"),
        tc.quarter_start(number).alias("time"),
        tc.block_index(number).alias("block_index"),
        tc.block_label(tc.block_index(number)).alias("block"),
        "bids",
    )


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, CAST((slot - 1) // 16 AS INTEGER) AS block_index,
       CAST(delivery_date + ((slot - 1) // 16) * INTERVAL 4 HOUR AS VARCHAR) AS block_start,
       CAST(delivery_date + ((slot - 1) // 16 + 1) * INTERVAL 4 HOUR AS VARCHAR) AS block_end,
       COUNT(*) AS bids, CAST(SUM(mw) AS DOUBLE) AS mw FROM bids GROUP BY ALL"""
    )
)
def period_bucket(spark, sf):
    return (
        cl.period_bucket(mv.bids(spark, sf))
        .groupBy("delivery_date", "block_index", "block_start", "block_end")
        .agg(F.count("*").alias("bids"), F.sum("allocated_capacity_mw").alias("mw"))
    )


@query(
    with_bids(
        """SELECT 'as it is' AS input, TRUE AS valid, 'ok' AS message
UNION ALL SELECT 'empty', FALSE, 'no_rows'
UNION ALL SELECT 'fourth lines without price', FALSE, 'energy_price_eur_mwh_absent: ' || CAST(COUNT(*) FILTER (line_no = 4) AS VARCHAR) FROM bids
UNION ALL SELECT 'messy codes', FALSE, 'product_code: ' || CAST(COUNT(*) FILTER (NOT regexp_matches(product, '^[A-Z]+_[0-9]+')) AS VARCHAR) FROM messy""",
        MESSY,
    )
)
def validate_bids(spark, sf):
    bids = mv.bids(spark, sf)
    price = F.when(F.col("line_no") != 4, F.col("energy_price_eur_mwh"))
    frames = {
        "as it is": bids, "empty": bids.filter(F.lit(False)), "messy codes": mv.messy_bids(spark, sf),
        "fourth lines without price": bids.withColumn("energy_price_eur_mwh", price),
    }
    return _verdicts(frames, cl.validate_bids)


@query(
    with_bids(
        """SELECT * FROM (
  SELECT 'date_in_range' AS rule, COUNT(*) FILTER (delivery_date NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')
         AS failed_rows, COUNT(*) AS checked_rows FROM messy
  UNION ALL SELECT 'product_pattern', COUNT(*) FILTER (NOT regexp_matches(product, '^[A-Z]+_[0-9]+')), COUNT(*) FROM messy
  UNION ALL SELECT 'price_in_range', COUNT(*) FILTER (price NOT BETWEEN -50 AND 100), COUNT(*) FROM messy
  UNION ALL SELECT 'capacity_in_range', COUNT(*) FILTER (mw NOT BETWEEN 0 AND 45), COUNT(*) FROM messy
  UNION ALL SELECT 'no_nulls', CAST(0 AS BIGINT), COUNT(*) FROM messy)""",
        MESSY,
    )
)
def quality_rules(spark, sf):
    return cl.quality_rules(mv.messy_bids(spark, sf), "2024-01-05", "2024-01-25", (-50, 100), 45)


@query(
    with_bids(
        """SELECT CAST(MIN(delivery_date) AS VARCHAR) AS min_date, CAST(MAX(delivery_date) AS VARCHAR) AS max_date,
       COUNT(DISTINCT delivery_date) AS num_days, COUNT(*) AS total_records FROM all_bids"""
    )
)
def provider_overview(spark, sf):
    return cv.provider_overview(mv.all_bids(spark, sf))


@query(with_bids("SELECT product, COUNT(*) AS bid_count FROM all_bids GROUP BY 1"))
def product_distribution(spark, sf):
    return cv.product_distribution(mv.all_bids(spark, sf))


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS date, COUNT(*) AS product_count,
       string_agg(product, ',' ORDER BY product) AS products
FROM (SELECT DISTINCT delivery_date, product FROM all_bids) GROUP BY 1"""
    )
)
def products_by_day(spark, sf):
    return cv.products_by_day(mv.all_bids(spark, sf))


@query(
    with_bids(
        f"""SELECT product, COUNT(*) AS offer_count, CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price
FROM all_bids WHERE delivery_date = DATE '{DAY}' AND product LIKE 'NEG%' GROUP BY 1"""
    )
)
def neg_product_stats(spark, sf):
    return cv.neg_product_stats(mv.all_bids(spark, sf), DAY)


@query(with_bids("SELECT type_of_reserves, COUNT(*) AS bid_count FROM all_bids GROUP BY 1"))
def reserve_types(spark, sf):
    return cv.reserve_types(mv.all_bids(spark, sf))


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS date, product, COUNT(*) AS offer_count, lower(product) LIKE '%neg%' AS is_neg
FROM all_bids GROUP BY ALL"""
    )
)
def offers_per_product(spark, sf):
    return cv.offers_per_product(mv.all_bids(spark, sf))


@query(with_bids("SELECT product, COUNT(DISTINCT delivery_date) AS days FROM all_bids GROUP BY 1"))
def product_presence(spark, sf):
    return cv.product_presence(mv.all_bids(spark, sf))


COUNTS = """counts AS (
  SELECT delivery_date AS date, product, slot, COUNT(*) AS bid_count,
         lpad(CAST((slot - 1) // 16 * 4 AS VARCHAR), 2, '0') || ':00-'
           || lpad(CAST((slot - 1) // 16 * 4 + 4 AS VARCHAR), 2, '0') || ':00' AS block
  FROM bids GROUP BY ALL)"""


@query(
    with_bids(
        f"""SELECT CAST(date AS VARCHAR) AS date, product, bid_count, slot AS interval_number, {clock('(slot - 1) * 15')} AS time,
       CAST((slot - 1) // 16 AS INTEGER) AS block_index, block FROM counts""",
        COUNTS,
    )
)
def bid_count_per_interval(spark, sf):
    return cv.bid_count_per_interval(mv.all_bids(spark, sf))


@query(
    with_bids(
        """SELECT CAST(date AS VARCHAR) AS date, block, MIN(bid_count) AS min_bids, MAX(bid_count) AS max_bids,
       round(AVG(bid_count), 6) AS mean_bids, round(stddev_samp(bid_count), 6) AS std_bids, COUNT(*) AS products
FROM counts GROUP BY ALL""",
        COUNTS,
    )
)
def block_statistics(spark, sf):
    found = cv.block_statistics(cv.bid_count_per_interval(mv.all_bids(spark, sf)))
    return found.withColumns({"mean_bids": F.round("mean_bids", 6), "std_bids": F.round("std_bids", 6)})


@query(
    with_bids(
        f"""SELECT CAST(date AS VARCHAR) AS date, block, product, {clock('(slot - 1) * 15')} AS time, bid_count, block_min, block_max
FROM (SELECT *, MIN(bid_count) OVER w AS block_min, MAX(bid_count) OVER w AS block_max FROM counts
      WINDOW w AS (PARTITION BY date, block)) WHERE bid_count <> block_min""",
        COUNTS,
    )
)
def block_inconsistencies(spark, sf):
    return cv.block_inconsistencies(cv.bid_count_per_interval(mv.all_bids(spark, sf)))


# Days whose negative products are all spelled otherwise have no product that begins with NEG.
DAYS_WITHOUT = """lower_days AS (
  SELECT * REPLACE (CASE WHEN day_no % 7 = 3 THEN lower(product) ELSE product END AS product) FROM all_bids)"""


def _lower_days(spark, sf):
    spelled = F.when(F.col("day_no") % 7 == 3, F.lower("product")).otherwise(F.col("product"))
    return mv.all_bids(spark, sf).withColumn("product", spelled)


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS date, COUNT(*) AS total_records,
       COUNT(*) FILTER (product LIKE 'NEG%') AS neg_records, COUNT(DISTINCT product) AS distinct_products,
       COUNT(DISTINCT product) FILTER (product LIKE 'NEG%') AS distinct_neg,
       COUNT(*) FILTER (product LIKE 'NEG%') > 0 AS has_neg FROM lower_days GROUP BY 1""",
        DAYS_WITHOUT,
    )
)
def neg_coverage_by_day(spark, sf):
    return cv.neg_coverage_by_day(_lower_days(spark, sf))


@query(
    with_bids(
        """SELECT product, COUNT(*) AS bid_count FROM lower_days WHERE delivery_date = (
  SELECT MIN(delivery_date) FROM (SELECT delivery_date FROM lower_days GROUP BY 1
    HAVING COUNT(*) FILTER (product LIKE 'NEG%') = 0))
GROUP BY 1 ORDER BY bid_count DESC, product LIMIT 10""",
        DAYS_WITHOUT,
    )
)
def products_of_first_day_without_neg(spark, sf):
    return cv.products_of_first_day_without_neg(_lower_days(spark, sf))


@query(with_bids("SELECT product, COUNT(*) AS bid_count FROM all_bids GROUP BY 1 ORDER BY bid_count DESC, product LIMIT 10"))
def top_products(spark, sf):
    return cv.top_products(mv.all_bids(spark, sf))


@query(
    with_market(
        """SELECT DISTINCT product FROM messy WHERE product LIKE 'NEG%' OR product LIKE 'neg%' ORDER BY product LIMIT 10"""
    )
)
def sample_products(spark, sf):
    return cv.sample_products(mv.messy_bids(spark, sf))


EXPECTED = """expected AS (
  SELECT d.date, CAST(q AS INTEGER) AS slot, 'NEG_' || lpad(CAST(q AS VARCHAR), 3, '0') AS product
  FROM (SELECT DISTINCT delivery_date AS date FROM messy) d, range(1, 97) t(q)),
present AS (SELECT DISTINCT delivery_date AS date, product FROM messy),
absent AS (SELECT * FROM expected e WHERE NOT EXISTS (
  SELECT 1 FROM present p WHERE p.date = e.date AND p.product = e.product))"""


@query(
    with_market(
        """SELECT CAST(a.date AS VARCHAR) AS date, a.product, CAST((slot - 1) // 4 AS INTEGER) AS hour,
       CAST((slot - 1) % 4 AS INTEGER) AS quarter, COALESCE(d.days, 0) AS days_with_product
FROM absent a LEFT JOIN (SELECT product, COUNT(*) AS days FROM present GROUP BY 1) d ON d.product = a.product""",
        EXPECTED,
    )
)
def missing_products(spark, sf):
    return cv.missing_products(mv.messy_bids(spark, sf))


@query(
    with_market(
        """SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS missing_count,
       array_to_string(list_sort(list_distinct(list((slot - 1) // 4))), ',') AS hours,
       array_to_string(list_sort(list_distinct(list((slot - 1) % 4))), ',') AS quarters FROM absent GROUP BY 1""",
        EXPECTED,
    )
)
def missing_pattern(spark, sf):
    return cv.missing_pattern(mv.messy_bids(spark, sf))


@query(with_market("SELECT CAST(date AS VARCHAR) AS date, product FROM absent", EXPECTED))
def difference_products(spark, sf):
    return cv.difference_products(mv.messy_bids(spark, sf))


@query(with_bids("SELECT CAST(delivery_date AS VARCHAR) AS date, COUNT(*) AS records FROM all_bids GROUP BY 1"))
def records_per_date(spark, sf):
    return cv.records_per_date(mv.all_bids(spark, sf))


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS date, COUNT(*) AS row_count, COUNT(DISTINCT source_file) AS file_count,
       CAST(MIN(price) AS DOUBLE) AS min_price, CAST(MAX(price) AS DOUBLE) AS max_price,
       CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price FROM all_bids GROUP BY 1"""
    )
)
def table_stats(spark, sf):
    return cv.table_stats(mv.all_bids(spark, sf))


# --- marginal prices -----------------------------------------------------------------------------


@query(
    with_prices(
        """SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS intervals, CAST(MIN(marginal_price) AS DOUBLE) AS min_price,
       CAST(SUM(marginal_price) AS DOUBLE) / NULLIF(COUNT(marginal_price), 0) AS avg_price,
       CAST(MAX(marginal_price) AS DOUBLE) AS max_price, CAST(SUM(activated_volume_mw) AS DOUBLE) AS total_volume_mw
FROM prices GROUP BY 1"""
    )
)
def daily_price_summary(spark, sf):
    return cv.daily_price_summary(mv.prices(spark, sf))


@query(
    with_prices(
        """SELECT COUNT(*) AS intervals, COUNT(marginal_price) AS priced,
       COUNT(marginal_price) * CAST(100 AS DOUBLE) / NULLIF(COUNT(*), 0) AS priced_percent,
       CAST(SUM(marginal_price) AS DOUBLE) / NULLIF(COUNT(marginal_price), 0) AS mean_price,
       CAST(MIN(marginal_price) AS DOUBLE) AS min_price, CAST(MAX(marginal_price) AS DOUBLE) AS max_price FROM prices"""
    )
)
def price_statistics(spark, sf):
    return cv.price_statistics(mv.prices(spark, sf))


@query(
    with_prices(
        """SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS intervals, COUNT(marginal_price) AS with_price,
       COUNT(*) - COUNT(marginal_price) AS without_price, COUNT(DISTINCT date) AS days,
       COUNT(marginal_price) * CAST(100 AS DOUBLE) / COUNT(*) AS priced_percent
FROM prices GROUP BY GROUPING SETS ((date), ())"""
    )
)
def price_coverage(spark, sf):
    return cv.price_coverage(mv.prices(spark, sf))


@query(
    with_prices(
        """SELECT CAST(timestamp AS VARCHAR) AS timestamp, CAST(marginal_price AS DOUBLE) AS marginal_price
FROM prices WHERE marginal_price IS NOT NULL ORDER BY 1"""
    )
)
def priced_intervals(spark, sf):
    return cv.priced_intervals(mv.prices(spark, sf))


@query(
    with_prices(
        f"""SELECT CAST(date AS VARCHAR) AS date, quarter_hour_start, quarter_hour_end,
       CAST(activated_volume_mw AS DOUBLE) AS activated_volume_mw, CAST(available_capacity_mw AS DOUBLE) AS available_capacity_mw,
       CAST(marginal_price AS DOUBLE) AS marginal_price, product_code
FROM prices WHERE date = DATE '{DAY}' ORDER BY 1, 2"""
    )
)
def view_marginal_prices(spark, sf):
    return cv.view_marginal_prices(mv.prices(spark, sf), DAY)


@query(
    with_prices(
        f"""SELECT CAST(g.date AS VARCHAR) AS date, {clock('(g.q - 1) * 15')} AS quarter_hour_start,
       (g.q - 1) / CAST(4 AS DOUBLE) AS hour, CAST(p.activated_volume_mw AS DOUBLE) AS activated_volume_mw,
       CAST(p.marginal_price AS DOUBLE) AS marginal_price
FROM (SELECT d.date, q FROM (SELECT DISTINCT date FROM prices) d, range(1, 97) t(q)) g
LEFT JOIN prices p ON p.date = g.date AND p.quarter_no = g.q"""
    )
)
def full_day_grid(spark, sf):
    return cv.full_day_grid(mv.prices(spark, sf))


@query(
    with_prices(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_hour_start, CAST(marginal_price AS DOUBLE) AS marginal_price, hour,
       gap_hours, COALESCE(gap_hours <= 0.25, FALSE) AS connected,
       CAST(SUM(CASE WHEN gap_hours <= 0.25 THEN 0 ELSE 1 END) OVER (PARTITION BY date ORDER BY hour) AS BIGINT) AS segment
FROM (SELECT *, hour - lag(hour) OVER (PARTITION BY date ORDER BY hour) AS gap_hours
      FROM (SELECT *, (quarter_no - 1) / CAST(4 AS DOUBLE) AS hour FROM prices WHERE marginal_price IS NOT NULL))"""
    )
)
def price_gaps(spark, sf):
    return cv.price_gaps(mv.prices(spark, sf))


# --- days on which clocks change -----------------------------------------------------------------

#: January's activations moved to the weeks around the last Sundays of March and October, which are 92 and 100 quarter-hours long.
MOVES = (70, 285)
ZONE_NAME = "CASE WHEN summer = 1 THEN 'CEST' ELSE 'CET' END AS time_zone"
ZONED = """moved_days AS (
  SELECT DISTINCT CAST(date + CAST(m AS INTEGER) AS DATE) AS date, m FROM act, (SELECT unnest([70, 285]) AS m)),
slots AS (
  SELECT d.date, d.m, CAST(q.n AS INTEGER) AS quarter_no, z.n AS summer,
         CAST(q.n - 1 + CASE WHEN d.date = DATE '2024-03-31' AND q.n > 12 THEN -4
           WHEN d.date = DATE '2024-10-27' AND z.n = 0 THEN 4 ELSE 0 END AS DOUBLE) / 4 AS elapsed_hours
  FROM moved_days d, range(1, 97) q(n), range(0, 2) z(n)
  WHERE CASE WHEN d.date = DATE '2024-03-31' THEN q.n NOT BETWEEN 9 AND 12 AND (z.n = 1) = (q.n > 12)
    WHEN d.date = DATE '2024-10-27' THEN (z.n = 1 AND q.n <= 12) OR (z.n = 0 AND q.n >= 9)
    ELSE (z.n = 1) = (d.date > DATE '2024-03-31' AND d.date < DATE '2024-10-27') END),
zoned AS (
  SELECT s.date, s.quarter_no, s.summer, s.elapsed_hours, a.date AS was,
         CASE WHEN s.date = DATE '2024-10-27' AND s.summer = 0 AND s.quarter_no <= 12 THEN a.v + 40 ELSE a.v END AS v
  FROM slots s JOIN act a ON a.date = s.date - CAST(s.m AS INTEGER) AND a.quarter_no = s.quarter_no)"""
ZONED_PRICES = """zoned_prices AS (
  SELECT a.date, a.quarter_no, a.summer, MIN(a.elapsed_hours) AS elapsed_hours, MIN(a.v) AS v, MIN(CASE WHEN s.cum >= a.v THEN s.price END) AS price
  FROM zoned a LEFT JOIN stack s ON s.delivery_date = a.was AND s.quarter_no = a.quarter_no AND abs(a.v) >= 0.001
  GROUP BY a.date, a.quarter_no, a.summer)"""


def _moved_bids(spark, sf):
    bids = mv.messy_bids(spark, sf)
    day = F.explode(F.array(*[F.date_add("delivery_date", m) for m in MOVES]))
    return bids.withColumn("delivery_date", day)


def _moved_activations(spark, sf):
    """A row for each quarter-hour that the local day has; the second of two equal ones has 40 MW more."""
    moved = mv.activations(spark, sf).withColumn("date", F.explode(F.array(*[F.date_add("date", m) for m in MOVES]))).drop("time_zone")
    zoned = moved.join(ld.day_slots(moved), ["date", "quarter_no"])
    second = (F.col("time_zone") == "CET") & (F.col("time_zone") != ld.zone_at(F.col("date"), F.col("quarter_no")))
    return zoned.withColumn("activated_volume_mw", (F.col("activated_volume_mw") + F.when(second, 40).otherwise(0)).cast(POWER))


def _moved_prices(spark, sf):
    return mo.marginal_prices(_moved_activations(spark, sf), _moved_bids(spark, sf))


@query(
    with_market(
        f"""SELECT CAST(s.date AS VARCHAR) AS date, s.quarter_no, {ZONE_NAME.replace("summer", "s.summer")}, s.elapsed_hours, CAST(p.v AS DOUBLE) AS activated_volume_mw,
       CAST(p.price AS DOUBLE) AS marginal_price
FROM slots s LEFT JOIN zoned_prices p ON p.date = s.date AND p.quarter_no = s.quarter_no AND p.summer = s.summer""",
        ZONED,
        ZONED_PRICES,
    )
)
def local_day_grid(spark, sf):
    return ld.day_grid(_moved_prices(spark, sf)).drop("quarter_hour_start")


@query(
    with_market(
        f"""SELECT CAST(date AS VARCHAR) AS date, quarter_no, {ZONE_NAME}, elapsed_hours, CAST(price AS DOUBLE) AS marginal_price, gap_hours,
       coalesce(gap_hours <= 0.25, FALSE) AS connected, segment
FROM (
  SELECT *, SUM(CASE WHEN price IS NULL OR gap_hours <= 0.25 THEN 0 ELSE 1 END) OVER (PARTITION BY date ORDER BY elapsed_hours)::BIGINT AS segment
  FROM (
    SELECT s.*, p.price, s.elapsed_hours - MAX(CASE WHEN p.price IS NOT NULL THEN s.elapsed_hours END) OVER (
        PARTITION BY s.date ORDER BY s.elapsed_hours ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap_hours
    FROM slots s LEFT JOIN zoned_prices p ON p.date = s.date AND p.quarter_no = s.quarter_no AND p.summer = s.summer))
WHERE price IS NOT NULL""",
        ZONED,
        ZONED_PRICES,
    )
)
def elapsed_price_gaps(spark, sf):
    return ld.elapsed_price_gaps(_moved_prices(spark, sf)).drop("quarter_hour_start")


@query(
    with_act(
        """SELECT CAST(date AS VARCHAR) AS date, COUNT(*) AS slots, COUNT(*) FILTER (v IS NULL) AS missing, CAST(0 AS BIGINT) AS impossible
FROM slots LEFT JOIN zoned USING (date, quarter_no, summer) GROUP BY date""",
        ZONED,
    )
)
def incomplete_days(spark, sf):
    return ld.incomplete_days(_moved_activations(spark, sf))


# --- contents of loads ---------------------------------------------------------------------------


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, source_file,
       CASE WHEN delivery_date = DATE '2024-01-10' THEN 0 ELSE COUNT(*) END AS rows_before,
       CASE WHEN delivery_date = DATE '2024-01-20' THEN 0 ELSE COUNT(*) END AS rows_after,
       CASE WHEN delivery_date = DATE '2024-01-10' THEN 'new' WHEN delivery_date = DATE '2024-01-20' THEN 'missing'
         WHEN delivery_date = DATE '2024-01-12' AND bool_or(price <> 0) THEN 'changed' ELSE 'equal' END AS status
FROM bids GROUP BY bids.delivery_date, source_file"""
    )
)
def reconciled_content(spark, sf):
    """Days stored otherwise than delivered: signs turned on one, another lost, and one that was not delivered."""
    bids = mv.bids(spark, sf)
    day = F.col("delivery_date").cast("string")
    stored = bids.filter(day != "2024-01-20").repartition(7)
    price = F.when(day == "2024-01-12", -F.col("energy_price_eur_mwh")).otherwise(F.col("energy_price_eur_mwh")).cast(PRICE)
    columns = ["delivery_date", "product", "energy_price_eur_mwh", "offered_capacity_mw", "allocated_capacity_mw"]
    delivered = bids.filter(day != "2024-01-10")
    return rc.reconcile_content(delivered, stored.withColumn("energy_price_eur_mwh", price), ["delivery_date", "source_file"], columns)
