"""Views and price curves that are stored, brought up to date after a second load, and read."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridclear.operators import profile_state as ps
from gridclear.operators import profiling as pf
from gridclear.plans import market_views as mv
from gridclear.plans import workflows as wf
from gridclear.plans.market_queries import SCENARIOS
from gridclear.plans.oracle_views import ACT, ALL_BIDS, MATCHED, MESSY, RAW, cleared, with_
from gridclear.plans.registry import ORACLE, query
from gridclear.session import scratch_dir

# The second load: six days dearer by 1000, of which it lacks one.
RELOADED = """bids AS (SELECT * REPLACE (CASE WHEN delivery_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' THEN price + 1000 ELSE price END AS price)
  FROM all_bids WHERE NOT starts_with(product, 'POS_') AND delivery_date <> DATE '2024-01-12')"""


def _reload(table, bids):
    inside = bids.filter(F.col("delivery_date").between("2024-01-10", "2024-01-15") & (F.col("delivery_date") != "2024-01-12"))
    table.replace_range(inside.withColumn("energy_price_eur_mwh", F.expr("energy_price_eur_mwh + 1000")))


@query(ORACLE["what_if_price"])
def what_if_price_from_curve(spark, sf):
    """The demand's prices are read off stored curves; no bid is read for them."""
    root = scratch_dir(spark, "curve")
    bids = wf.bid_table(spark, f"{root}/bids")
    bids.replace_range(mv.messy_bids(spark, sf))
    curve = wf.PriceCurve(spark, f"{root}/curve", bids)
    curve.refresh()
    found = curve.what_if(mv.activations(spark, sf), SCENARIOS, {"fixed": 138})
    return found.select("scenario", "date", "quarter_no", "activated_volume_mw", "price", "is_short")


@query(
    with_(
        ACT, RAW, ALL_BIDS, RELOADED, MESSY, MATCHED, cleared(),
        select="""SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw, CAST(available AS DOUBLE) AS available_mw,
       CAST(cleared_mw AS DOUBLE) AS cleared_mw, CAST(price AS DOUBLE) AS price, tier AS match_tier, is_short FROM cleared""",
    )
)
def refreshed_price_curve(spark, sf):
    root = scratch_dir(spark, "curve")
    bids, rows = wf.bid_table(spark, f"{root}/bids"), mv.messy_bids(spark, sf)
    bids.replace_range(rows)
    curve = wf.PriceCurve(spark, f"{root}/curve", bids)
    curve.refresh()
    _reload(bids, rows)
    curve.refresh()
    return curve.prices(mv.activations(spark, sf).select("date", "quarter_no", "activated_volume_mw"))


@query(
    with_(
        ACT, RAW, ALL_BIDS, RELOADED,
        select="""SELECT CAST(a.date AS VARCHAR) AS date, a.quarter_no, CAST(a.v AS DOUBLE) AS activated_volume_mw,
       CAST((a.quarter_no - 1) // 16 AS INTEGER) AS block_index, b.product, CAST(b.price AS DOUBLE) AS price, CAST(b.mw AS DOUBLE) AS capacity_mw
FROM act a JOIN bids b ON b.delivery_date = a.date AND (b.slot - 1) // 16 = (a.quarter_no - 1) // 16""",
    )
)
def refreshed_active_bids(spark, sf):
    root = scratch_dir(spark, "active-bids")
    activations, bids = wf.activation_table(spark, f"{root}/activations"), wf.bid_table(spark, f"{root}/bids")
    activations.replace_partitions(mv.activations(spark, sf))
    bids.replace_range(mv.bids(spark, sf))
    view = wf.active_bid_view(spark, f"{root}/view", activations, bids)
    view.refresh()
    _reload(bids, mv.bids(spark, sf))
    view.refresh()
    return view.read()


PROFILED = {"product": "product", "energy_price_eur_mwh": "price", "allocated_capacity_mw": "mw", "type_of_reserves": "type_of_reserves"}


@query(
    with_(
        RAW, ALL_BIDS, RELOADED, "period AS (SELECT * FROM bids WHERE delivery_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')",
        select=" UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, COUNT(*) AS total_count, COUNT(*) - COUNT({c}) AS null_count, CAST(MIN({c}) AS VARCHAR) AS min_value,
       CAST(MAX({c}) AS VARCHAR) AS max_value, TRUE AS estimate_is_near FROM period"""
            for name, c in PROFILED.items()
        ),
    )
)
def profile_from_states(spark, sf):
    """Sixteen days from states of single days, of which a second load changed some; distinct values within four standard errors."""
    root = scratch_dir(spark, "profile")
    bids = wf.bid_table(spark, f"{root}/bids")
    bids.replace_range(mv.bids(spark, sf))
    view = wf.bid_profile_view(spark, f"{root}/view", bids, list(PROFILED))
    view.refresh()
    _reload(bids, mv.bids(spark, sf))
    view.refresh()
    days = F.col("delivery_date").between("2024-01-05", "2024-01-20")
    exact = pf.distinct_counts(bids.read().filter(days), list(PROFILED))
    near = F.abs(F.col("unique_estimate") - F.col("unique_values")) <= F.greatest(F.lit(1), F.col("unique_values") * 0.032)
    found = ps.profile_of(view.read().filter(days)).join(exact, "column_name")
    return found.select("column_name", "total_count", "null_count", "min_value", "max_value", near.alias("estimate_is_near"))
