"""Stored tables with validity, and rules that are rows of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridclear.operators import rules as ru
from gridclear.operators.cleaning import bid_rules
from gridclear.plans import market_views as mv
from gridclear.plans.oracle_views import MESSY, with_act, with_bids
from gridclear.plans.registry import query
from gridclear.schema import ACTIVATIONS
from gridclear.session import scratch_dir
from gridclear.sources.history_table import HistoryTable

# The second load has January's volumes from the 15th on, with other values for even quarter-hours; the third lacks odd ones of January.
FIRST, SECOND, THIRD = "2024-02-01 06:00:00", "2024-02-02 06:00:00", "2024-02-03 06:00:00"
HISTORY_SQL = f"""history AS (
  SELECT a.date, a.quarter_no, v + x.added AS v, x.since, x.until FROM act a, LATERAL (
    SELECT 0 AS added, TIMESTAMP '{FIRST}' AS since, CASE WHEN month(a.date) = 1 AND a.quarter_no % 2 = 1 THEN TIMESTAMP '{THIRD}'
      WHEN a.date BETWEEN DATE '2024-01-15' AND DATE '2024-01-31' AND a.quarter_no % 2 = 0 THEN TIMESTAMP '{SECOND}' END AS until
    UNION ALL SELECT 1, TIMESTAMP '{SECOND}', NULL WHERE a.date BETWEEN DATE '2024-01-15' AND DATE '2024-01-31' AND a.quarter_no % 2 = 0) x)"""


def _history(spark, sf):
    table = HistoryTable(spark, scratch_dir(spark, "history"), ACTIVATIONS, ["year", "month"], ["date", "quarter_no", "time_zone"])
    rows = mv.activations(spark, sf)
    raised = F.when(F.col("quarter_no") % 2 == 0, F.expr("activated_volume_mw + 1")).otherwise(F.col("activated_volume_mw"))
    late = rows.filter("date BETWEEN '2024-01-15' AND '2024-01-31'").withColumn("activated_volume_mw", raised)
    table.load(rows, FIRST)
    table.load(late, SECOND)
    table.load(late, SECOND)  # a load that is repeated changes nothing
    even = table.current().filter("month = 1 AND year = 2024 AND quarter_no % 2 = 0")
    table.load(even, THIRD, complete=True)
    return table


@query(
    with_act(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw, CAST(since AS VARCHAR) AS effective_from,
       CAST(until AS VARCHAR) AS effective_to FROM history""",
        HISTORY_SQL,
    )
)
def stored_history(spark, sf):
    return _history(spark, sf).read().select("date", "quarter_no", "activated_volume_mw", "effective_from", "effective_to")


@query(
    with_act(
        """SELECT moment, CAST(date AS VARCHAR) AS date, COUNT(*) AS intervals, CAST(SUM(v) AS DOUBLE) AS volume
FROM history, (VALUES ('2024-01-31 00:00:00'), ('2024-02-01 06:00:00'), ('2024-02-02 12:00:00'), ('2024-02-03 12:00:00')) t(moment)
WHERE since <= CAST(moment AS TIMESTAMP) AND (until IS NULL OR until > CAST(moment AS TIMESTAMP)) GROUP BY ALL""",
        HISTORY_SQL,
    )
)
def history_as_of(spark, sf):
    table, found = _history(spark, sf), None
    for at in ("2024-01-31 00:00:00", FIRST, "2024-02-02 12:00:00", "2024-02-03 12:00:00"):
        state = table.as_of(at).groupBy("date").agg(F.count("*").alias("intervals"), F.sum("activated_volume_mw").alias("volume"))
        state = state.select(F.lit(at).alias("moment"), "*")
        found = state if found is None else found.unionByName(state)
    return found


# Files of even suppliers name a period, the others none.
NAMED_SQL = """named AS (SELECT *, source_file IN ('file_0', 'file_2') AS has_period FROM messy),
judged AS (SELECT delivery_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AS date_in_range,
  regexp_matches(product, '^[A-Z]+_[0-9]+') AS product_pattern, price BETWEEN -50 AND 100 AS price_in_range, mw BETWEEN 0 AND 45 AS capacity_in_range,
  NOT has_period OR delivery_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AS named_period, price <= 150 AS dear FROM named)"""


def _bids_and_rules(spark, sf):
    named = F.lit("/landing/RESULT_LIST_ANONYM_ENERGY_MARKET_aFRR_DE_2024-01-03_2024-01-20.xlsx")
    bids = mv.messy_bids(spark, sf)
    bids = bids.withColumn("source_file", F.when(F.col("source_file").isin("file_0", "file_2"), named).otherwise(F.col("source_file")))
    more = [ru.Rule("named_period", "named_period", ("delivery_date", "source_file")), ru.Rule("dear", "range", ("energy_price_eur_mwh",), high="150")]
    path = scratch_dir(spark, "rules")
    spark.createDataFrame([*bid_rules("2024-01-05", "2024-01-25", (-50, 100), 45), *more], ru.RULES).write.parquet(path)
    return bids, spark.read.parquet(path)


@query(
    with_bids(
        " UNION ALL ".join(
            f"SELECT '{rule}' AS rule, COUNT(*) FILTER (NOT {rule}) AS failed_rows, COUNT(*) AS checked_rows FROM judged"
            for rule in ("date_in_range", "product_pattern", "price_in_range", "capacity_in_range", "named_period", "dear")
        )
        + " UNION ALL SELECT 'no_nulls', 0, COUNT(*) FROM judged",
        MESSY,
        NAMED_SQL,
    )
)
def rule_checks(spark, sf):
    return ru.check_rules(*_bids_and_rules(spark, sf))


@query(
    with_bids(
        """SELECT concat_ws(',', CASE WHEN NOT capacity_in_range THEN 'capacity_in_range' END, CASE WHEN NOT date_in_range THEN 'date_in_range' END,
  CASE WHEN NOT dear THEN 'dear' END, CASE WHEN NOT named_period THEN 'named_period' END, CASE WHEN NOT price_in_range THEN 'price_in_range' END,
  CASE WHEN NOT product_pattern THEN 'product_pattern' END) AS broken, COUNT(*) AS bids FROM judged GROUP BY 1""",
        MESSY,
        NAMED_SQL,
    )
)
def rule_breaches(spark, sf):
    found = ru.broken_rules(*_bids_and_rules(spark, sf))
    return found.groupBy(F.array_join("broken_rules", ",").alias("broken")).agg(F.count("*").alias("bids"))
