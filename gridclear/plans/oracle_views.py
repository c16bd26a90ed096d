"""SQL common table expressions for the market views, for the comparison queries."""

from __future__ import annotations

ACT = """act AS (
  SELECT CAST(ts AS DATE) AS date,
         CAST(extract(hour FROM ts) * 4 + extract(minute FROM ts) // 15 + 1 AS INTEGER) AS quarter_no,
         SUM(CAST(value AS DECIMAL(18,3))) AS v
  FROM events GROUP BY 1, 2)"""

RAW = """raw AS (
  SELECT DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS delivery_date,
         CASE WHEN l_linestatus = 'F' THEN 'NEG_' ELSE 'POS_' END
           || lpad(CAST(l_partkey % 96 + 1 AS VARCHAR), 3, '0') AS product,
         CAST(floor(l_extendedprice / 10 + 0.5) / 100 AS DECIMAL(18,3)) AS energy_price,
         CASE WHEN l_returnflag = 'A' THEN 'PROVIDER_TO_GRID' ELSE 'GRID_TO_PROVIDER' END AS payment_direction,
         CAST(l_quantity AS DECIMAL(18,3)) AS mw,
         CASE WHEN l_linenumber <= 4 THEN 'aFRR' ELSE 'mFRR' END AS type_of_reserves,
         'file_' || CAST(l_suppkey % 4 AS VARCHAR) AS source_file,
         l_orderkey AS order_no, l_linenumber AS line_no,
         CAST(l_partkey % 96 + 1 AS INTEGER) AS slot, CAST(l_orderkey % 30 AS INTEGER) AS day_no
  FROM lineitem)"""

ALL_BIDS = """all_bids AS (
  SELECT *, CASE WHEN payment_direction = 'PROVIDER_TO_GRID' THEN -energy_price ELSE energy_price END AS price
  FROM raw)"""

BIDS = "bids AS (SELECT * FROM all_bids WHERE NOT starts_with(product, 'POS_'))"

MESSY = """messy AS (
  SELECT * EXCLUDE (product),
         CASE WHEN (7 * day_no + slot) % 11 = 0 THEN 'NEG_000' ELSE
           CASE (day_no + slot) % 5
             WHEN 0 THEN 'NEG_' || lpad(CAST(slot AS VARCHAR), 3, '0')
             WHEN 1 THEN 'NEG-' || lpad(CAST(slot AS VARCHAR), 3, '0')
             WHEN 2 THEN 'neg_' || lpad(CAST(slot AS VARCHAR), 3, '0')
             WHEN 3 THEN 'NEG_' || CAST(slot AS VARCHAR)
             ELSE 'NEG_X' || lpad(CAST(slot AS VARCHAR), 3, '0') END END AS product
  FROM bids)"""

MATCHED = """codes AS (
  SELECT CAST(q AS INTEGER) AS q, lpad(CAST(q AS VARCHAR), 3, '0') AS n FROM range(1, 97) t(q)),
product_match AS (
  SELECT product, q,
         CASE WHEN product = 'NEG_' || n THEN 1
              WHEN product IN ('NEG-' || n, 'NEG' || n, 'neg_' || n, 'NEG_' || CAST(q AS VARCHAR)) THEN 2
              WHEN product LIKE 'NEG%' || n OR product LIKE 'neg%' || n THEN 3 END AS tier
  FROM (SELECT DISTINCT product FROM messy), codes),
matched AS (
  SELECT m.*, p.q AS quarter_no, p.tier, MIN(p.tier) OVER (PARTITION BY m.delivery_date, p.q) AS best
  FROM messy m JOIN product_match p ON m.product = p.product AND p.tier IS NOT NULL),
stack AS (
  SELECT *, SUM(mw) OVER (PARTITION BY delivery_date, quarter_no ORDER BY price
                          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM matched WHERE tier = best)"""


def cleared(volume: str = "a.v", demand: str = "act a", keys: str = "a.date, a.quarter_no") -> str:
    """A CTE ``cleared`` over ``demand`` aliased ``a``."""
    return f"""cleared AS (
  SELECT {keys}, {volume} AS v, COALESCE(SUM(s.mw), 0) AS available,
         MIN(CASE WHEN s.cum >= {volume} THEN s.price END) AS price,
         COALESCE(MIN(CASE WHEN s.cum >= {volume} THEN s.cum END), SUM(s.mw), 0) AS cleared_mw,
         MIN(s.tier) AS tier, COALESCE({volume} > SUM(s.mw), FALSE) AS is_short
  FROM {demand} LEFT JOIN stack s
    ON s.delivery_date = a.date AND s.quarter_no = a.quarter_no AND abs({volume}) >= 0.001
  GROUP BY {keys}, {volume})"""


def clock(minutes: str) -> str:
    return (
        f"lpad(CAST(({minutes}) % 1440 // 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST(({minutes}) % 60 AS VARCHAR), 2, '0')"
    )


START, END = clock("(quarter_no - 1) * 15"), clock("quarter_no * 15")
CODE = "'NEG_' || lpad(CAST(quarter_no AS VARCHAR), 3, '0')"

MARKET = [ACT, RAW, ALL_BIDS, BIDS, MESSY, MATCHED, cleared()]
PRICES = f"""prices AS (
  SELECT date, quarter_no, date + (quarter_no - 1) * INTERVAL 15 MINUTE AS timestamp,
         {START} AS quarter_hour_start, {END} AS quarter_hour_end,
         v AS activated_volume_mw, available AS available_capacity_mw, cleared_mw AS cleared_capacity_mw,
         price AS marginal_price, {CODE} AS product_code, tier AS match_tier, is_short,
         'CET' AS time_zone
  FROM cleared)"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def with_act(select: str, *more: str) -> str:
    return with_(ACT, *more, select=select)


def with_bids(select: str, *more: str) -> str:
    return with_(RAW, ALL_BIDS, BIDS, *more, select=select)


def with_market(select: str, *more: str) -> str:
    return with_(*MARKET, *more, select=select)


def with_prices(select: str, *more: str) -> str:
    return with_(*MARKET, PRICES, *more, select=select)
