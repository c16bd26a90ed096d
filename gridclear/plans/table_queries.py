"""Generic table queries, run on whole given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridclear.functions import parsing as ps
from gridclear.operators import cleaning as cl
from gridclear.operators import profiling as pf
from gridclear.operators import reconcile as rc
from gridclear.plans import market_views as mv
from gridclear.plans.oracle_views import with_act, with_bids
from gridclear.plans.registry import query
from gridclear.schema import BIDS_RAW, clean_column_names, conform_to_schema

NAMES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]
# Column types of the given tables as SQL of the other engine names them, and as Spark does.
TYPE_NAMES = """CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'INTEGER' THEN 'int' WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END"""


def _all_tables(spark, sf):
    return {name: mv.table(spark, sf, name) for name in NAMES}


@query("SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders")
def table_scan(spark, sf):
    return mv.table(spark, sf, "orders")


@query(
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM {n}) AS row_count, "
        f"(SELECT CAST(COUNT(*) AS INTEGER) FROM (DESCRIBE {n})) AS column_count"
        for n in NAMES
    )
)
def list_tables(spark, sf):
    return pf.list_tables(_all_tables(spark, sf))


@query(
    f"""SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, column_name, {TYPE_NAMES.replace('data_type', 'column_type')} AS data_type,
       TRUE AS nullable FROM (DESCRIBE lineitem)"""
)
def table_schema(spark, sf):
    return pf.table_schema(mv.table(spark, sf, "lineitem"))


RANGES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def _summary_sql(name: str, more: str = "") -> str:
    column = RANGES.get(name)
    lo, hi = (f"CAST({f}({column}) AS VARCHAR)" if column else "CAST(NULL AS VARCHAR)" for f in ("MIN", "MAX"))
    columns = f"(SELECT string_agg(column_name || ' ' || {TYPE_NAMES.replace('data_type', 'column_type')}, ', ') FROM (DESCRIBE {name}))"
    shown = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{name}' AS table_name, {columns} AS columns, COUNT(*) AS row_count, {shown} AS range_column, "
        f"{lo} AS range_min, {hi} AS range_max{more} FROM {name}"
    )


SUMMARY_SQL = "\nUNION ALL ".join(map(_summary_sql, NAMES))
EXPORT_SQL = "\nUNION ALL ".join(_summary_sql(n, ", least(5, COUNT(*)) AS sample_rows") for n in NAMES)


@query(SUMMARY_SQL)
def table_summary(spark, sf):
    return pf.table_summaries(_all_tables(spark, sf))


@query(
    """SELECT COUNT(*) AS row_count, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM documents)) AS distinct_rows,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM documents)) AS duplicate_rows,
       5 AS column_count, 'doc_id,text,lang,source,n_chars' AS columns FROM documents"""
)
def table_profile(spark, sf):
    return pf.table_profile(mv.table(spark, sf, "documents"))


def _profile_sql(table: str, columns: list[str], fields: str = "*") -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, COUNT(*) AS total_count, COUNT(DISTINCT {c}) AS unique_values,
  COUNT(*) - COUNT({c}) AS null_count, COUNT({c}) AS filled_count, CAST(MIN({c}) AS VARCHAR) AS min_value,
  CAST(MAX({c}) AS VARCHAR) AS max_value,
  CASE WHEN COUNT({c}) = 0 THEN 0 ELSE COUNT(DISTINCT {c}) / CAST(COUNT({c}) AS DOUBLE) END AS uniqueness_ratio,
  COUNT({c}) / CAST(COUNT(*) AS DOUBLE) AS completeness_ratio FROM {table}"""
        for c in columns
    ]
    return f"SELECT {fields} FROM (" + "\nUNION ALL ".join(parts) + ")"


LINEITEM = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(_profile_sql("lineitem", LINEITEM))
def column_profile(spark, sf):
    return pf.column_profile(mv.table(spark, sf, "lineitem"))


# Events without a value where the event is an error, so that a column has many NULLs.
GAPPY_SQL = "(SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN value END AS value) FROM events)"


def _gappy_events(spark, sf):
    return mv.table(spark, sf, "events").withColumn("value", F.expr("CASE WHEN event_type <> 'error' THEN value END"))


@query(
    "WITH p AS ("
    + _profile_sql(GAPPY_SQL, EVENTS)
    + """)
SELECT 'missing_values' AS issue, column_name, null_count * CAST(100 AS DOUBLE) / total_count AS metric FROM p
WHERE null_count * 100.0 / total_count > 10
UNION ALL SELECT 'low_cardinality', column_name, CAST(unique_values AS DOUBLE) FROM p
WHERE unique_values > 1 AND unique_values < 5 AND total_count > 100
UNION ALL SELECT 'potential_id_columns', column_name, uniqueness_ratio FROM p WHERE uniqueness_ratio > 0.9"""
)
def data_quality_issues(spark, sf):
    return pf.data_quality_issues(_gappy_events(spark, sf))


def _describe_sql(table: str, columns: dict[str, bool]) -> str:
    parts = [
        f"""SELECT '{c}' AS column_name, (SELECT COUNT({c}) FROM {table}) AS count,
  (SELECT COUNT(DISTINCT {c}) FROM {table}) AS "unique", t.value AS top, t.n AS freq,
  {f"(SELECT round(AVG({c}), 6) FROM {table})" if number else "CAST(NULL AS DOUBLE)"} AS mean
FROM (SELECT CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM {table} WHERE {c} IS NOT NULL
      GROUP BY 1 ORDER BY n DESC, value DESC LIMIT 1) t"""
        for c, number in columns.items()
    ]
    return "\nUNION ALL ".join(parts)


DESCRIBED = {"event_id": True, "ts": False, "user_id": True, "event_type": False, "value": True, "props": False}


@query(_describe_sql(GAPPY_SQL, DESCRIBED))
def describe_columns(spark, sf):
    return pf.describe_columns(_gappy_events(spark, sf)).withColumn("mean", F.round("mean", 6))


@query(
    f"""SELECT value, COUNT(*) AS count, COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM events) AS percentage
FROM {GAPPY_SQL} WHERE value IS NOT NULL GROUP BY 1 ORDER BY count DESC, value LIMIT 100"""
)
def column_distribution(spark, sf):
    return pf.column_distribution(_gappy_events(spark, sf), "value")


@query(
    """WITH s AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, user_id, event_type, value FROM events, s
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)"""
)
def outliers(spark, sf):
    return pf.outliers(mv.table(spark, sf, "events"), "value").select("event_id", "user_id", "event_type", "value")


@query(
    """WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events)
SELECT event_id, user_id, event_type, value FROM events, s WHERE value < m - 3 * d OR value > m + 3 * d"""
)
def outliers_stddev(spark, sf):
    found = pf.outliers(mv.table(spark, sf, "events"), "value", "stddev")
    return found.select("event_id", "user_id", "event_type", "value")


@query(
    """WITH n AS (SELECT text AS note, COUNT(*) AS frequency,
       regexp_matches(lower(text), 'error|fail|invalid|missing|cannot|wrong') AS is_error
  FROM documents WHERE text IS NOT NULL AND text <> '' GROUP BY 1)
SELECT TRUE AS "exists", note, frequency, is_error, (SELECT COUNT(*) FROM n) AS total_notes,
       (SELECT COUNT(*) FROM n WHERE is_error) AS error_count, (SELECT COUNT(*) FROM n WHERE NOT is_error) AS non_error_count
FROM n ORDER BY frequency DESC, note LIMIT 10"""
)
def note_analysis(spark, sf):
    return pf.note_analysis(mv.table(spark, sf, "documents"), "text")


@query(
    """SELECT 'length' AS section, CAST(length(text) AS VARCHAR) AS item, COUNT(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 2
UNION ALL SELECT 'basic', 'total_rows', COUNT(*) FROM documents
UNION ALL SELECT 'basic', 'non_null_notes', COUNT(text) FROM documents
UNION ALL SELECT 'basic', 'null_notes', COUNT(*) - COUNT(text) FROM documents
UNION ALL SELECT 'basic', 'non_empty_notes', COUNT(*) FILTER (trim(text, ' ') <> '') FROM documents
UNION ALL SELECT 'basic', 'empty_notes', COUNT(*) FILTER (trim(text, ' ') = '') FROM documents
"""
    + "\n".join(
        f"UNION ALL SELECT 'keyword', '{w}', COUNT(*) FILTER (contains(text, '{w}')) FROM documents"
        for w in pf.NOTE_KEYWORDS
    )
)
def note_statistics(spark, sf):
    return pf.note_statistics(mv.table(spark, sf, "documents"), "text")


@query(
    """SELECT doc_id, lang, source, duplicate_count FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY lang, text) AS duplicate_count FROM documents) WHERE duplicate_count > 1"""
)
def duplicate_rows(spark, sf):
    found = pf.duplicate_rows(mv.table(spark, sf, "documents"), ["lang", "text"])
    return found.select("doc_id", "lang", "source", "duplicate_count")


@query(
    """WITH days AS (SELECT DISTINCT CAST(MAX(o_orderdate) AS DATE) AS d FROM orders GROUP BY o_custkey)
SELECT CAST(c.d AS VARCHAR) AS missing_date
FROM (SELECT CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS d FROM days) c
WHERE NOT EXISTS (SELECT 1 FROM days WHERE days.d = c.d)"""
)
def missing_dates(spark, sf):
    last_orders = mv.table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    return pf.missing_dates(last_orders, "last_order")


@query(
    """SELECT doc_id, lang, source, n_chars FROM documents WHERE text LIKE '%MIT License%' ORDER BY doc_id LIMIT 100"""
)
def search_rows(spark, sf):
    found = pf.search_rows(mv.table(spark, sf, "documents"), "text", "%MIT License%", 100, ["doc_id"])
    return found.select("doc_id", "lang", "source", "n_chars")


@query("SELECT event_id, props FROM events WHERE trim(props) <> '' ORDER BY event_id LIMIT 100")
def non_empty_rows(spark, sf):
    return pf.non_empty_rows(mv.table(spark, sf, "events"), "props", 100, ["event_id"], trim=True).select("event_id", "props")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_rows(spark, sf):
    return pf.preview_rows(mv.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), order=["o_orderkey"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 11 OFFSET 10")
def preview_row_slice(spark, sf):
    rows = mv.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return pf.preview_rows(rows, 11, 10, ["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def limit_n(spark, sf):
    return mv.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query(with_bids("SELECT DISTINCT product AS value FROM all_bids"))
def distinct_values(spark, sf):
    return pf.distinct_values(mv.all_bids(spark, sf), "product")


# --- schemas and names ---------------------------------------------------------------------------


@query(
    with_bids(
        """SELECT product AS "PRODUCT", replace(CAST(energy_price AS VARCHAR), '.', ',') AS "ENERGY_PRICE__EUR_MWh_",
       replace(CAST(mw AS VARCHAR), '.', ',') AS "ALLOCATED_CAPACITY__MW_", source_file, COUNT(*) AS copies
FROM all_bids GROUP BY ALL"""
    ),
    name="clean_column_names",
)
def clean_column_names_of_bids(spark, sf):
    renamed = clean_column_names(mv.bid_text(spark, sf))
    return renamed.groupBy("PRODUCT", "ENERGY_PRICE__EUR_MWh_", "ALLOCATED_CAPACITY__MW_", "source_file").agg(
        F.count("*").alias("copies")
    )


@query(
    with_bids(
        """SELECT product AS "PRODUCT", payment_direction AS "ENERGY_PRICE_PAYMENT_DIRECTION", type_of_reserves AS "TYPE_OF_RESERVES",
       source_file, CAST(NULL AS VARCHAR) AS "COUNTRY", CAST(NULL AS VARCHAR) AS "OFFERED_CAPACITY_[MW]", COUNT(*) AS n
FROM all_bids GROUP BY ALL"""
    ),
    name="conform_to_schema",
)
def conform_to_schema_of_bids(spark, sf):
    rows = mv.bid_text(spark, sf, extra=["order_no"]).withColumnRenamed(
        "ENERGY_PRICE_PAYMENT_DIRECTION", "PAYMENT_DIRECTION"
    )
    conformed = conform_to_schema(cl.apply_aliases(rows), BIDS_RAW)
    return conformed.groupBy(
        "PRODUCT", "ENERGY_PRICE_PAYMENT_DIRECTION", "TYPE_OF_RESERVES", "source_file", "COUNTRY", "OFFERED_CAPACITY_[MW]"
    ).agg(F.count("*").alias("n"))


@query("SELECT 'lineitem.parquet' AS source_file, TRUE AS has_load_timestamp, COUNT(*) AS n_rows FROM lineitem")
def tag_lineage_columns(spark, sf):
    tagged = cl.tag_lineage(mv.table(spark, sf, "lineitem"))
    return tagged.groupBy(
        F.substring_index("source_file", "/", -1).alias("source_file"),
        F.col("load_timestamp").isNotNull().alias("has_load_timestamp"),
    ).agg(F.count("*").alias("n_rows"))


@query(
    with_bids(
        """SELECT product, CAST(price AS DOUBLE) AS price, part FROM (
  SELECT product, price, 'a' AS part FROM all_bids WHERE type_of_reserves = 'aFRR'
  UNION ALL SELECT product, price, CAST(NULL AS VARCHAR) FROM all_bids WHERE type_of_reserves = 'mFRR')"""
    )
)
def union_sheets(spark, sf):
    rows = mv.all_bids(spark, sf)
    one = rows.filter("type_of_reserves = 'aFRR'").select("product", F.col("energy_price_eur_mwh").alias("price"), F.lit("a").alias("part"))
    two = rows.filter("type_of_reserves = 'mFRR'").select(F.col("energy_price_eur_mwh").alias("price"), "product")
    return one.unionByName(two, allowMissingColumns=True)


# --- load reports --------------------------------------------------------------------------------


@query(
    with_bids(
        """SELECT source_file, type_of_reserves AS sheet, CAST(MIN(delivery_date) AS VARCHAR) AS min_date,
       CAST(MAX(delivery_date) AS VARCHAR) AS max_date FROM all_bids GROUP BY GROUPING SETS ((source_file, type_of_reserves), ())"""
    )
)
def import_date_range(spark, sf):
    return rc.import_date_range(mv.bid_text(spark, sf).withColumnRenamed("TYPE_OF_RESERVES", "sheet"))


@query(
    with_bids(
        """SELECT source_file, CAST(MIN(delivery_date) AS VARCHAR) AS min_date, CAST(MAX(delivery_date) AS VARCHAR) AS max_date,
       COUNT(*) AS row_count, COUNT(DISTINCT delivery_date) AS days, COUNT(DISTINCT product) AS products
FROM all_bids GROUP BY 1"""
    )
)
def files_by_date_range(spark, sf):
    return rc.files_by_date_range(mv.all_bids(spark, sf))


@query(
    with_bids(
        """SELECT CAST(s.date AS VARCHAR) AS date, s.n AS source_rows, COALESCE(t.n, 0) AS target_rows, s.n = COALESCE(t.n, 0) AS is_equal,
       COALESCE(k.n, 0) AS repeated_keys
FROM (SELECT delivery_date AS date, COUNT(*) AS n FROM all_bids GROUP BY 1) s
LEFT JOIN (SELECT delivery_date AS date, COUNT(*) AS n FROM bids GROUP BY 1) t ON t.date = s.date
LEFT JOIN (SELECT date, COUNT(*) AS n FROM (SELECT delivery_date AS date, product FROM bids GROUP BY ALL HAVING COUNT(*) > 1)
           GROUP BY 1) k ON k.date = s.date"""
    )
)
def load_reconciliation(spark, sf):
    return rc.load_reconciliation(mv.all_bids(spark, sf), mv.bids(spark, sf), "delivery_date", ["product"])


VERSIONS_SQL = """loads AS (
  SELECT date, quarter_no, v, TIMESTAMP '2024-02-01 06:00:00' AS load_timestamp FROM act
  UNION ALL SELECT date, quarter_no, v + 1, TIMESTAMP '2024-02-02 06:00:00' FROM act WHERE date >= DATE '2024-01-15')"""


def _loads(spark, sf):
    rows = mv.activations(spark, sf).select("date", "quarter_no", "activated_volume_mw")
    later = rows.filter("date >= DATE '2024-01-15'").withColumn("activated_volume_mw", F.expr("activated_volume_mw + 1"))
    return rows.withColumn("load_timestamp", F.expr("TIMESTAMP_NTZ '2024-02-01 06:00:00'")).unionByName(
        later.withColumn("load_timestamp", F.expr("TIMESTAMP_NTZ '2024-02-02 06:00:00'"))
    )


@query(
    with_act(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw,
       CAST(load_timestamp AS VARCHAR) AS load_timestamp, CAST(load_timestamp AS VARCHAR) AS ingested_at,
       CAST(load_timestamp AS VARCHAR) AS effective_from,
       CAST(lead(load_timestamp) OVER (PARTITION BY date, quarter_no ORDER BY load_timestamp) AS VARCHAR) AS effective_to
FROM loads""",
        VERSIONS_SQL,
    )
)
def audit_columns(spark, sf):
    return rc.audit_columns(_loads(spark, sf), ["date", "quarter_no"])


@query(
    with_act(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(arg_max(v, load_timestamp) AS DOUBLE) AS activated_volume_mw,
       CAST(MAX(load_timestamp) AS VARCHAR) AS load_timestamp FROM loads GROUP BY date, quarter_no""",
        VERSIONS_SQL,
    )
)
def latest_per_interval(spark, sf):
    return rc.latest_per_interval(_loads(spark, sf), ["date", "quarter_no"], ["load_timestamp"])


@query(
    with_act(
        """SELECT CAST(row_number() OVER (ORDER BY load_timestamp) AS BIGINT) AS version_id,
       CAST(load_timestamp AS VARCHAR) AS load_timestamp, COUNT(*) AS row_count FROM loads GROUP BY load_timestamp""",
        VERSIONS_SQL,
    )
)
def upload_order(spark, sf):
    return rc.upload_order(_loads(spark, sf), ["load_timestamp"])


@query(
    with_bids(
        """SELECT source_file, format('{:,}', COUNT(*)).replace(',', '.') AS rows_text,
       CAST(SUM(mw) AS DOUBLE) AS mw, lower(substring(source_file, 1, 4)) AS stem, length(source_file) AS n_chars,
       abs(CAST(MIN(price) AS DOUBLE)) AS low, COUNT(*) FILTER (product LIKE 'NEG%') AS neg,
       CAST(last_day(MIN(delivery_date)) AS VARCHAR) AS month_end,
       strftime(MAX(delivery_date), '%d.%m.%Y') AS last_text FROM all_bids GROUP BY source_file"""
    )
)
def scalar_functions(spark, sf):
    return (
        mv.all_bids(spark, sf)
        .groupBy("source_file")
        .agg(
            ps.to_german_text(F.count("*"), 0).alias("rows_text"),
            F.sum("allocated_capacity_mw").alias("mw"),
            F.abs(F.min("energy_price_eur_mwh")).alias("low"),
            F.count_if(F.col("product").like("NEG%")).alias("neg"),
            F.last_day(F.min("delivery_date")).alias("month_end"),
            F.date_format(F.max("delivery_date"), "dd.MM.yyyy").alias("last_text"),
        )
        .select(
            "*", F.lower(F.substring("source_file", 1, 4)).alias("stem"), F.length("source_file").cast("long").alias("n_chars")
        )
    )


