"""Round trips through files, versioned tables and streams, in a new scratch folder for each run."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.functions import parsing as ps
from gridclear.functions import timecode as tc
from gridclear.operators import cleaning as cl
from gridclear.operators import coverage as cv
from gridclear.operators import profiling as pf
from gridclear.operators import reconcile as rc
from gridclear.plans import market_views as mv
from gridclear.plans import market_queries as mq
from gridclear.plans import workflows as wf
from gridclear.plans.fixture_workbooks import land_broken_file, land_sheets
from gridclear.plans.oracle_views import END, START, with_act, with_bids, with_prices
from gridclear.plans.registry import query
from gridclear.plans.table_queries import EXPORT_SQL, _all_tables
from gridclear.schema import ACTIVATION_COLUMNS, BIDS, MARGINAL_PRICES, POWER, REQUIRED_BID_COLUMNS, conform_to_schema
from gridclear.session import scratch_dir
from gridclear.sources import delimited as dl
from gridclear.sources import landing as ln
from gridclear.sources import workbooks as wb
from gridclear.sources.period_table import PeriodTable
from gridclear.streaming import ledger as lg
from gridclear.streaming import loads as st

RAW_NAMES = ["Datum", "Zeitzone", "von", "bis", "50Hertz (Negativ)", "Amprion (Negativ)"]
LOADED_ACTIVATIONS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("quarter_no", T.IntegerType()),
        T.StructField("activated_volume_mw", POWER),
        T.StructField("time_zone", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("load_timestamp", T.TimestampType()),
    ]
)
SHOWN = ["date", "quarter_no", "activated_volume_mw"]


def _land_activations(df, path, by_day=False):
    """Activation text as ``;``-separated files with a header, one per day if asked."""
    named = df.toDF(*RAW_NAMES)
    if by_day:
        named = named.withColumn("day", F.to_date("Datum", "dd.MM.yyyy")).repartition("day")
    writer = named.write.mode("append").option("header", True).option("sep", ";")
    (writer.partitionBy("day") if by_day else writer).csv(path)


def _activation_table(spark, root, partition_by=("date",)):
    return PeriodTable(spark, root, LOADED_ACTIVATIONS, list(partition_by))


# --- scans ---------------------------------------------------------------------------------------

ACT_SQL = with_act(
    f"""SELECT CAST(date AS VARCHAR) AS date, quarter_no, {START} AS quarter_hour_start, {END} AS quarter_hour_end,
       CAST(v AS DOUBLE) AS activated_volume_mw, 'CET' AS time_zone FROM act"""
)


@query(ACT_SQL)
def scan_activation_csv(spark, sf):
    path = scratch_dir(spark, "activations")
    _land_activations(mv.activation_text(spark, sf), path)
    loaded = cl.to_activations(dl.scan_activation_csv(spark, path))
    return loaded.select(
        "date", "quarter_no", "quarter_hour_start", "quarter_hour_end", "activated_volume_mw", "time_zone"
    )


BID_TEXT = ["DELIVERY_DATE", "PRODUCT", "ENERGY_PRICE_[EUR/MWh]", "ENERGY_PRICE_PAYMENT_DIRECTION", "ALLOCATED_CAPACITY_[MW]"]
BID_TEXT_SQL = with_bids(
    """SELECT CASE day_no % 3 WHEN 0 THEN strftime(delivery_date, '%Y-%m-%d')
         WHEN 1 THEN strftime(delivery_date, '%Y-%m-%d 00:00:00') ELSE strftime(delivery_date, '%m/%d/%Y') END AS "DELIVERY_DATE",
       product AS "PRODUCT", replace(CAST(energy_price AS VARCHAR), '.', ',') AS "ENERGY_PRICE_[EUR/MWh]",
       payment_direction AS "ENERGY_PRICE_PAYMENT_DIRECTION",
       replace(CAST(mw AS VARCHAR), '.', ',') AS "ALLOCATED_CAPACITY_[MW]" FROM all_bids"""
)


def land_bid_sheets(spark, sf, label="sheets", compression="none"):
    """The bids as unpacked workbooks in a new folder."""
    path = scratch_dir(spark, label)
    land_sheets(mv.bid_text(spark, sf).select(*[f"`{c}`" for c in BID_TEXT], "NOTE"), path, compression=compression)
    return path


def landed_bids(spark, path):
    return wb.to_raw_bids(wb.scan_sheets(spark, path)).select(*[f"`{c}`" for c in BID_TEXT])


@query(BID_TEXT_SQL)
def scan_bid_workbooks(spark, sf):
    return landed_bids(spark, land_bid_sheets(spark, sf))


@query(BID_TEXT_SQL)
def scan_zipped_workbooks(spark, sf):
    return landed_bids(spark, land_bid_sheets(spark, sf, "zipped", "gzip"))


@query(BID_TEXT_SQL)
def scan_bid_csv(spark, sf):
    """Files of two column orders."""
    path = scratch_dir(spark, "bids")
    rows = mv.bid_text(spark, sf)
    for part, order in (("a", BID_TEXT), ("b", BID_TEXT[::-1])):
        half = rows.filter((F.col("TYPE_OF_RESERVES") == "aFRR") == (part == "a"))
        half.select(*[f"`{c}`" for c in order]).write.option("header", True).csv(f"{path}/{part}")
    return dl.scan_bid_csv(spark, f"{path}/*", BID_TEXT).filter(F.col(dl.CORRUPT).isNull()).select(*[f"`{c}`" for c in BID_TEXT])


@query(
    with_bids("""SELECT CAST(delivery_date AS VARCHAR) AS "DELIVERY_DATE", product AS "PRODUCT", payment_direction, COUNT(*) AS bids
FROM all_bids GROUP BY ALL""")
)
def convert_workbooks_to_csv(spark, sf):
    path = scratch_dir(spark, "converted")
    wb.convert_workbooks(wb.scan_sheets(spark, land_bid_sheets(spark, sf)), path, BID_TEXT)
    rows = spark.read.schema(dl.text_schema([*BID_TEXT, *wb.SHEET])).option("header", True).csv(path)
    dated = cl.standardize_date_column(rows, "DELIVERY_DATE").withColumn("DELIVERY_DATE", F.to_date("DELIVERY_DATE"))
    named = dated.withColumnRenamed("ENERGY_PRICE_PAYMENT_DIRECTION", "payment_direction")
    return named.groupBy("DELIVERY_DATE", "PRODUCT", "payment_direction").agg(F.count("*").alias("bids"))


@query(with_act("SELECT 'day=' || CAST(date AS VARCHAR) AS folder, CAST(1 AS BIGINT) AS files FROM (SELECT DISTINCT date FROM act)"))
def discover_landing_files(spark, sf):
    path = scratch_dir(spark, "landing")
    _land_activations(mv.activation_text(spark, sf), path, by_day=True)
    listing = ln.discover_landing_files(spark, path, "*.[cC][sS][vV]", recursive=True)
    folder = F.element_at(F.split("path", "/"), -2)
    return listing.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"))


@query(
    """SELECT 'ENERGY' AS market, 'aFRR' AS product_type, CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS period_start,
       CAST(last_day(o_orderdate) AS VARCHAR) AS period_end, COUNT(*) AS files FROM orders GROUP BY ALL"""
)
def file_name_lineage(spark, sf):
    month = F.trunc("o_orderdate", "month")
    path = F.concat(
        F.lit("/landing/RESULT_LIST_ANONYM_ENERGY_MARKET_aFRR_DE_"),
        month.cast("string"),
        F.lit("_"),
        F.last_day("o_orderdate").cast("string"),
        F.lit(".xlsx.zip"),
    )
    named = mv.table(spark, sf, "orders").select(ln.file_name_lineage(path).alias("n")).select("n.*")
    return named.groupBy(*named.columns).agg(F.count("*").alias("files"))


@query(
    with_bids(
        """SELECT sep, encoding, is_valid, missing, SUM(n)::BIGINT AS row_count FROM (
  SELECT ';' AS sep, 'utf-8' AS encoding, TRUE AS is_valid, '' AS missing, (SELECT COUNT(*) FROM act) AS n
  UNION ALL SELECT ',', 'utf-8', FALSE, 'Datum,von,bis,50Hertz (Negativ)', (SELECT COUNT(*) FROM all_bids)) GROUP BY ALL""",
        mq.ACT,
    )
)
def validate_delimited_files(spark, sf):
    path = scratch_dir(spark, "delimited")
    _land_activations(mv.activation_text(spark, sf), f"{path}/activations")
    mv.bid_text(spark, sf).select(*[f"`{c}`" for c in BID_TEXT]).write.option("header", True).csv(f"{path}/bids")
    files = dl.validate_delimited_files(spark, path, ACTIVATION_COLUMNS, recursive=True)
    return (
        files.withColumn("missing", F.array_join("missing_columns", ","))
        .groupBy("sep", "encoding", "is_valid", "missing")
        .agg(F.sum("row_count").alias("row_count"))
    )


# --- checks of landed sheets ---------------------------------------------------------------------


def _two_kinds(spark, sf):
    """Sheets of both reserve types, of which those of the second lack two required columns, and a file that is no sheet."""
    text, path = mv.bid_text(spark, sf), scratch_dir(spark, "two-kinds")
    good = text.filter("TYPE_OF_RESERVES = 'aFRR'").select(*[f"`{c}`" for c in BID_TEXT], "NOTE")
    short = text.filter("TYPE_OF_RESERVES = 'mFRR'").select("DELIVERY_DATE", "PRODUCT", "`ENERGY_PRICE_[EUR/MWh]`")
    land_sheets(good, path)
    land_sheets(short, path, "short")
    land_broken_file(spark, path)
    return wb.scan_sheets(spark, path), path


@query(
    with_bids(
        """SELECT type_of_reserves = 'aFRR' AS is_valid, CASE type_of_reserves WHEN 'aFRR' THEN '' ELSE
       'ENERGY_PRICE_PAYMENT_DIRECTION,ALLOCATED_CAPACITY_[MW]' END AS missing,
       CASE type_of_reserves WHEN 'aFRR' THEN 5 ELSE 3 END AS columns_with_data, COUNT(*) AS n_rows FROM all_bids GROUP BY ALL"""
    )
)
def validate_bid_columns(spark, sf):
    sheets = wb.sheet_manifest(_two_kinds(spark, sf)[0]).drop("missing_columns", "is_valid")
    checked = cl.validate_bid_columns(sheets, REQUIRED_BID_COLUMNS)
    filled = F.size(F.array_except("header", F.array(F.lit("NOTE"))))
    return (
        checked.withColumn("missing", F.array_join("missing_columns", ","))
        .groupBy("is_valid", "missing", filled.alias("columns_with_data"))
        .agg(F.sum("row_count").alias("n_rows"))
    )


@query(
    with_bids(
        """SELECT 'sheets' AS what, type_of_reserves = 'aFRR' AS is_loaded, COUNT(*) AS n_rows, COUNT(DISTINCT product) AS products
FROM all_bids GROUP BY 2 UNION ALL SELECT 'unreadable', FALSE, 0, 1"""
    )
)
def route_invalid_sheets(spark, sf):
    rows, path = _two_kinds(spark, sf)
    loaded, quarantined = cl.route_invalid_sheets(rows)

    def counts(part, flag):
        named = wb.to_columns(part, ["PRODUCT"])
        per_product = named.groupBy("PRODUCT").agg(F.count("*").alias("n"))
        return per_product.agg(
            F.lit(flag).alias("is_loaded"), F.sum("n").alias("n_rows"), F.count("PRODUCT").alias("products")
        )

    broken = wb.unreadable_files(spark, path, rows).agg(
        F.lit(False).alias("is_loaded"), F.lit(0).cast("long").alias("n_rows"), F.count("*").alias("products")
    )
    routed = counts(loaded, True).unionByName(counts(quarantined, False))
    return routed.withColumn("what", F.lit("sheets")).unionByName(broken.withColumn("what", F.lit("unreadable")))


@query(
    with_bids(
        """SELECT CAST(9 AS BIGINT) AS files_processed, COUNT(*) FILTER (type_of_reserves = 'aFRR') AS rows_loaded, CAST(9 AS BIGINT) AS error_count,
       format('{:,}', COUNT(*) FILTER (type_of_reserves = 'aFRR')).replace(',', '.') AS rows_loaded_text FROM all_bids"""
    )
)
def load_summary(spark, sf):
    rows, path = _two_kinds(spark, sf)
    found = rc.load_summary(wb.sheet_manifest(rows), wb.unreadable_files(spark, path, rows))
    return found.select("files_processed", "rows_loaded", "error_count", "rows_loaded_text")


# --- sinks ---------------------------------------------------------------------------------------


def _stamped(spark, sf):
    return mv.activations(spark, sf).withColumns(
        {"source_file": F.lit("first"), "load_timestamp": F.expr("TIMESTAMP '2024-03-01 00:00:00 UTC'")}
    )


@query(
    with_act(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, month(date)::INT AS month, CAST(v * 2 AS DOUBLE) AS activated_volume_mw FROM act
UNION ALL SELECT CAST(CAST(date + INTERVAL 1 MONTH AS DATE) AS VARCHAR), quarter_no, month(CAST(date + INTERVAL 1 MONTH AS DATE))::INT,
       CAST(v AS DOUBLE) FROM act WHERE date + INTERVAL 1 MONTH < DATE '2024-03-01'"""
    )
)
def replace_month(spark, sf):
    table = _activation_table(spark, scratch_dir(spark, "month"), ("year", "month"))
    january = _stamped(spark, sf)
    february = cl.add_month_year(january.withColumn("date", F.add_months("date", 1)))
    table.replace_partitions(january.unionByName(february))
    table.replace_partitions(january.withColumn("activated_volume_mw", F.expr("cast(activated_volume_mw * 2 as decimal(18,3))")))
    return table.read().select("date", "quarter_no", "month", "activated_volume_mw")


RANGE_SQL = """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, product,
       CAST(CASE WHEN delivery_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' THEN price + 1000 ELSE price END AS DOUBLE)
         AS energy_price_eur_mwh, CAST(mw AS DOUBLE) AS allocated_capacity_mw, source_file
FROM bids WHERE delivery_date <> DATE '2024-01-12'"""
BID_SHOWN = ["delivery_date", "product", "energy_price_eur_mwh", "allocated_capacity_mw", "source_file"]


def _bid_table(spark, label):
    return PeriodTable(spark, scratch_dir(spark, label), BIDS, ["delivery_date"])


@query(with_bids(RANGE_SQL))
def replace_date_range(spark, sf):
    table = _bid_table(spark, "range")
    bids = mv.bids(spark, sf)
    table.replace_range(bids)
    inside = bids.filter(
        F.col("delivery_date").between("2024-01-10", "2024-01-15") & (F.col("delivery_date") != "2024-01-12")
    )
    table.replace_range(inside.withColumn("energy_price_eur_mwh", F.expr("energy_price_eur_mwh + 1000")))
    return table.read().select(*BID_SHOWN)


@query(
    with_prices(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_hour_start, product_code, CAST(CASE WHEN date <= DATE '2024-01-15'
       THEN marginal_price + 1 ELSE marginal_price END AS DOUBLE) AS marginal_price FROM prices"""
    )
)
def replace_result_range(spark, sf):
    table = PeriodTable(spark, scratch_dir(spark, "prices"), MARGINAL_PRICES, ["date"])
    table.replace_range(mv.prices(spark, sf), "ANALYSIS")
    early = table.read().filter("date <= DATE '2024-01-15'")
    table.replace_range(early.withColumn("marginal_price", F.expr("marginal_price + 1")), "ANALYSIS")
    return table.read().select("date", "quarter_hour_start", "product_code", "marginal_price")


@query(
    with_act(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(CASE WHEN date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
       THEN v + 5 ELSE v END AS DOUBLE) AS activated_volume_mw FROM act"""
    )
)
def upsert_interval(spark, sf):
    table = _activation_table(spark, scratch_dir(spark, "upsert"), ("year", "month"))
    rows = _stamped(spark, sf).drop("interval_start", "quarter_hour_start", "quarter_hour_end")
    rows = rows.select(*[f.name for f in LOADED_ACTIVATIONS.fields])
    table.replace_partitions(rows)
    fix = rows.filter(F.col("date").between("2024-01-10", "2024-01-20")).withColumns(
        {
            "activated_volume_mw": F.expr("cast(activated_volume_mw + 5 as decimal(18,3))"),
            "load_timestamp": F.expr("load_timestamp + INTERVAL 1 DAY"),
        }
    )
    stale = rows.withColumns(
        {
            "activated_volume_mw": F.expr("cast(activated_volume_mw - 1 as decimal(18,3))"),
            "load_timestamp": F.expr("load_timestamp - INTERVAL 1 DAY"),
        }
    )
    st.merge_latest(table, fix.unionByName(stale))
    return table.read().select(*SHOWN)


BLOCKS = T.StructType([*[BIDS[c] for c in BID_SHOWN], T.StructField("block_index", T.IntegerType())])


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, product, CAST(CASE
         WHEN delivery_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' AND (slot - 1) // 16 = 2 THEN price - 7 ELSE price END
         AS DOUBLE) AS energy_price_eur_mwh, CAST(mw AS DOUBLE) AS allocated_capacity_mw, source_file FROM bids"""
    )
)
def replace_4h_block(spark, sf):
    table = PeriodTable(spark, scratch_dir(spark, "blocks"), BLOCKS, ["delivery_date", "block_index"])
    bids = mv.bids(spark, sf).withColumn("block_index", tc.block_index(F.col("slot")))
    table.replace_partitions(bids)
    inside = bids.filter(F.col("delivery_date").between("2024-01-05", "2024-01-10") & (F.col("block_index") == 2))
    table.replace_partitions(inside.withColumn("energy_price_eur_mwh", F.expr("energy_price_eur_mwh - 7")))
    return table.read().select(*BID_SHOWN)


@query(with_bids(mq.CLEAN_SELECT))
def create_or_replace_table(spark, sf):
    root = scratch_dir(spark, "clean")
    table = PeriodTable(spark, root, BIDS, ["delivery_date"], sort_by=["product", "energy_price_eur_mwh"])
    for rows in (mv.all_bids(spark, sf), cl.clean_bids(mv.bid_text(spark, sf))):
        table.overwrite(rows)
    return table.read().select(*mq.CLEAN_COLUMNS)


@query(
    with_prices(
        """SELECT CAST(date AS VARCHAR) AS date, quarter_hour_start, product_code, CAST(CAST(marginal_price AS DECIMAL(18,3)) AS VARCHAR)
       AS marginal_price FROM prices WHERE date = DATE '2024-01-15'"""
    )
)
def export_csv(spark, sf):
    path = scratch_dir(spark, "export")
    dl.export_csv(cv.view_marginal_prices(mv.prices(spark, sf), "2024-01-15"), path, single_file=True)
    rows = spark.read.option("header", True).csv(path)
    return rows.select("date", "quarter_hour_start", "product_code", "marginal_price")


@query(EXPORT_SQL)
def database_summary_export(spark, sf):
    path = scratch_dir(spark, "summary")
    tables = _all_tables(spark, sf)
    pf.export_database_summary(tables, path)
    summaries = spark.read.schema(pf.table_summaries(tables).schema).json(f"{path}/tables")
    samples = spark.read.schema("table_name string, row string").json(f"{path}/samples")
    return summaries.join(samples.groupBy("table_name").agg(F.count("row").alias("sample_rows")), "table_name", "left")


@query(
    with_act(
        """SELECT CAST(row_number() OVER (ORDER BY half) AS BIGINT) AS version_id, 'afrr_update_' || half AS operation_type,
       'half_' || half || '.csv' AS source_files, n AS current_rows FROM (
  SELECT CASE WHEN date < DATE '2024-01-16' THEN 1 ELSE 2 END AS half, COUNT(*) AS n FROM act GROUP BY 1)"""
    )
)
def append_lineage(spark, sf):
    table = _activation_table(spark, scratch_dir(spark, "lineage"))
    rows = _stamped(spark, sf)
    for half, condition in ((1, "date < DATE '2024-01-16'"), (2, "date >= DATE '2024-01-16'")):
        name = f"half_{half}.csv"
        table.replace_range(rows.filter(condition).withColumn("source_file", F.lit(name)), f"afrr_update_{half}", [name])
    served = table.read().groupBy(F.col("source_file").alias("source_files")).agg(F.count("*").alias("current_rows"))
    return table.history().join(served, "source_files").select("version_id", "operation_type", "source_files", "current_rows")


@query(with_act("SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(v AS DOUBLE) AS activated_volume_mw FROM act"))
def snapshot_table(spark, sf):
    table = _activation_table(spark, scratch_dir(spark, "snapshot"))
    rows = _stamped(spark, sf)
    table.replace_range(rows)
    table.snapshot()
    before = table.snapshot()
    table.replace_range(rows.withColumn("activated_volume_mw", F.lit(0).cast(POWER)))
    table.restore(before)
    table.drop_old_snapshots(keep=1)
    return table.read().select(*SHOWN)


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, product, CAST(price AS DOUBLE) AS energy_price_eur_mwh,
       CAST(mw AS DOUBLE) AS allocated_capacity_mw, source_file FROM bids"""
    )
)
def ensure_table(spark, sf):
    table = _bid_table(spark, "ensure")
    was_empty = table.read().isEmpty()
    table.replace_partitions(mv.bids(spark, sf))
    table.create_if_absent()
    return table.read().filter(F.lit(was_empty)).select(*BID_SHOWN)


@query(
    with_bids(
        """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, product, CASE type_of_reserves WHEN 'aFRR' THEN payment_direction END
       AS payment_direction, CAST(mw AS DOUBLE) AS allocated_capacity_mw FROM bids"""
    )
)
def bulk_insert(spark, sf):
    table = _bid_table(spark, "bulk")
    bids = mv.bids(spark, sf)
    full = bids.filter("type_of_reserves = 'aFRR'")
    without = bids.filter("type_of_reserves = 'mFRR'").drop("payment_direction").withColumn("extra", F.lit(1))
    table.replace_partitions(conform_to_schema(full, BIDS).unionByName(conform_to_schema(without, BIDS)))
    return table.read().select("delivery_date", "product", "payment_direction", "allocated_capacity_mw")


# --- streams -------------------------------------------------------------------------------------

STREAM_SQL = with_act(
    """SELECT CAST(date AS VARCHAR) AS date, quarter_no, CAST(CASE WHEN date >= DATE '2024-01-16' THEN v + 3 ELSE v END AS DOUBLE)
       AS activated_volume_mw FROM act"""
)


def _drops(spark, sf):
    """Two deliveries of activation files: all days, then corrected values of the later days."""
    rows = mv.activation_text(spark, sf)
    later = mv.activations(spark, sf).filter("date >= DATE '2024-01-16'")
    corrected = later.withColumn("activated_volume_mw", F.expr("cast(activated_volume_mw + 3 as decimal(18,3))"))
    return rows, mv.as_activation_text(corrected)


@query(STREAM_SQL)
def incremental_landing_load(spark, sf):
    root = scratch_dir(spark, "stream")
    table = _activation_table(spark, f"{root}/table")
    for delivery in _drops(spark, sf):
        _land_activations(delivery, f"{root}/landing")
        st.load_activation_files(spark, f"{root}/landing", table, f"{root}/checkpoint", archive=f"{root}/archive")
    return table.read().select(*SHOWN)


@query(
    with_act(
        """SELECT 'stored' AS what, CAST(date AS VARCHAR) AS date, quarter_no,
  CAST(CASE WHEN date >= DATE '2024-01-16' AND NOT (date = DATE '2024-01-20' AND quarter_no % 2 = 0) THEN v + 3 ELSE v END AS DOUBLE) AS activated_volume_mw,
  CAST(NULL AS VARCHAR) AS reason FROM act
UNION ALL SELECT 'refused', NULL, NULL, NULL, 'unreadable volume' FROM act WHERE date = DATE '2024-01-20' AND quarter_no % 2 = 0
UNION ALL SELECT 'refused', NULL, NULL, NULL, 'columns absent: von, 50Hertz (Negativ)'"""
    )
)
def isolated_landing_load(spark, sf):
    """All days, then corrected later days, among them a day with unreadable volumes, and a file without the columns."""
    root = scratch_dir(spark, "isolated")
    table, landing = _activation_table(spark, f"{root}/table"), f"{root}/landing"

    def load():
        st.load_activation_files(spark, landing, table, f"{root}/checkpoint", archive=f"{root}/archive", rejected=f"{root}/rejected")

    first, corrected = _drops(spark, sf)
    _land_activations(first, f"{landing}/one")
    load()
    quarter = tc.quarter_of_time(F.col("von"))
    spoilt = (F.col("Datum ") == "20.01.2024") & (quarter % 2 == 0)
    _land_activations(corrected.withColumn("50Hertz (Negativ)", F.when(spoilt, "?").otherwise(F.col("50Hertz (Negativ)"))), f"{landing}/two")
    spark.createDataFrame([("01.01.2024", "00:15")], "Datum string, bis string").coalesce(1).write.option("header", True).option("sep", ";").csv(f"{landing}/three")
    load()
    load()
    stored = table.read().select(F.lit("stored").alias("what"), *SHOWN, F.lit(None).cast("string").alias("reason"))
    letters = lg.dead_letters(spark, table).select(F.lit("refused").alias("what"), "reason")
    return stored.unionByName(letters, allowMissingColumns=True)


REFUSED_SQL = with_bids(
    """SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, product, CAST(CASE WHEN delivery_date = DATE '2024-01-12' THEN price
       WHEN payment_direction = 'PROVIDER_TO_GRID' THEN price - 1000 ELSE price + 1000 END AS DOUBLE) AS energy_price_eur_mwh,
       CAST(mw AS DOUBLE) AS allocated_capacity_mw, 0::BIGINT AS refused FROM bids WHERE delivery_date <> DATE '2024-01-20'
UNION ALL SELECT NULL, NULL, NULL, NULL, COUNT(*) FROM all_bids WHERE delivery_date = DATE '2024-01-12'"""
)


def _second_delivery(spark, sf):
    """Prices raised by 1000; those of one day cannot be read, and another day is missing."""
    text = mv.bid_text(spark, sf)
    price, day = F.col("`ENERGY_PRICE_[EUR/MWh]`"), ps.parse_date(F.col("DELIVERY_DATE"))
    raised = ps.to_decimal_comma((ps.decimal_comma(price) + 1000).cast(POWER))
    told = text.filter(day != F.lit("2024-01-20").cast("date"))
    return told.withColumn("ENERGY_PRICE_[EUR/MWh]", F.when(day == F.lit("2024-01-12").cast("date"), "abc").otherwise(raised))


def _land_sheet_rows(text, path, prefix="book"):
    """Compressed, as two whole deliveries are kept at a time."""
    land_sheets(text.select(*[f"`{c}`" for c in BID_TEXT], "NOTE"), path, prefix, compression="gzip")


def _kept(table, refused):
    rows = table.read().select(*[c for c in BID_SHOWN if c != "source_file"], F.lit(0).cast("long").alias("refused"))
    return rows.unionByName(refused.agg(F.count("*").alias("refused")), allowMissingColumns=True)


@query(REFUSED_SQL)
def refused_bids_keep_their_day(spark, sf):
    root = scratch_dir(spark, "refused")
    table = _bid_table(spark, "refused-table")
    _land_sheet_rows(mv.bid_text(spark, sf), f"{root}/one")
    _land_sheet_rows(_second_delivery(spark, sf), f"{root}/two")
    for part in ("one", "two"):
        wf.load_bids(spark, f"{root}/{part}", table)
    return _kept(table, spark.read.parquet(f"{table.root}/quarantine"))


@query(REFUSED_SQL)
def refused_bids_keep_their_day_in_streams(spark, sf):
    root = scratch_dir(spark, "refused-stream")
    table = _bid_table(spark, "refused-stream-table")
    for prefix, rows in (("first", mv.bid_text(spark, sf)), ("second", _second_delivery(spark, sf))):
        _land_sheet_rows(rows, f"{root}/landing", prefix)
        st.bid_workbook_load(spark, f"{root}/landing", table, f"{root}/checkpoint")
    return _kept(table, lg.dead_letters(spark, table))


@query(STREAM_SQL)
def latest_activation_stream(spark, sf):
    root = scratch_dir(spark, "latest")
    table = _activation_table(spark, f"{root}/table")
    for delivery in _drops(spark, sf):
        _land_activations(delivery, f"{root}/landing")
        stream = st.activation_stream(spark, f"{root}/landing", RAW_NAMES)
        st.latest_activation_stream(stream, table, f"{root}/checkpoint")
    return table.read().select(*SHOWN)
