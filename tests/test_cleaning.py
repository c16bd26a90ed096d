"""Activation and bid cleaning on the documented inputs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridclear.functions import parsing as ps
from gridclear.functions import timecode as tc
from gridclear.operators import cleaning as cl
from gridclear.operators import reconcile as rc
from gridclear.schema import BIDS_RAW, apply_aliases, clean_column_names, conform_to_schema, quoted

RAW_ACTIVATIONS = ["Datum ", "Zeitzone", "von", "bis", "50Hertz (Negativ)", "Amprion (Negativ)", "TenneT TSO (Negativ)"]


def activations(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"`{n}` string" for n in RAW_ACTIVATIONS))


TWO = [
    ("01.09.2024", "CEST", "00:00", "00:15", "4,364", "0,000", "0,148"),
    ("01.09.2024", "CEST", "00:15", "00:30", "10,052", "0,000", "0,148"),
]


def test_select_columns(spark):
    selected = cl.select_activation_columns(activations(spark, *TWO))
    assert selected.columns == ["Datum", "von", "bis", "50Hertz (Negativ)"]
    assert selected.count() == 2
    other = cl.select_activation_columns(activations(spark, *TWO), "TenneT TSO (Negativ)")
    assert other.first()["TenneT TSO (Negativ)"] == "0,148"
    with pytest.raises(ValueError, match="Datum"):
        cl.select_activation_columns(selected.drop("Datum"))


def test_clean_values(spark):
    rows = cl.clean_activations(cl.select_activation_columns(activations(spark, *TWO))).collect()
    assert [float(r["50Hertz (Negativ)"]) for r in rows] == [4.364, 10.052]
    assert (rows[0].Datum, rows[0].von, rows[0].bis) == (dt.date(2024, 9, 1), "00:00:00", "00:15:00")


def test_clean_edge_rows(spark):
    odd = activations(spark, ("01.09.2024", "CEST", " 00:15:00 ", "00:30", "n/a", "0", "0"))
    row = cl.clean_activations(cl.select_activation_columns(odd)).first()
    assert (row.von, row["50Hertz (Negativ)"]) == ("00:15:00", None)
    bad = activations(spark, ("2024-09-01", "CEST", "00:00", "00:15", "1", "0", "0"))
    with pytest.raises(PySparkException):
        cl.clean_activations(cl.select_activation_columns(bad)).collect()


def verdict(df):
    return tuple(cl.validate_activations(df).first())


def test_validate_activations(spark):
    good = cl.clean_activations(cl.select_activation_columns(activations(spark, *TWO)))
    assert verdict(good) == (True, "ok")
    assert verdict(good.limit(0)) == (False, "no_rows")
    assert verdict(good.withColumn("von", F.lit("9:00"))) == (False, "start_time: 2")
    assert verdict(good.withColumn("bis", F.lit(None).cast("string")))[0] is False
    assert verdict(good.withColumn("Datum", F.lit("x"))) == (False, "date_not_typed: 2")
    assert "numeric" in verdict(good.withColumn("50Hertz (Negativ)", F.lit(None).cast("double")))[1]
    assert "columns_absent: bis" == verdict(good.drop("bis"))[1]


def test_to_activations_keeps_both_hours_of_the_long_day(spark):
    rows = [
        ("27.10.2024", zone, "02:00", "02:15", mw, "0", "0") for zone, mw in (("CEST", "1,5"), ("CET", "2,5"))
    ]
    typed = cl.to_activations(activations(spark, *rows))
    assert sorted((r.time_zone, r.quarter_no, float(r.activated_volume_mw)) for r in typed.collect()) == [
        ("CEST", 9, 1.5),
        ("CET", 9, 2.5),
    ]
    assert cl.duplicate_intervals(typed).first().asDict() == {
        "date": dt.date(2024, 10, 27),
        "quarter_no": 9,
        "row_count": 2,
        "time_zones": 2,
    }


def test_outside_month(spark):
    typed = cl.to_activations(activations(spark, *TWO))
    assert cl.outside_month(typed, 9, 2024).count() == 0
    assert cl.outside_month(typed, 10, 2024).count() == 2


RAW = "DELIVERY_DATE string, PRODUCT string, ENERGY_PRICE_EUR_MWh string, PAYMENT_DIRECTION string, ALLOCATED_CAPACITY_MW string, source_file string"


def test_clean_bids_golden(spark):
    raw = spark.createDataFrame(
        [
            ("2024-09-01", "FRR", "100.0", "PROVIDER_TO_GRID", "5", "f"),
            ("2024-09-01", "FRR", "50.0", "GRID_TO_PROVIDER", "3", "f"),
            ("2024-09-01", "POS_X", "200.0", "PROVIDER_TO_GRID", "2", "f"),
            ("2024-09-02", "FRR", "10.0", "PROVIDER_TO_GRID", "1", "f"),
        ],
        RAW,
    )
    rows = cl.sort_clean_bids(cl.clean_bids(raw)).collect()
    assert [(str(r.delivery_date), float(r.energy_price_eur_mwh)) for r in rows] == [
        ("2024-09-01", -100.0),
        ("2024-09-01", 50.0),
        ("2024-09-02", -10.0),
    ]
    assert all(r.load_timestamp is not None for r in rows)


def test_positive_products_by_literal_prefix(spark):
    raw = spark.createDataFrame([("POS_001",), ("POSX001",), ("NEG_001",), (None,)], "PRODUCT string")
    assert sorted(r.PRODUCT for r in cl.drop_positive_products(raw).collect()) == ["NEG_001", "POSX001"]
    assert cl.without_product(raw).count() == 1


def test_identical_bids_are_kept(spark):
    raw = spark.createDataFrame([("2024-09-01", "NEG_001", "1,5", "GRID_TO_PROVIDER", "5", "f")] * 2, RAW)
    assert cl.clean_bids(raw).count() == 2


def test_period_and_blocks(spark):
    bids = spark.createDataFrame([(dt.date(2024, 9, 1), "NEG_017")], "delivery_date date, product string")
    row = cl.period_bucket(bids).first()
    assert (row.block_index, row.block, row.block_start.hour, row.block_end.hour) == (1, "04:00-08:00", 4, 8)


def test_dates_and_numbers(spark):
    text = spark.createDataFrame([("2024-09-01",), ("2024-09-01 00:00:00",), ("09/01/2024",), ("x",), (None,)], "t string")
    parsed = [r[0] for r in text.select(ps.parse_date(F.col("t"))).collect()]
    assert parsed == [dt.date(2024, 9, 1)] * 3 + [None, None]
    number = spark.createDataFrame([("1,5",), ("-2.25",), ("abc",), ("1.234,5",)], "t string")
    assert [r[0] for r in number.select(ps.decimal_comma(F.col("t"))).collect()] == [
        Decimal("1.500"),
        Decimal("-2.250"),
        None,
        None,
    ]
    assert spark.range(1).select(ps.to_german_text(F.lit(1827897), 0)).first()[0] == "1.827.897"


def test_standardize_date_column(spark):
    df = spark.createDataFrame([("01.09.2024", "keep")], "d string, other string")
    assert cl.standardize_date_column(df, "absent").columns == ["d", "other"]
    assert cl.standardize_date_column(df, "d", "dd.MM.yyyy").first().d == dt.datetime(2024, 9, 1)
    assert cl.standardize_date_column(df, "d", "yyyy-MM-dd", strict=False).first().d is None
    with pytest.raises(PySparkException):
        cl.standardize_date_column(df, "d").collect()


def test_time_codes_cover_the_day(spark):
    day = spark.range(1, 97).select(F.col("id").cast("int").alias("q"))
    rows = day.select(
        "q",
        tc.quarter_start(F.col("q")).alias("s"),
        tc.quarter_end(F.col("q")).alias("e"),
        tc.product_code(F.col("q")).alias("p"),
        tc.quarter_of_time(tc.quarter_start(F.col("q"))).alias("back"),
        tc.quarter_of_product(tc.product_code(F.col("q"))).alias("number"),
    ).collect()
    assert all(r.q == r.back == r.number for r in rows)
    assert (rows[0].s, rows[0].e, rows[0].p) == ("00:00", "00:15", "NEG_001")
    assert (rows[64].s, rows[64].p) == ("16:00", "NEG_065")
    assert (rows[95].s, rows[95].e, rows[95].p) == ("23:45", "00:00", "NEG_096")


def test_calendar(spark):
    span = spark.sql("SELECT DATE '2024-01-30' AS lo, DATE '2024-03-02' AS hi")
    months = [(str(r.date), str(r.month_end)) for r in tc.calendar_points(span, "month").collect()]
    assert months == [("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-31")]
    assert tc.calendar_points(span, "day").count() == 33
    assert [str(r.date) for r in tc.calendar_points(span, "year").collect()] == ["2024-01-01"]


def test_schema_helpers(spark):
    df = spark.createDataFrame([("NEG_001", "1", 7)], "PRODUCT string, `ENERGY_PRICE__EUR_MWh_` string, extra int")
    named = conform_to_schema(apply_aliases(df), BIDS_RAW)
    assert named.columns == [f.name for f in BIDS_RAW.fields]
    assert named.select(quoted("ENERGY_PRICE_[EUR/MWh]")).first()[0] == "1"
    assert named.select("NOTE").first()[0] is None
    assert "ENERGY_PRICE__EUR_MWh_" in clean_column_names(named).columns


def test_quality_and_validation(spark):
    bids = spark.createDataFrame(
        [
            (dt.date(2024, 9, 1), "NEG_001", Decimal(1), Decimal(5)),
            (None, "neg-001", Decimal(1), Decimal(-5)),
            (dt.date(2025, 9, 1), None, None, Decimal(5)),
        ],
        "delivery_date date, product string, energy_price_eur_mwh decimal(18,2), allocated_capacity_mw decimal(18,3)",
    )
    failed = {r.rule: r.failed_rows for r in cl.quality_rules(bids, "2024-01-01", "2024-12-31").collect()}
    assert failed == {
        "date_in_range": 2,
        "product_pattern": 2,
        "price_in_range": 1,
        "capacity_in_range": 1,
        "no_nulls": 2,
    }
    assert cl.validate_bids(bids).first().valid is False
    assert cl.validate_bids(bids.limit(1)).first().valid is True


def test_import_date_range(spark):
    rows = spark.createDataFrame(
        [("a", "s", d) for d in ("2024-01-01", "01/05/2024", "2024-01-03", "", None)],
        "source_file string, sheet string, DELIVERY_DATE string",
    )
    ranges = {r.source_file: (str(r.min_date), str(r.max_date)) for r in rc.import_date_range(rows).collect()}
    assert ranges == {"a": ("2024-01-01", "2024-01-05"), None: ("2024-01-01", "2024-01-05")}
    empty = rc.import_date_range(rows.limit(0)).collect()
    assert [(r.min_date, r.max_date) for r in empty] == [(None, None)]
