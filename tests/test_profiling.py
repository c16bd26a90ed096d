"""Generic table tools and reports on small hand-made tables."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridclear.operators import coverage as cv
from gridclear.operators import profiling as pf
from gridclear.operators import quantiles as qt
from gridclear.operators import reconcile as rc
from gridclear.operators.merit_order import overlap_join


@pytest.fixture
def three_rows(spark):
    return spark.createDataFrame([(1, "A", 10.0), (2, "B", 20.0), (3, None, 30.0)], "id int, name string, value double")


def test_table_profile(three_rows):
    row = pf.table_profile(three_rows.union(three_rows.limit(1))).first()
    assert tuple(row) == (4, 3, 1, 3, "id,name,value")


@pytest.mark.parametrize("approximate", [False, True])
def test_column_profile(three_rows, approximate):
    rows = {r.column_name: r for r in pf.column_profile(three_rows, approximate=approximate).collect()}
    name = rows["name"]
    assert (name.total_count, name.unique_values, name.null_count, name.filled_count) == (3, 2, 1, 2)
    assert (name.uniqueness_ratio, name.completeness_ratio) == (1.0, 2 / 3)
    assert (rows["value"].min_value, rows["value"].max_value) == ("10.0", "30.0")


def test_numbers_are_not_compared_as_text(spark):
    row = pf.column_profile(spark.createDataFrame([(9,), (10,)], "n int")).first()
    assert (row.min_value, row.max_value) == ("9", "10")


def test_quality_issues(three_rows):
    found = {(r.issue, r.column_name): r.metric for r in pf.data_quality_issues(three_rows).collect()}
    assert found[("missing_values", "name")] == pytest.approx(100 / 3)
    assert {c for issue, c in found if issue == "potential_id_columns"} == {"id", "name", "value"}
    assert not any(issue == "low_cardinality" for issue, _ in found)


def test_low_cardinality(spark):
    df = spark.range(101).select((F.col("id") % 4).alias("c"))
    found = {r.issue: r.metric for r in pf.data_quality_issues(df).collect()}
    assert found == {"low_cardinality": 4.0}


def test_empty_table(three_rows):
    row = [r for r in pf.column_profile(three_rows.limit(0)).collect()]
    assert all(r.uniqueness_ratio == 0 for r in row)
    assert pf.table_profile(three_rows.limit(0)).first().row_count == 0


NOTES = ["Order ERROR", "Order ERROR", "fine", "is missing", "", None, "   "]


def test_notes(spark):
    df = spark.createDataFrame([(n,) for n in NOTES], "note string")
    rows = pf.note_analysis(df).collect()
    assert [(r.note, r.frequency, r.is_error) for r in rows][0] == ("Order ERROR", 2, True)
    assert (rows[0].total_notes, rows[0].error_count, rows[0].non_error_count) == (4, 2, 2)
    assert [r.exists for r in pf.note_analysis(df, "absent").collect()] == [False]
    stats = {(r.section, r.item): r.n for r in pf.note_statistics(df).collect()}
    assert stats[("basic", "null_notes")] == 1 and stats[("basic", "empty_notes")] == 2
    assert stats[("length", "11")] == 2 and stats[("keyword", "missing")] == 1 and stats[("keyword", "error")] == 0


def test_duplicates_count_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "x"), (3, "x")], "a int, b string")
    rows = sorted((r.a, r.b, r.duplicate_count) for r in pf.duplicate_rows(df, ["a", "b"]).collect())
    assert rows == [(1, None, 2), (1, None, 2), (3, "x", 2), (3, "x", 2)]


def test_missing_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, d),) for d in (27, 29)], "d date")
    assert [str(r[0]) for r in pf.missing_dates(df, "d").collect()] == ["2024-02-28"]
    assert pf.missing_dates(df.limit(0), "d").count() == 0


def test_distribution_counts_nulls_in_the_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in pf.column_distribution(df, "v").collect()] == [("a", 2, 50.0), ("b", 1, 25.0)]


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(1, 12), 100, -90, None] if v is not None], "v double")
    assert sorted(r.v for r in pf.outliers(df, "v").collect()) == [-90.0, 100.0]
    assert sorted(r.v for r in pf.outliers(df, "v", "stddev", 2.0).collect()) == [-90.0, 100.0]
    assert pf.outliers(df, "v", "stddev").count() == 0
    assert pf.outliers(df.limit(0), "v").count() == 0
    with pytest.raises(ValueError):
        pf.outliers(df, "v", "other")


@pytest.mark.parametrize("seed", range(4))
def test_exact_quantiles(spark, monkeypatch, seed):
    monkeypatch.setattr(qt, "SMALL", 5)
    monkeypatch.setattr(qt, "BUCKETS", 4)
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(0, 1), lambda: float(rng.randint(0, 3)), lambda: 10.0 ** rng.randint(-9, 9), lambda: 7.0]
    values = [kinds[seed]() for _ in range(rng.randint(1, 120))]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = qt.exact_quantiles(df, F.col("v"), [0.0, 0.25, 0.5, 0.75, 1.0])
    expected = df.select(F.percentile("v", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))).first()[0]
    assert got == pytest.approx(expected, rel=1e-12)


def test_describe(three_rows):
    rows = {r.column_name: r for r in pf.describe_columns(three_rows.union(three_rows.limit(1))).collect()}
    assert (rows["name"].top, rows["name"].freq, rows["name"].mean) == ("A", 2, None)
    assert rows["value"].mean == 17.5


def test_browse(three_rows):
    assert [r.id for r in pf.search_rows(three_rows, "name", "%A%").collect()] == [1]
    assert pf.non_empty_rows(three_rows, "name").count() == 2
    assert [r.id for r in pf.preview_rows(three_rows, 1, 1, ["id"]).collect()] == [2]
    assert pf.table_schema(three_rows).first().asDict() == {
        "ordinal": 0,
        "column_name": "id",
        "data_type": "int",
        "nullable": True,
    }
    samples = pf.table_samples({"t": three_rows}, 2).collect()
    assert len(samples) == 2 and samples[0].row == '{"id":1,"name":"A","value":10.0}'


def test_latest_and_audit(spark):
    rows = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "only", 1), (1, "new", 2)], "k int, v string, load_timestamp int"
    )
    assert sorted((r.k, r.v) for r in rc.latest_per_interval(rows, ["k"], ["load_timestamp"]).collect()) == [
        (1, "new"),
        (2, "only"),
    ]
    audited = sorted((r.k, r.v, r.effective_from, r.effective_to) for r in rc.audit_columns(rows, ["k"]).collect())
    assert audited == [(1, "new", 2, None), (1, "new", 2, None), (1, "old", 1, 2), (2, "only", 1, None)]


def test_reconciliation(spark):
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "d int, k string")
    target = spark.createDataFrame([(1, "a"), (1, "a"), (3, "a")], "d int, k string")
    rows = {r.date: (r.source_rows, r.target_rows, r.is_equal, r.repeated_keys) for r in rc.load_reconciliation(source, target, "d", ["k"]).collect()}
    assert rows == {1: (2, 2, True, 1), 2: (1, 0, False, 0), 3: (0, 1, False, 0)}


def test_overlap_join(spark):
    def ranges(rows, name):
        full = [(n, dt.datetime(2024, 1, 1, *a), dt.datetime(2024, 1, 1, *b)) for n, a, b in rows]
        return spark.createDataFrame(full, f"{name} string, start_ts timestamp_ntz, end_ts timestamp_ntz")

    left = ranges([("long", (0, 0), (9, 0)), ("touch", (9, 0), (10, 0)), ("inner", (4, 15), (4, 30))], "l")
    right = ranges([("block", (4, 0), (9, 0)), ("late", (8, 59), (9, 1))], "r")
    got = sorted((r.l, r.r) for r in overlap_join(left, right, 60).collect())
    assert got == [("inner", "block"), ("long", "block"), ("long", "late"), ("touch", "late")]


def price_rows(spark, rows):
    schema = "date date, quarter_hour_start string, marginal_price decimal(18,2), activated_volume_mw decimal(18,3)"
    full = [(dt.date(2024, 9, 1), at, None if p is None else Decimal(p), Decimal(1)) for at, p in rows]
    return spark.createDataFrame(full, schema)


def test_price_reports(spark):
    prices = price_rows(spark, [("00:00", 1), ("00:15", 2), ("00:30", None), ("00:45", 4)])
    segments = [(r.quarter_hour_start, r.connected, r.segment) for r in cv.price_gaps(prices).orderBy("hour").collect()]
    assert segments == [("00:00", False, 1), ("00:15", True, 1), ("00:45", False, 2)]
    grid = cv.full_day_grid(prices)
    assert grid.count() == 96 and grid.filter("marginal_price IS NOT NULL").count() == 3
    stats = cv.price_statistics(prices).first()
    assert (stats.intervals, stats.priced, stats.priced_percent) == (4, 3, 75.0)
    rows = {r.date: (r.intervals, r.with_price, r.days) for r in cv.price_coverage(prices).collect()}
    assert rows == {dt.date(2024, 9, 1): (4, 3, 1), None: (4, 3, 1)}
    assert cv.price_statistics(prices.limit(0)).first().priced_percent is None


def test_missing_products(spark):
    present = [(dt.date(2024, 9, 1), f"NEG_{i:03d}") for i in range(1, 97) if i not in (6, 96)]
    bids = spark.createDataFrame(present + [(dt.date(2024, 9, 2), "NEG_006")], "delivery_date date, product string")
    day = cv.missing_products(bids).filter("date = DATE '2024-09-01'").orderBy("product").collect()
    assert [(r.product, r.hour, r.quarter, r.days_with_product) for r in day] == [("NEG_006", 1, 1, 1), ("NEG_096", 23, 3, 0)]
    pattern = cv.missing_pattern(bids).filter("date = DATE '2024-09-01'").first()
    assert (pattern.missing_count, pattern.hours, pattern.quarters) == (2, "1,23", "1,3")
    assert cv.difference_products(bids).count() == 2 + 95


def test_block_reports(spark):
    rows = [(dt.date(2024, 9, 1), p) for p, n in (("NEG_001", 2), ("NEG_002", 3), ("NEG_017", 1)) for _ in range(n)]
    counts = cv.bid_count_per_interval(spark.createDataFrame(rows, "delivery_date date, product string"))
    odd = cv.block_inconsistencies(counts).collect()
    assert [(r.product, r.time, r.bid_count, r.block_min) for r in odd] == [("NEG_002", "00:15", 3, 2)]
    stats = {r.block: (r.min_bids, r.max_bids, r.products) for r in cv.block_statistics(counts).collect()}
    assert stats == {"00:00-04:00": (2, 3, 2), "04:00-08:00": (1, 1, 1)}


def test_infinite_values_and_nan_end(spark):
    import math

    rows = [(float(k),) for k in range(3000)] + [(math.inf,), (-math.inf,), (math.nan,), (None,), (1.7e308,), (-1.7e308,)]
    df = spark.createDataFrame(rows, "v double")
    from pyspark.sql import functions as F

    from gridclear.operators import quantiles

    small, quantiles.SMALL = quantiles.SMALL, 10
    try:
        found = quantiles.exact_quantiles(df, F.col("v"), [0.0, 0.25, 0.5, 1.0])
    finally:
        quantiles.SMALL = small
    assert found == [-math.inf, 748.75, 1499.5, math.inf]
    assert {r.v for r in pf.outliers(df, "v").collect()} == {math.inf, -math.inf, 1.7e308, -1.7e308}
    usual = df.filter("abs(v) < 1e300D OR abs(v) = double('infinity') OR v IS NULL OR isnan(v)")
    assert {r.v for r in pf.outliers(usual, "v", "stddev").collect()} == {math.inf, -math.inf}
    assert quantiles.exact_quantiles(df.filter("v > 1e308D"), F.col("v"), [0.5])[0] == math.inf
