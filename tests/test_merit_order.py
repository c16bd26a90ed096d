"""Clearing against worked examples and against a step-by-step evaluation."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridclear.functions.matching import UNMATCHED
from gridclear.operators import merit_order as mo

DAY = dt.date(2024, 9, 1)
BID = "delivery_date date, product string, energy_price_eur_mwh decimal(18,2), allocated_capacity_mw decimal(18,3), offered_capacity_mw decimal(18,3)"
DEMAND = "date date, quarter_no int, activated_volume_mw decimal(18,3)"


def number(x):
    return None if x is None else Decimal(str(x))


def bids_of(spark, *rows):
    """Rows of (product, price, MW) or (product, price, allocated, offered)."""
    full = [(DAY, r[0], number(r[1]), number(r[2]), number(r[3]) if len(r) > 3 else None) for r in rows]
    return spark.createDataFrame(full, BID)


def demand_of(spark, *rows):
    return spark.createDataFrame([(DAY, q, number(mw)) for q, mw in rows], DEMAND)


def cleared(spark, demand, bids, **options):
    return mo.clear(demand_of(spark, *demand), bids_of(spark, *bids), **options).collect()


EXAMPLE = [("NEG_065", -5, 30), ("NEG_065", -4, 30), ("NEG_065", -3.87, 30), ("NEG_065", 10, 40)]


def test_worked_example(spark):
    row = cleared(spark, [(65, 80.528)], EXAMPLE)[0]
    assert (row.price, row.cleared_mw, row.available_mw, row.is_short) == (number("-3.87"), 90, 130, False)


def test_table_example(spark):
    row = cleared(spark, [(65, 80.528)], [("NEG_065", -10, 30), ("NEG_065", -5, 20), ("NEG_065", -3.87, 40)])[0]
    assert (row.price, row.cleared_mw) == (number("-3.87"), 90)


def test_golden_first_interval(spark):
    stack = [(-48.34, 1), (-44.74, 5), (-39.11, 5), (-38.58, 5), (-35.11, 2)]
    row = cleared(spark, [(1, 4.364)], [("NEG_001", p, mw) for p, mw in stack])[0]
    assert (row.price, row.cleared_mw) == (number("-44.74"), 6)


@pytest.mark.parametrize("volume", [0, 0.0009])
def test_zero_activation_has_no_price(spark, volume):
    demand = spark.createDataFrame([(DAY, 65, number(volume))], DEMAND.replace("18,3", "18,4"))
    row = mo.clear(demand, bids_of(spark, *EXAMPLE)).collect()[0]
    assert (row.price, row.available_mw, row.is_short) == (None, 0, False)


def test_interval_without_bids_is_kept(spark):
    row = cleared(spark, [(12, 5)], EXAMPLE)[0]
    assert (row.price, row.available_mw, row.match_tier) == (None, 0, None)


def test_shortfall(spark):
    bids = [("NEG_001", 1, 10)]
    assert cleared(spark, [(1, 20)], bids)[0].price is None
    row = cleared(spark, [(1, 20)], bids, on_short="last")[0]
    assert (row.price, row.is_short, row.cleared_mw) == (1, True, 10)
    with pytest.raises(ValueError):
        cleared(spark, [(1, 20)], bids, on_short="other")


def test_exact_cover_is_no_shortfall(spark):
    row = cleared(spark, [(1, 10)], [("NEG_001", 1, 4), ("NEG_001", 2, 6)])[0]
    assert (row.price, row.is_short) == (2, False)


def test_ties(spark):
    row = cleared(spark, [(1, 7)], [("NEG_001", 1, 5), ("NEG_001", 1, 5), ("NEG_001", 2, 5)])[0]
    assert (row.price, row.cleared_mw) == (1, 10)


@pytest.mark.parametrize("code", ["NEG-001", "neg_001", "NEG001", "NEG_1"])
def test_tier_two(spark, code):
    row = cleared(spark, [(1, 1)], [(code, 3, 5)])[0]
    assert (row.price, row.match_tier) == (3, 2)


@pytest.mark.parametrize("code", ["NEG_X001", "neg-001", "NEGATIVE 001", "NEG_1001"])
def test_tier_three(spark, code):
    row = cleared(spark, [(1, 1)], [(code, 3, 5)])[0]
    assert (row.price, row.match_tier) == (3, 3)


@pytest.mark.parametrize("code", ["POS_001", "NEG_097", "NEG_000", "NEG", "NEG_", "neg_1", "NEG_1A", "NEG_+01", "NEG_ 01", "NE001", ""])
def test_no_match(spark, code):
    row = cleared(spark, [(q, 1) for q in (1,)], [(code, 3, 5)])[0]
    assert (row.price, row.match_tier) == (None, None)


def test_better_tier_wins(spark):
    row = cleared(spark, [(1, 4)], [("NEG_001", 9, 5), ("NEG-001", 1, 5), ("NEG_X001", 0, 5)])[0]
    assert (row.price, row.available_mw, row.match_tier) == (9, 5, 1)


def test_offered_capacity_is_preferred(spark):
    bids = [("NEG_001", 1, 10, 2), ("NEG_001", 2, 10, None)]
    row = cleared(spark, [(1, 5)], bids)[0]
    assert (row.price, row.available_mw) == (2, 12)
    row = cleared(spark, [(1, 5)], bids, capacity=F.col("allocated_capacity_mw"))[0]
    assert (row.price, row.available_mw) == (1, 20)


def test_missing_numbers(spark):
    bids = [("NEG_001", 1, None), ("NEG_001", 2, 3), ("NEG_001", None, 10)]
    assert cleared(spark, [(1, 3)], bids)[0].price == 2
    row = cleared(spark, [(1, 5)], bids)[0]
    assert (row.price, row.available_mw, row.cleared_mw, row.is_short) == (None, 13, 3, True)
    assert cleared(spark, [(1, 5)], bids, on_short="last")[0].price == 2
    row = cleared(spark, [(1, 5)], [("NEG_001", None, 10)], on_short="last")[0]
    assert (row.price, row.available_mw, row.cleared_mw, row.is_short) == (None, 10, 0, True)


def test_negative_capacity_is_summed_as_it_is(spark):
    bids = [("NEG_001", -50, 5), ("NEG_001", 1, -4), ("NEG_001", 60, 5), ("NEG_001", 90, 1)]
    for volume, price, through in ((5, -50, 5), (5.5, 60, 6), (6, 60, 6), (7, 90, 7), (-1, -50, 5)):
        (row,) = cleared(spark, [(1, volume)], bids)
        assert (row.price, row.available_mw, row.cleared_mw, row.is_short) == (price, 7, through, False)
    (row,) = cleared(spark, [(1, 8)], bids, on_short="last")
    assert (row.price, row.cleared_mw, row.is_short) == (90, 7, True)
    # Inside one band the sum reaches the volume and falls again.
    (row,) = cleared(spark, [(1, 9)], [("NEG_001", 1, 9), ("NEG_001", 2, -9), ("NEG_001", 3, 1)])
    assert (row.price, row.available_mw, row.cleared_mw, row.is_short) == (1, 1, 9, False)


def test_negative_volume_takes_the_first_bid(spark):
    assert [r.price for r in cleared(spark, [(1, -3)], [("NEG_001", 7, 5), ("NEG_001", 90, 5)])] == [7]


def test_bands_around_zero_and_far_apart(spark):
    bids = [("NEG_001", p, 1) for p in (-15000, -10.01, -10, -9.99, -0.01, 0, 0.01, 9.99, 10, 19.99, 15000.5)]
    for n, expected in enumerate((-15000, -10.01, -10, -9.99, -0.01, 0, 0.01, 9.99, 10, 19.99, 15000.5), 1):
        row = cleared(spark, [(1, n - 0.5)], bids)[0]
        assert (float(row.price), row.cleared_mw) == (expected, n)


def test_repeated_quarter_hour_prices_both(spark):
    demand = spark.createDataFrame(
        [(DAY, 9, Decimal(5), "CEST"), (DAY, 9, Decimal(25), "CET")], DEMAND + ", time_zone string"
    )
    bids = bids_of(spark, ("NEG_009", 1, 10), ("NEG_009", 2, 20))
    rows = {r.time_zone: r.price for r in mo.clear(demand, bids).collect()}
    assert rows == {"CEST": 1, "CET": 2}


def test_what_if(spark):
    demand = demand_of(spark, (65, 80.528))
    found = mo.what_if_price(demand, bids_of(spark, *EXAMPLE), {"base": 1.0, "less": 0.5}, {"more": 120}).collect()
    assert {r.scenario: float(r.price) for r in found} == {"base": -3.87, "less": -4.0, "more": 10.0}


def test_curve(spark):
    rows = mo.merit_order_curve(bids_of(spark, *EXAMPLE)).orderBy("price").collect()
    assert [(float(r.price), float(r.cumulative_mw)) for r in rows] == [(-5, 30), (-4, 60), (-3.87, 90), (10, 130)]


def test_codes_without_meaning_are_in_no_report(spark):
    bids = bids_of(spark, *EXAMPLE, ("NEG_000", 1, 5), ("NEG_", 1, 5), ("POS_001", 1, 5))
    for report in (mo.merit_order_curve, mo.available_capacity, mo.best_match_tier):
        assert {r.quarter_no for r in report(bids).collect()} == {65}
    demand = demand_of(spark, (65, 1), (1, 1))
    assert {r.quarter_no for r in mo.match_bids_tiered(demand, bids).collect()} == {65}
    assert [r.quarter_no for r in mo.intervals_without_bids(demand, bids).collect()] == [1]


def test_shortfall_report(spark):
    demand = demand_of(spark, (65, 150), (64, 1))
    rows = mo.capacity_shortfall(demand, bids_of(spark, *EXAMPLE)).collect()
    assert [(r.quarter_no, r.shortfall_mw) for r in rows] == [(65, 20)]


def test_date_range_is_inclusive_and_open(spark):
    days = spark.createDataFrame([(dt.date(2024, 9, d),) for d in (1, 2, 3)], "date date")
    assert mo.date_range(days, "date", "2024-09-02", "2024-09-03").count() == 2
    assert mo.date_range(days, "date", None, "2024-09-02").count() == 2
    assert mo.date_range(days, "date", None, None).count() == 3


def test_same_prices_without_broadcasts(spark):
    demand = [(q, q) for q in range(1, 30)]
    bids = [(f"NEG_{q:03d}", p, 4) for q in range(1, 30) for p in (-20, 0, 5, 300)]
    expected = sorted(cleared(spark, demand, bids))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(cleared(spark, demand, bids)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_building_a_plan_starts_no_job(spark):
    spark.sparkContext.setJobGroup("plans", "no job")
    frames = demand_of(spark, (1, 1)), bids_of(spark, *EXAMPLE)
    mo.clear(*frames)
    mo.match_bids_exact(frames[0], frames[1])
    mo.match_bids_tiered(frames[0], frames[1])
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plans")) == []


def test_bids_active_in_an_interval(spark):
    rows = mo.active_bids(demand_of(spark, (64, 1), (65, 2)), bids_of(spark, *EXAMPLE, ("NEG_049", 7, 1), ("NEG_080", 8, 1))).collect()
    assert sorted((r.quarter_no, float(r.price)) for r in rows) == [
        (64, 7.0), (65, -5.0), (65, -4.0), (65, -3.87), (65, 8.0), (65, 10.0),
    ]


@pytest.mark.parametrize("most", [1, 7, 50_000])
def test_active_bids_of_cells(spark, monkeypatch, most):
    """Days in one cell, blocks and parts of blocks give what pairs row by row give, with copies, nulls and codes that mean nothing."""
    monkeypatch.setattr(mo, "CELL_BIDS", most, raising=False)
    rng = random.Random(5)
    days = [dt.date(2024, 9, 1), dt.date(2024, 9, 2), dt.date(2024, 9, 3), None]
    codes = ["NEG_001", "NEG_016", "NEG_017", "POS_017", "NEG_090", "NEG_000", "NEG_XYZ", None]
    amounts = [None, Decimal("1.000"), Decimal("2.500")]
    offers = [(rng.choice(days), rng.choice(codes), rng.choice(amounts), rng.choice(amounts), rng.choice(amounts)) for _ in range(150)]
    offers += [(days[0], "NEG_001", amounts[1], amounts[2], None)] * 20
    demand = [(rng.choice(days), rng.choice([None, 0, 1, 16, 17, 32, 96]), rng.choice(amounts)) for _ in range(40)]
    bids = spark.createDataFrame(
        offers,
        "delivery_date date, product string, energy_price_eur_mwh decimal(18,3), allocated_capacity_mw decimal(18,3), offered_capacity_mw decimal(18,3)",
    )
    wanted = spark.createDataFrame(demand, "date date, quarter_no int, activated_volume_mw decimal(18,3)")
    expected = [
        (date, (quarter - 1) // 16, quarter, volume, product, price, allocated if offered is None else offered)
        for date, quarter, volume in demand
        for day, product, price, allocated, offered in offers
        if date is not None and date == day and quarter is not None and (product or "").lstrip("NEGPOS_").isdigit()
        if (int(product[-3:]) - 1) // 16 == (quarter - 1) // 16
    ]
    found = mo.active_bids(wanted, bids)
    assert found.columns == ["date", "block_index", "quarter_no", "activated_volume_mw", "product", "price", "capacity_mw"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr) != []
    assert found.union(mo.active_bids(wanted, bids)).union(found).count() == 3 * len(expected)


SPELLINGS = ["NEG_{0:03d}", "NEG-{0:03d}", "NEG{0:03d}", "neg_{0:03d}", "NEG_{0}", "NEG_X{0:03d}", "neg-{0:03d}", "POS_{0:03d}"]


def stepwise(volume, quarter, bids):
    """The rules one after the other, on plain lists."""
    if abs(volume) < Decimal("0.001"):
        return None, Decimal(0)
    code = f"NEG_{quarter:03d}"
    tries = [
        lambda p: p == code,
        lambda p: p in (code.replace("_", "-"), code.replace("_", ""), code.lower(), f"NEG_{quarter}"),
        lambda p: p[:3] in ("NEG", "neg") and len(p) >= 6 and p.endswith(code[4:]),
    ]
    for fits in tries:
        offers = sorted((price, mw) for product, price, mw in bids if fits(product))
        if offers:
            total = Decimal(0)
            for price in sorted({p for p, _ in offers}):  # equal prices clear together
                total += sum(m for p, m in offers if p == price)
                if total >= volume:
                    return price, sum(m for _, m in offers)
            return None, sum(m for _, m in offers)
    return None, Decimal(0)


@pytest.mark.parametrize("seed", range(3))
def test_random_stacks(spark, seed):
    rng = random.Random(seed)
    quarters = [1, 2, 9, 10, 11, 95, 96]
    bids = [
        (
            rng.choice(SPELLINGS).format(rng.choice(quarters)),
            Decimal(rng.choice([rng.randint(-3000, 3000), rng.randint(-100000, 100000)])) / 100,
            Decimal(rng.randint(-2000 if seed == 2 else 0, 8000)) / 1000,
        )
        for _ in range(400)
    ]
    demand = [(q, Decimal(rng.randint(0, 150000)) / 1000) for q in quarters + [50]]
    got = {r.quarter_no: (r.price, r.available_mw) for r in cleared(spark, demand, bids)}
    assert got == {q: stepwise(v, q, bids) for q, v in demand}


def test_unmatched_marker_is_no_tier():
    assert UNMATCHED not in (1, 2, 3)
