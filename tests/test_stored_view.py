"""Stored views after loads, emptied days and stopped refreshes; price curves against clearing from bids."""

import datetime as dt
import os
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridclear.operators import merit_order as mo
from gridclear.operators import price_curve as pc
from gridclear.plans import workflows as wf
from gridclear.sources.period_table import PeriodTable
from gridclear.sources.stored_view import merged

MONTH = "delivery_date date, product string, energy_price_eur_mwh decimal(18,3), allocated_capacity_mw decimal(18,3), offered_capacity_mw decimal(18,3)"
VOLUMES = "date date, quarter_no int, activated_volume_mw decimal(18,3), month int, year int"


def day(n):
    return dt.date(2024, 9, 1) + dt.timedelta(days=n)


def number(x):
    return None if x is None else Decimal(str(x))


def bids_of(spark, days, price=1):
    rows = [(day(n), f"NEG_{q:03d}", number(price + n + q), number(5), None) for n in days for q in (1, 5, 20)]
    return spark.createDataFrame(rows, MONTH)


def demand_of(spark, days, quarters=(1, 2, 16, 20, 50)):
    rows = [(day(n), q, number(q), day(n).month, day(n).year) for n in days for q in quarters]
    return spark.createDataFrame(rows, VOLUMES)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files_by_day(view):
    root = f"{view.root}/rows"
    return {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")) for d in os.listdir(root) if "=" in d}


@pytest.fixture
def loaded(spark, tmp_path):
    activations = wf.activation_table(spark, f"{tmp_path}/activations")
    bids = wf.bid_table(spark, f"{tmp_path}/bids")
    activations.replace_partitions(demand_of(spark, range(40)))
    bids.replace_range(bids_of(spark, range(40)))
    return activations, bids, wf.active_bid_view(spark, f"{tmp_path}/view", activations, bids)


def rebuilt(activations, bids):
    return rows_of(mo.active_bids(activations.read(), bids.read()).select("date", "quarter_no", "activated_volume_mw", "block_index", "product", "price", "capacity_mw"))


def test_only_changed_days_are_computed(spark, loaded):
    activations, bids, view = loaded
    assert view.refresh() == [(day(0), dt.date(2024, 10, 31))]  # whole months of activations
    assert rows_of(view.read()) == rebuilt(activations, bids) != []
    assert view.refresh() == []
    before = files_by_day(view)
    bids.replace_range(bids_of(spark, [10, 11, 13], price=500))  # day 12 is emptied
    assert view.refresh() == [(day(10), day(13))]
    assert rows_of(view.read()) == rebuilt(activations, bids)
    after = files_by_day(view)
    assert set(before) - set(after) == {f"date={day(12)}"}
    assert {d for d in after if after[d] != before[d]} == {f"date={day(n)}" for n in (10, 11, 13)}


@pytest.mark.parametrize("most", [2, 50_000])
def test_rows_are_neither_shuffled_nor_sorted_once_bids_met_quarter_hours(spark, loaded, monkeypatch, most):
    activations, bids, view = loaded
    monkeypatch.setattr(mo, "CELL_BIDS", most, raising=False)
    gathered, seen = PeriodTable._gathered, []
    monkeypatch.setattr(PeriodTable, "_gathered", lambda *args: seen.append(gathered(*args)) or seen[-1])
    view.refresh()
    plan = seen[-1]._jdf.queryExecution().executedPlan()
    above = re.split(r"\w+Join", plan.toString())[0]
    assert "Exchange" not in above and "Sort" not in above
    assert re.match(r"\w+\(date#", str(plan.finalPhysicalPlan().outputOrdering()))  # so the writer of the days adds no sort
    assert rows_of(view.read()) == rebuilt(activations, bids) != []
    if most > 2:  # each day is a cell, and its file is in order
        assert {len(files) for files in files_by_day(view).values()} == {1}
        for name, (file,) in files_by_day(view).items():
            stored = [(r.quarter_no, r.price) for r in spark.read.parquet(f"{view.root}/rows/{name}/{file}").collect()]
            assert stored == sorted(stored) != []


def test_arranged_rows_without_a_day_are_refused(spark, loaded):
    activations, bids, view = loaded
    rows = spark.createDataFrame([(None, 1)], "date date, quarter_no int")
    with pytest.raises(Exception, match="quarantine"):
        view.table.replace_ranges(rows, [(day(0), day(1))], "refresh", [], True)
    assert view.read().isEmpty()


def test_a_changed_month_and_a_restored_snapshot_are_found(spark, loaded):
    activations, bids, view = loaded
    view.refresh()
    saved = bids.snapshot()
    activations.replace_partitions(demand_of(spark, range(30, 40), quarters=[3]))
    assert view.refresh() == [(dt.date(2024, 10, 1), dt.date(2024, 10, 31))]
    assert rows_of(view.read()) == rebuilt(activations, bids)
    bids.replace_range(bids_of(spark, [5], price=7))
    bids.restore(saved)
    view.refresh()
    assert rows_of(view.read()) == rebuilt(activations, bids)


@pytest.mark.parametrize("stop", ["before", "after"])
def test_a_stopped_refresh_is_repeated(spark, loaded, monkeypatch, stop):
    activations, bids, view = loaded
    view.refresh()
    bids.replace_range(bids_of(spark, [20, 22], price=90))
    replace = view.table.replace_ranges

    def stopped(*args):
        if stop == "after":
            replace(*args)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(view.table, "replace_ranges", stopped)
    with pytest.raises(RuntimeError):
        view.refresh()
    monkeypatch.undo()
    assert view.refresh() == [(day(20), day(22))]
    assert rows_of(view.read()) == rebuilt(activations, bids)


def test_views_of_nothing(spark, tmp_path):
    activations, bids = wf.activation_table(spark, f"{tmp_path}/a"), wf.bid_table(spark, f"{tmp_path}/b")
    view, curve = wf.active_bid_view(spark, f"{tmp_path}/v", activations, bids), wf.PriceCurve(spark, f"{tmp_path}/c", bids)
    assert view.refresh() == [] == curve.refresh() and view.read().isEmpty()
    found = curve.prices(demand_of(spark, [1])).collect()
    assert len(found) == 5 and all(r.price is None and r.available_mw == 0 and not r.is_short for r in found)
    bids.replace_range(bids_of(spark, [1]))
    view.refresh(), curve.refresh()
    assert view.read().isEmpty()
    assert [r.price for r in curve.prices(demand_of(spark, [1], [1])).collect()] == [3]
    bids.replace_ranges(bids_of(spark, []), [(day(0), day(3))])
    assert curve.refresh() == [(day(1), day(1))] and curve.levels.read().isEmpty() and curve.bands.read().isEmpty()


def test_ranges():
    assert merged([]) == []
    assert merged([(day(3), day(4)), (day(0), day(1)), (day(5), day(5)), (day(4), day(4))]) == [(day(0), day(1)), (day(3), day(5))]
    apart = [(day(0), day(0)), (day(2), day(2)), (day(9), day(9)), (day(11), day(12))]
    assert merged(apart, 2) == [(day(0), day(2)), (day(9), day(12))]
    assert merged(apart, 1) == [(day(0), day(12))]


@pytest.mark.parametrize("seed", range(3))
def test_curves_give_what_clearing_gives(spark, seed):
    rng = random.Random(seed)
    stack, demand = [], []
    for q in range(1, 41):
        codes = [f"NEG_{q:03d}", f"NEG-{q:03d}", f"NEG_X{q:03d}"]
        lowest = rng.choice([1, 1, -4])  # some intervals have negative capacities, some no prices
        for _ in range(rng.choice([0, 1, 3, 30])):
            price = None if rng.random() < (1 if q % 10 == 0 else 0.1) else rng.choice([-12.5, -10, -0.5, 0, 3, 9.99, 10, 10.01, 25, 400])
            stack.append((day(0), rng.choice(codes), number(price), number(rng.randint(lowest, 9)), None))
        demand += [(day(0), q, number(v)) for v in (None, 0, -3, 0.5, rng.randint(1, 20), rng.randint(1, 120), 4000)]
    bids = spark.createDataFrame(stack, MONTH)
    wanted = spark.createDataFrame(demand, "date date, quarter_no int, activated_volume_mw decimal(18,3)")
    levels = pc.curve_levels(bids)
    for on_short in ("null", "last"):
        got = pc.look_up(wanted.withColumn("band", F.lit("own")), pc.curve_bands(levels), levels, on_short)
        assert {r.band for r in got.collect()} == {"own"}
        assert rows_of(got.drop("band")) == rows_of(mo.clear(wanted, bids, on_short=on_short))


def test_look_ups_read_no_bids(spark, tmp_path):
    bids = wf.bid_table(spark, f"{tmp_path}/bids")
    bids.replace_range(bids_of(spark, range(3)))
    curve = wf.PriceCurve(spark, f"{tmp_path}/curve", bids)
    curve.refresh()
    plan = curve.what_if(demand_of(spark, range(3)), {"double": 2.0})._jdf.queryExecution().toString()
    assert curve.levels.table.name in plan and curve.bands.table.name in plan and bids.name not in plan
    with pytest.raises(ValueError):
        curve.prices(demand_of(spark, [1]), "first")
