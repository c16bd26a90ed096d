"""Replacing periods, versions, lineage, and the streams that feed tables."""

import datetime as dt
import os
import time
from decimal import Decimal

import pytest
from sheet_files import land

from gridclear.plans.file_queries import LOADED_ACTIVATIONS
from gridclear.schema import BIDS, REQUIRED_BID_COLUMNS
from gridclear.sources.period_table import PeriodTable
from gridclear.streaming import loads as st

COLUMNS = "delivery_date date, product string, allocated_capacity_mw decimal(18,3)"


def bids(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, 9, day), p, Decimal(mw)) for day, p, mw in rows], COLUMNS)


def contents(table):
    return sorted((r.delivery_date.day, r.product, int(r.allocated_capacity_mw)) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    return PeriodTable(spark, str(tmp_path / "t"), BIDS, ["delivery_date"])


def test_range_is_replaced_with_its_gaps(spark, table):
    assert contents(table) == []
    table.replace_range(bids(spark, (1, "a", 1), (2, "a", 1), (3, "a", 1), (4, "a", 1), (5, "a", 1)))
    table.replace_range(bids(spark, (2, "b", 2), (2, "b", 2), (4, "b", 2)))
    assert contents(table) == [(1, "a", 1), (2, "b", 2), (2, "b", 2), (4, "b", 2), (5, "a", 1)]


def test_repeating_an_import_changes_nothing(spark, table):
    rows = bids(spark, (1, "a", 1), (1, "a", 1))
    table.replace_range(rows)
    before = contents(table)
    table.replace_range(rows)
    assert contents(table) == before == [(1, "a", 1), (1, "a", 1)]


def test_partitions_leave_other_days(spark, table):
    table.replace_partitions(bids(spark, (1, "a", 1), (2, "a", 1), (3, "a", 1)))
    table.replace_partitions(bids(spark, (1, "b", 2), (3, "b", 2)))
    assert contents(table) == [(1, "b", 2), (2, "a", 1), (3, "b", 2)]


def test_empty_import_changes_nothing(spark, table):
    table.replace_range(bids(spark, (1, "a", 1)))
    table.replace_range(bids(spark, (1, "a", 1)).limit(0))
    assert contents(table) == [(1, "a", 1)]


def test_rows_without_a_date_are_refused(spark, table):
    with pytest.raises(Exception, match="quarantine"):
        table.replace_range(spark.createDataFrame([(None, "a", Decimal(1))], COLUMNS))
    assert contents(table) == []


def test_month_replacement(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["year", "month"])

    def month(values, number=9):
        rows = [(dt.date(2024, number, 1), i + 1, Decimal(str(v)), number, 2024) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "date date, quarter_no int, activated_volume_mw decimal(18,3), month int, year int")

    table.replace_partitions(month([4.364, 10.052]))
    assert table.read().count() == 2
    table.replace_partitions(month([5.0, 6.0, 7.0]))
    assert sorted(float(r.activated_volume_mw) for r in table.read().collect()) == [5.0, 6.0, 7.0]
    table.replace_partitions(month([1.0], 10))
    assert {(r.month, r.year) for r in table.read().collect()} == {(9, 2024), (10, 2024)}
    assert table.read().count() == 4


def test_restore_and_retention(spark, table):
    table.replace_range(bids(spark, (1, "original", 1), (2, "original", 1)))
    first = table.snapshot()
    table.replace_range(bids(spark, (1, "corrupted", 1), (3, "corrupted", 1)))
    assert contents(table) == [(1, "corrupted", 1), (3, "corrupted", 1)]
    second = table.snapshot()
    table.restore(first)
    assert contents(table) == [(1, "original", 1), (2, "original", 1)]
    assert table.snapshots() == [second, first]
    assert table.drop_old_snapshots(keep=1) == [first] and table.snapshots() == [second]
    assert contents(table) == [(1, "original", 1), (2, "original", 1)]


def test_rows_are_found_by_another_catalog(spark, table, tmp_path):
    table.replace_range(bids(spark, (1, "a", 1), (2, "a", 1), (3, "a", 1)))
    table.replace_range(bids(spark, (1, "b", 1), (3, "b", 1)))
    spark.sql(f"DROP TABLE {table.name}")
    again = PeriodTable(spark, str(tmp_path / "t"), BIDS, ["delivery_date"])
    assert contents(again) == [(1, "b", 1), (3, "b", 1)]


def test_lineage(spark, table):
    assert table.history().count() == 0
    table.replace_range(bids(spark, (1, "a", 1)), "provider_update", ["a.xlsx", "b.xlsx"])
    table.replace_partitions(bids(spark, (1, "a", 1)), "again")
    rows = table.history().orderBy("version_id").collect()
    assert [(r.version_id, r.operation_type, r.source_files) for r in rows] == [
        (1, "provider_update", "a.xlsx,b.xlsx"),
        (2, "again", ""),
    ]
    assert all(r.username and r.timestamp for r in rows)


def test_failed_write_is_invisible(spark, table):
    table.replace_range(bids(spark, (1, "a", 1)))
    broken = bids(spark, (1, "b", 1)).selectExpr(
        "delivery_date", "raise_error('lost') AS product", "allocated_capacity_mw"
    )
    with pytest.raises(Exception, match="lost"):
        table.replace_range(broken)
    assert contents(table) == [(1, "a", 1)]


def test_scan_reads_only_wanted_days(spark, table):
    table.replace_range(bids(spark, (1, "a", 1), (2, "a", 1)))
    plan = table.read().filter("delivery_date = DATE '2024-09-02'").select("product")
    files = plan.inputFiles()
    assert plan.count() == 1
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(delivery_date" in text and files


# --- streams -------------------------------------------------------------------------------------

NAMES = ["Datum", "Zeitzone", "von", "bis", "50Hertz (Negativ)"]


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(";".join(NAMES) + "\n" + "\n".join(lines) + "\n")


def volumes(table):
    return sorted((str(r.date), r.quarter_no, float(r.activated_volume_mw)) for r in table.read().collect())


def test_stream_takes_each_file_once(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["date"])
    landing = tmp_path / "landing"

    def run():
        stream = st.activation_stream(spark, str(landing), NAMES)
        st.incremental_landing_load(stream, table, str(tmp_path / "checkpoint"))

    drop(landing, "a.csv", "01.09.2024;CEST;00:00;00:15;4,364", "02.09.2024;CEST;00:00;00:15;1,0")
    run()
    versions = table.history().count()
    run()
    assert table.history().count() == versions
    drop(landing, "b.csv", "02.09.2024;CEST;00:15;00:30;2,5")
    run()
    assert volumes(table) == [("2024-09-01", 1, 4.364), ("2024-09-02", 2, 2.5)]


def test_corrected_value_wins(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["date"])
    landing = tmp_path / "landing"

    def run():
        stream = st.activation_stream(spark, str(landing), NAMES)
        st.latest_activation_stream(stream, table, str(tmp_path / "checkpoint"))

    drop(landing, "a.csv", "01.09.2024;CEST;00:00;00:15;4,364", "01.09.2024;CEST;00:15;00:30;1,0")
    os.utime(landing / "a.csv", (time.time() - 60,) * 2)
    run()
    drop(landing, "b.csv", "01.09.2024;CEST;00:15;00:30;9,0")
    run()
    run()
    assert volumes(table) == [("2024-09-01", 1, 4.364), ("2024-09-01", 2, 9.0)]


def test_workbook_stream(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "t"), BIDS, ["delivery_date"])
    landing = tmp_path / "landing"

    def row(day):
        return [f"2024-09-0{day}", "NEG_001", 10, "GRID_TO_PROVIDER", 5]

    land(landing, "a.xlsx", {"S": [REQUIRED_BID_COLUMNS, row(1), row(2), row(3)], "Bad": [["PRODUCT"], ["NEG_001"]]})
    rejected = []

    def run():
        st.bid_workbook_load(
            spark,
            str(landing),
            table,
            str(tmp_path / "checkpoint"),
            on_rejected=lambda sheets: rejected.extend((r.source_file, r.sheet) for r in sheets.collect()),
        )

    run()
    run()
    assert contents(table) == [(d, "NEG_001", 5) for d in (1, 2, 3)] and rejected == [("a.xlsx", "Bad")]
    land(landing, "b.xlsx", {"S": [REQUIRED_BID_COLUMNS, row(1), row(3)], "T": "broken"})
    run()
    assert contents(table) == [(d, "NEG_001", 5) for d in (1, 2, 3)] and rejected[1:] == [("b.xlsx", "T")]


def test_upsert_and_days_on_a_month_table(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["year", "month"])

    def rows(*found):
        made = [(dt.date(2024, 9, d), q, Decimal(v), "CET", 9, 2024, "f", dt.datetime(2024, 10, at)) for d, q, v, at in found]
        return spark.createDataFrame(made, LOADED_ACTIVATIONS)

    table.replace_partitions(rows((1, 1, 1, 1), (2, 1, 1, 1), (2, 2, 1, 1), (3, 1, 1, 1)))
    st.merge_latest(table, rows((2, 1, 9, 2)))
    assert volumes(table) == [("2024-09-01", 1, 1.0), ("2024-09-02", 1, 9.0), ("2024-09-02", 2, 1.0), ("2024-09-03", 1, 1.0)]
    st.replace_days(table, rows((1, 2, 5, 3), (3, 1, 5, 3)))
    assert volumes(table) == [("2024-09-01", 2, 5.0), ("2024-09-02", 1, 9.0), ("2024-09-02", 2, 1.0), ("2024-09-03", 1, 5.0)]


def test_another_column_order_fails_the_stream(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["date"])
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("Datum;von;Zeitzone;bis;50Hertz (Negativ)\n01.09.2024;00:00;CEST;00:15;1\n")
    with pytest.raises(Exception, match="header|HEADER"):
        st.incremental_landing_load(st.activation_stream(spark, str(landing), NAMES), table, str(tmp_path / "checkpoint"))
    assert table.read().count() == 0
