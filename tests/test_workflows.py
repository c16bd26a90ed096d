"""From files to prices."""

import pytest
from sheet_files import land

from gridclear.operators import profiling as pf
from gridclear.plans import workflows as wf
from gridclear.schema import REQUIRED_BID_COLUMNS
from gridclear.sources import tables as tb

HEADER = "Datum;Zeitzone;von;bis;50Hertz (Negativ)"


def land_activations(folder, *lines):
    folder.mkdir(exist_ok=True)
    (folder / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(folder)


def test_files_to_prices(spark, tmp_path):
    activations = wf.activation_table(spark, str(tmp_path / "activations"))
    bids = wf.bid_table(spark, str(tmp_path / "bids"))
    prices = wf.price_table(spark, str(tmp_path / "prices"))
    path = land_activations(
        tmp_path / "csv",
        "17.04.2024;CEST;16:00;16:15;80,528",
        "17.04.2024;CEST;16:15;16:30;0,000",
        "18.04.2024;CEST;16:00;16:15;1,000",
    )
    wf.load_activations(spark, path, activations, (2024, 4))
    rows = [
        ["2024-04-17", "NEG_065", "5,0", "PROVIDER_TO_GRID", 30],
        ["2024-04-17", "NEG_065", 4, "PROVIDER_TO_GRID", 30],
        ["2024-04-17", "NEG_065", "3.87", "PROVIDER_TO_GRID", 30],
        ["04/17/2024", "NEG_065", 10, "GRID_TO_PROVIDER", 40],
        ["2024-04-17", "POS_065", 1, "GRID_TO_PROVIDER", 999],
    ]
    sheets = {"S1": [REQUIRED_BID_COLUMNS, *rows[:2]], "S2": [REQUIRED_BID_COLUMNS, *rows[2:]], "Bad": [["A"], [1]]}
    summary, errors = wf.load_bids(spark, land(tmp_path / "xlsx", "b.xlsx", sheets), bids)
    assert tuple(summary.first())[:4] == (1, 2, 5, 1)
    assert [r.sheet for r in errors.collect()] == ["Bad"]
    for _ in range(2):
        found = wf.update_marginal_prices(activations, bids, prices, "2024-04-17").orderBy("timestamp").collect()
        assert [(r.product_code, r.marginal_price and float(r.marginal_price)) for r in found] == [
            ("NEG_065", -3.87),
            ("NEG_066", None),
        ]
    assert prices.read().count() == 2
    assert wf.update_marginal_prices(activations, bids, prices, "2025-01-01").count() == 0
    assert wf.update_marginal_prices(activations, bids, prices, "2024-04-17", "2024-04-18").count() == 3


def test_bad_activations_are_refused(spark, tmp_path):
    table = wf.activation_table(spark, str(tmp_path / "t"))
    path = land_activations(tmp_path / "csv", "17.04.2024;CEST;16:00;16:15;abc")
    with pytest.raises(wf.InvalidActivations, match="numeric"):
        wf.load_activations(spark, path, table)
    path = land_activations(tmp_path / "csv2", "17.05.2024;CEST;16:00;16:15;1")
    with pytest.raises(wf.InvalidActivations, match="2024-04"):
        wf.load_activations(spark, path, table, (2024, 4))
    assert table.read().count() == 0


def test_all_or_nothing(spark, tmp_path):
    bids = wf.bid_table(spark, str(tmp_path / "bids"))
    row = ["2024-04-17", "NEG_065", 1, "GRID_TO_PROVIDER", 1]
    path = land(tmp_path / "xlsx", "b.xlsx", {"S": [REQUIRED_BID_COLUMNS, row], "Bad": [["A"], [1]]})
    with pytest.raises(ValueError, match="Bad"):
        wf.load_bids(spark, path, bids, all_or_nothing=True)
    assert bids.read().count() == 0


def test_a_broken_file_fails_the_import_or_spares_its_days(spark, tmp_path):
    bids = wf.bid_table(spark, str(tmp_path / "bids"))

    def row(day):
        return ["2024-04-" + day, "NEG_065", 1, "GRID_TO_PROVIDER", 1]

    for day in ("16", "17", "18"):
        land(tmp_path / "xlsx", f"{day}.xlsx", {"S": [REQUIRED_BID_COLUMNS, row(day)]})
    wf.load_bids(spark, str(tmp_path / "xlsx"), bids)
    assert bids.read().count() == 3
    path = land(tmp_path / "xlsx", "17.xlsx", {"S": "broken"})
    with pytest.raises(ValueError, match="17.xlsx"):
        wf.load_bids(spark, path, bids, all_or_nothing=True)
    summary, errors = wf.load_bids(spark, path, bids)
    assert tuple(summary.first())[:4] == (3, 2, 2, 1)
    assert [r.source_file for r in errors.collect()] == ["17.xlsx"]
    assert sorted(str(r.delivery_date) for r in bids.read().collect()) == ["2024-04-16", "2024-04-17", "2024-04-18"]


def test_tables_by_name(spark, tmp_path):
    df = spark.range(3)
    df.createOrReplaceTempView("three")
    assert tb.read_table(spark, "three").count() == 3
    with pytest.raises(tb.UnknownTable):
        tb.read_table(spark, "no_such_table")
    listed = {r.table_name: (r.row_count, r.column_count) for r in pf.list_tables(tb.catalog_tables(spark)).collect()}
    assert listed["three"] == (3, 1)
    tb.create_or_replace_table(df, "kept", str(tmp_path / "kept"))
    tb.create_or_replace_table(df.union(df), "kept", str(tmp_path / "kept"))
    assert tb.read_table(spark, "kept").count() == 6
    assert tb.read_table(spark, str(tmp_path / "kept")).count() == 6
    spark.sql("DROP TABLE kept")
    spark.catalog.dropTempView("three")
