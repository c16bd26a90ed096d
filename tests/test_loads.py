"""Loads that lose nothing: refused rows, broken files, and failures between steps."""

import datetime as dt
from decimal import Decimal

import pytest
from sheet_files import land

from gridclear.functions import parsing as ps
from gridclear.operators import cleaning as cl
from gridclear.plans import workflows as wf
from gridclear.plans.file_queries import LOADED_ACTIVATIONS
from gridclear.schema import REQUIRED_BID_COLUMNS
from gridclear.sources.period_table import PeriodTable
from gridclear.streaming import ledger as lg
from gridclear.streaming import loads as st
from pyspark.sql import functions as F

NAMES = ["Datum", "Zeitzone", "von", "bis", "50Hertz (Negativ)"]


def bid(day, price="10", capacity=5):
    return [day if "-" in str(day) else f"2024-09-{day:02d}", "NEG_001", price, "GRID_TO_PROVIDER", capacity]


def stored(table):
    return sorted((r.delivery_date.day, float(r.energy_price_eur_mwh)) for r in table.read().collect())


def test_a_refused_bid_does_not_empty_its_day_in_a_stream(spark, tmp_path):
    table = wf.bid_table(spark, str(tmp_path / "t"))

    def load(name, *rows):
        folder = land(tmp_path / "in", name, {"S": [REQUIRED_BID_COLUMNS, *rows]})
        st.bid_workbook_load(spark, folder, table, str(tmp_path / "checkpoint"))

    load("a.xlsx", *(bid(d) for d in range(1, 6)))
    load("b.xlsx", bid(1, "20"), bid(2, "abc"), bid(4, "20"), bid(4, "x"), bid(5, "20"))
    # The 2nd keeps its bid, the 3rd was not delivered again and is emptied, the 4th has what could be read.
    assert stored(table) == [(1, 20.0), (2, 10.0), (4, 20.0), (5, 20.0)]
    letters = lg.dead_letters(spark, table).orderBy("raw").collect()
    assert [(r.source_file, r.sheet, r.reason) for r in letters] == [("b.xlsx", "S", "unreadable price")] * 2
    assert '"abc"' in letters[0].raw


def test_a_refused_bid_does_not_empty_its_day_in_batch(spark, tmp_path):
    table = wf.bid_table(spark, str(tmp_path / "t"))
    wf.load_bids(spark, land(tmp_path / "one", "a.xlsx", {"S": [REQUIRED_BID_COLUMNS, *(bid(d) for d in range(1, 6))]}), table)
    again = [bid(1, "20"), bid(2, "abc"), bid(4, "20"), bid(4, "x"), bid(5, "20")]
    _, errors = wf.load_bids(spark, land(tmp_path / "two", "b.xlsx", {"S": [REQUIRED_BID_COLUMNS, *again]}), table)
    assert stored(table) == [(1, 20.0), (2, 10.0), (4, 20.0), (5, 20.0)]
    assert [r.error for r in errors.collect()] == ["2 rows in quarantine: unreadable price"]
    assert spark.read.parquet(f"{table.root}/quarantine").count() == 2


@pytest.mark.parametrize("bad", [{"S": [REQUIRED_BID_COLUMNS, bid("nonsense-day")]}, {"S": [["PRODUCT"], ["NEG_001"]]}, {"S": "broken"}])
def test_where_days_are_not_known_none_is_emptied(spark, tmp_path, bad):
    table = wf.bid_table(spark, str(tmp_path / "t"))
    wf.load_bids(spark, land(tmp_path / "one", "a.xlsx", {"S": [REQUIRED_BID_COLUMNS, *(bid(d) for d in range(1, 4))]}), table)
    land(tmp_path / "two", "b.xlsx", {"S": [REQUIRED_BID_COLUMNS, bid(1, "20"), bid(3, "20")]})
    wf.load_bids(spark, land(tmp_path / "two", "c.xlsx", bad), table)
    assert stored(table) == [(1, 20.0), (2, 10.0), (3, 20.0)]


def drop(folder, name, *lines, header=";".join(NAMES)):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def volumes(table):
    return sorted((str(r.date), r.quarter_no, r.time_zone, float(r.activated_volume_mw)) for r in table.read().collect())


def test_one_broken_file_a_restart_and_nothing_twice(spark, tmp_path, monkeypatch):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["date"])
    landing, archive, rejected = (tmp_path / n for n in ("landing", "archive", "rejected"))

    def run():
        st.load_activation_files(spark, str(landing), table, str(tmp_path / "checkpoint"), archive=str(archive), rejected=str(rejected))

    drop(landing, "a.csv", "01.09.2024;CEST;00:00;00:15;4,364")
    drop(landing, "b.csv", "00:15;02.09.2024;1,5;00:30;CEST", header='von;Datum;"50Hertz (Negativ)";bis;Zeitzone')
    drop(landing, "c.csv", "02.09.2024;CEST;7", header="Datum;Zeitzone;Preis")
    (landing / "d.csv").write_text("")
    calls = []

    def fail_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("the driver dies before files are moved")
        return moved(*args)

    moved = st.move_into
    monkeypatch.setattr(st, "move_into", fail_once)
    with pytest.raises(Exception, match="driver dies"):
        run()
    versions = table.history().count()
    run()
    assert table.history().count() == versions == 1  # the repeated batch loaded nothing again
    assert volumes(table) == [("2024-09-01", 1, "CEST", 4.364), ("2024-09-02", 2, "CEST", 1.5)]
    letters = sorted((r.source_file, r.reason) for r in lg.dead_letters(spark, table).collect())
    assert ("c.csv", "columns absent: von, bis, 50Hertz (Negativ)") in letters
    assert sorted(p.name for p in archive.iterdir()) == ["a.csv", "b.csv"]
    assert "c.csv" in [p.name for p in rejected.iterdir()]
    assert [len(e["loaded"]) for e in lg.Ledger(table, str(tmp_path / "checkpoint")).entries()] == [2]


def test_a_batch_that_fails_inside_is_done_again(spark, tmp_path, monkeypatch):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["date"])
    landing, write = tmp_path / "landing", st.replace_days
    drop(landing, "a.csv", "01.09.2024;CEST;00:00;00:15;4,364", "01.09.2024;CEST;00:15;00:30;?")

    def fail_after(*args, **kwargs):
        write(*args, **kwargs)
        raise OSError("dies after the rows")

    monkeypatch.setattr(st, "replace_days", fail_after)
    with pytest.raises(Exception, match="dies after"):
        st.load_activation_files(spark, str(landing), table, str(tmp_path / "checkpoint"))
    monkeypatch.setattr(st, "replace_days", write)
    st.load_activation_files(spark, str(landing), table, str(tmp_path / "checkpoint"))
    assert volumes(table) == [("2024-09-01", 1, "CEST", 4.364)]
    assert lg.dead_letters(spark, table).count() == 1


def test_days_with_refused_rows_are_merged(spark, tmp_path):
    table = PeriodTable(spark, str(tmp_path / "t"), LOADED_ACTIVATIONS, ["year", "month"])
    landing = tmp_path / "landing"

    def run():
        st.load_activation_files(spark, str(landing), table, str(tmp_path / "checkpoint"))

    drop(landing, "a.csv", *(f"{d:02d}.09.2024;CEST;00:{q}0;00:45;{d}" for d in (1, 2, 3) for q in (0, 3)))
    run()
    drop(landing, "b.csv", "01.09.2024;CEST;00:00;00:15;10", "02.09.2024;CEST;00:00;00:15;20", "02.09.2024;CEST;00:30;00:45;1,2345")
    run()
    # Day 1 is replaced, day 2 merged, as one of its rows was refused.
    assert [v[:2] + v[3:] for v in volumes(table)] == [
        ("2024-09-01", 1, 10.0), ("2024-09-02", 1, 20.0), ("2024-09-02", 3, 2.0), ("2024-09-03", 1, 3.0), ("2024-09-03", 3, 3.0)]
    drop(landing, "c.csv", "03.09.2024;CEST;00:00;00:15;30", "31.13.2024;CEST;00:30;00:45;5")
    run()
    assert [v[3] for v in volumes(table) if v[0] == "2024-09-03"] == [30.0, 3.0]


SCHEMA = "delivery_date date, product string, energy_price_eur_mwh decimal(18,3)"


def bids(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, 9, d), n, Decimal(p)) for d, n, p in rows], SCHEMA)


def test_a_range_load_that_stops_between_its_steps(spark, tmp_path, monkeypatch):
    table = wf.bid_table(spark, str(tmp_path / "t"))
    table.replace_range(bids(spark, (1, "a", 1), (2, "a", 1), (3, "a", 1), (4, "a", 1)), "first")
    drop_partitions = PeriodTable._drop_partitions

    def dies(self, gone):
        raise OSError("stopped before days are emptied")

    monkeypatch.setattr(PeriodTable, "_drop_partitions", dies)
    with pytest.raises(OSError):
        table.replace_range(bids(spark, (1, "b", 2), (4, "b", 2)), "second")
    monkeypatch.setattr(PeriodTable, "_drop_partitions", drop_partitions)
    assert table.read().count() == 4
    other = PeriodTable(spark, str(tmp_path / "t"), table.schema, ["delivery_date"])
    assert other.recover() == [] and stored(other) == [(1, 2.0), (4, 2.0)]
    assert [r.operation_type for r in other.history().orderBy("version_id").collect()] == ["first", "second"]
    spark.sql(f"DROP TABLE {table.name}")  # files of emptied days are gone too: nothing comes back
    assert stored(wf.bid_table(spark, str(tmp_path / "t"))) == [(1, 2.0), (4, 2.0)]
    with pytest.raises(Exception):
        table.replace_range(bids(spark, (1, "c", 3)).withColumn("delivery_date", F.raise_error(F.lit("no rows")).cast("date")), "third")
    assert other.recover() == ["third"] and other.recover() == []
    assert stored(table) == [(1, 2.0), (4, 2.0)]


def test_layouts_agree_with_the_parser(spark):
    given = ["2024-02-29", "2023-02-29", "2024-2-9", " 2024-09-01 ", "2024-09-01 23:59:59", "2024-09-01 24:00:00", "2024-09-01T00:00:00",
             "02/29/2024", "2/9/2024", "13/01/2024", "2024-13-01", "2024-00-10", "x2024-09-01", "2024-09-01x", "", None, "20240901"]
    rows = spark.createDataFrame([(t,) for t in given], "t string").select(
        ps.parse_date(F.col("t")).alias("got"), F.coalesce(*[F.try_to_date(F.trim("t"), layout) for layout in ps.DATE_LAYOUTS]).alias("want")
    )
    assert [r.got for r in rows.collect()] == [r.want for r in rows.collect()]


def test_numbers_agree_with_the_cast(spark):
    given = ["1", "1.5", "1,5", "-3", "+4,25", ".5", ",5", "5.", "1e3", "1E-2", "", " ", None, "abc", "1,2,3", "--1", "1.2345", "99999999999999999999", " 7 ", "NaN"]
    rows = spark.createDataFrame([(t,) for t in given], "t string").select(
        ps.decimal_comma(F.col("t")).alias("got"), F.replace(F.trim("t"), F.lit(","), F.lit(".")).try_cast("decimal(18,3)").alias("want"),
        ps.unreadable_number(F.col("t")).alias("bad"), "t",
    ).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert {r.t for r in rows if r.bad} == {"abc", "1,2,3", "--1", "1.2345", "99999999999999999999", "NaN"}


def test_reasons_of_activation_rows(spark):
    rows = [("01.09.2024", "00:00", "00:15", "1,5"), ("31.02.2024", "00:00", "00:15", "1"), ("1.9.2024", "00:00", "00:15", "1"), ("01.09.2024", "0:00", "00:15", "1"),
            ("01.09.2024", "00:00", None, "1"), ("01.09.2024", "00:00:00", "00:15", ""), ("01.09.2024", "00:00", "00:15", "1,2345"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "Datum string, von string, bis string, `50Hertz (Negativ)` string")
    assert [r[0] for r in df.select(cl.activation_problem()).collect()] == [
        None, "unreadable date", "unreadable date", "unreadable time", "unreadable time", "unreadable volume", "unreadable volume", "unreadable date"]
