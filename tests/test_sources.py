"""Workbooks, delimited files and landing folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from sheet_files import land, sheet_xml

from gridclear.operators import cleaning as cl
from gridclear.operators import reconcile as rc
from gridclear.schema import ACTIVATION_COLUMNS, REQUIRED_BID_COLUMNS
from gridclear.sources import delimited as dl
from gridclear.sources import landing as ln
from gridclear.sources import workbooks as wb

HEADER = [*REQUIRED_BID_COLUMNS, "NOTE"]
ROW = ["2024-09-01", "NEG_001", 100.0, "PROVIDER_TO_GRID", 5, None]


def land_bytes(folder, **files):
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_bytes(content)
    return str(folder)


def manifest(spark, path):
    return {(r.source_file, r.sheet): r for r in wb.sheet_manifest(wb.scan_sheets(spark, path)).collect()}


@pytest.mark.parametrize("places", [False, True])
def test_two_sheets_with_empty_note(spark, tmp_path, places):
    found = manifest(spark, land(tmp_path, "a.xlsx", {"Sheet1": [HEADER, ROW, ROW], "Sheet2": [HEADER, ROW]}, places=places))
    assert {k: (v.row_count, len(v.header)) for k, v in found.items()} == {
        ("a.xlsx", "Sheet1"): (2, 5),
        ("a.xlsx", "Sheet2"): (1, 5),
    }


def test_filled_last_column_is_kept(spark, tmp_path):
    path = land(tmp_path, "a.xlsx", {"S": [["A", "B", "NOTE"], [1, 2, ""], [3, 4, "something"]]})
    assert manifest(spark, path)["a.xlsx", "S"].header == ["A", "B", "NOTE"]
    rows = wb.to_columns(wb.scan_sheets(spark, path), ["A", "NOTE", "absent"]).orderBy("row_no").collect()
    assert [(r.A, r.NOTE, r.absent) for r in rows] == [("1", None, None), ("3", "something", None)]


def test_valid_and_invalid_file(spark, tmp_path):
    land(tmp_path, "good.xlsx", {"S": [HEADER, ROW]})
    path = land(tmp_path, "bad.XLSX", {"S": [["DELIVERY_DATE", "PRODUCT"], ["2024-09-01", "NEG_001"]]})
    rows = wb.scan_sheets(spark, path)
    sheets = wb.sheet_manifest(rows)
    summary = rc.load_summary(sheets).first()
    assert (summary.files_processed, summary.sheets_loaded, summary.rows_loaded, summary.error_count) == (2, 1, 1, 1)
    (error,) = rc.load_errors(sheets).collect()
    assert error.source_file == "bad.XLSX" and "ENERGY_PRICE_PAYMENT_DIRECTION" in error.error
    loaded, quarantined = cl.route_invalid_sheets(rows)
    assert {r.source_file for r in loaded.collect()} == {"good.xlsx"}
    assert {r.source_file for r in quarantined.collect()} == {"bad.XLSX"}
    with pytest.raises(cl.InvalidSheets, match="bad.XLSX"):
        cl.route_invalid_sheets(rows, all_or_nothing=True)


def test_unreadable_file_is_an_error_and_does_not_stop_the_others(spark, tmp_path):
    land(tmp_path, "a.xlsx", {"S": [HEADER, ROW]})
    land(tmp_path, "blank.xlsx", {"S": "\n"})
    cut = sheet_xml([HEADER, ROW])
    land(tmp_path, "cut.xlsx", {"S": cut[: cut.index("100.0")] + "<v></row></worksheet>"})
    path = land(tmp_path, "b.xlsx", {"S": "no sheet"})
    rows = wb.scan_sheets(spark, path)
    unreadable = wb.unreadable_files(spark, path, rows)
    assert {r.source_file for r in unreadable.collect()} == {"b.xlsx", "blank.xlsx", "cut.xlsx"}
    summary = rc.load_summary(wb.sheet_manifest(rows), unreadable).first()
    assert (summary.files_processed, summary.sheets_loaded, summary.rows_loaded, summary.error_count) == (4, 1, 1, 3)
    assert {r.source_file for r in rc.load_errors(wb.sheet_manifest(rows), unreadable).collect()} == {"b.xlsx", "blank.xlsx", "cut.xlsx"}
    assert wb.to_raw_bids(rows).count() == 1


def test_values_beyond_the_header_are_reported_and_kept(spark, tmp_path):
    path = land(tmp_path, "a.xlsx", {"S": [["A", "B"], [1, 2, "lost?"], [3, 4, ""]]})
    rows = wb.scan_sheets(spark, path)
    assert [r.cells for r in rows.filter("row_no = 2").collect()] == [["1", "2", "lost?"]]
    sheet = wb.sheet_manifest(rows, ["A"]).first()
    assert sheet.beyond_header == 1 and not sheet.is_valid
    assert [r.error for r in rc.load_errors(wb.sheet_manifest(rows, ["A"])).collect()] == ["values beyond the header"]


def test_compressed_sheet(spark, tmp_path):
    path = land(tmp_path, "a.xlsx", {"S": [HEADER, ROW]}, packed=True)
    assert manifest(spark, path)["a.xlsx", "S"].row_count == 1


@pytest.mark.parametrize("places", [False, True])
def test_gaps_blank_rows_and_repeated_names(spark, tmp_path, places):
    rows = [["when", "b", "plain", "when"], ["x", None, 7, None], [None] * 4, [None, None, "", " y "]]
    path = land(tmp_path, "a.xlsx", {"S": rows}, places=places)
    got = wb.to_columns(wb.scan_sheets(spark, path), ["when", "b", "plain", "when_2"]).orderBy("row_no").collect()
    assert [tuple(r)[2:] for r in got] == [(2, "x", None, "7", None), (4, None, None, None, " y ")]


def test_sheet_to_clean_bids(spark, tmp_path):
    rows = [HEADER, ROW, ["2024-09-01", "POS_001", 1, "GRID_TO_PROVIDER", 1, None]]
    raw = wb.to_raw_bids(wb.scan_sheets(spark, land(tmp_path, "a.xlsx", {"S": rows})))
    row = cl.clean_bids(raw).collect()
    assert [(float(r.energy_price_eur_mwh), r.source_file) for r in row] == [(-100.0, "a.xlsx")]


def test_conversion_to_csv(spark, tmp_path):
    land(tmp_path / "in", "a.xlsx", {"S": [HEADER, ROW], "T": [HEADER, ROW, ROW]})
    wb.convert_workbooks(wb.scan_sheets(spark, str(tmp_path / "in")), str(tmp_path / "out"), HEADER)
    rows = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert sorted((r.source_file, r.sheet, r.PRODUCT) for r in rows) == [("a.xlsx", "S", "NEG_001"), ("a.xlsx", "T", "NEG_001"), ("a.xlsx", "T", "NEG_001")]


def test_convert_only_new_files(spark, tmp_path):
    listing = ln.discover_landing_files(spark, land_bytes(tmp_path, a__xlsx=b"1", b__xlsx=b"2"))
    done = listing.filter("file_name = 'a.xlsx'")
    assert [r.file_name for r in wb.not_yet_converted(listing, done).collect()] == ["b.xlsx"]
    newer = done.withColumn("modificationTime", F.expr("modificationTime - INTERVAL 1 DAY"))
    assert wb.not_yet_converted(listing, newer).count() == 2


def test_listing(spark, tmp_path):
    path = land_bytes(tmp_path, b__XLSX=b"12", a__xlsx=b"1", c__csv=b"1")
    assert [(r.file_name, r.length) for r in ln.discover_landing_files(spark, path).collect()] == [("a.xlsx", 1), ("b.XLSX", 2)]


def test_file_name_says_the_period(spark):
    df = spark.createDataFrame(
        [("x/RESULT_LIST_ANONYM_ENERGY_MARKET_aFRR_DE_2024-09-01_2024-09-30.xlsx.zip", dt.date(2024, 10, 1)), ("other.xlsx", dt.date(2024, 10, 1))],
        "source_file string, delivery_date date",
    )
    named = [r.n for r in df.select(ln.file_name_lineage(F.col("source_file")).alias("n")).collect()]
    assert tuple(named[0]) == ("ENERGY", "aFRR", dt.date(2024, 9, 1), dt.date(2024, 9, 30))
    assert named[1].market is None
    assert ln.outside_named_period(df).count() == 1


CSV = "Datum ;Zeitzone;von;bis;50Hertz (Negativ)\n01.09.2024;CEST;00:00;00:15;4,364\n01.09.2024;CEST;00:15;00:30;10,052\n"


def test_activation_csv(spark, tmp_path):
    path = land_bytes(tmp_path, a__csv=CSV.encode())
    raw = dl.scan_activation_csv(spark, path)
    assert raw.columns == ["Datum", "Zeitzone", "von", "bis", "50Hertz (Negativ)", "source_file"]
    rows = cl.to_activations(raw).orderBy("quarter_no").collect()
    assert [(r.quarter_no, float(r.activated_volume_mw), r.source_file) for r in rows] == [
        (1, 4.364, "a.csv"),
        (2, 10.052, "a.csv"),
    ]


def test_delimited_file_checks(spark, tmp_path):
    path = land_bytes(
        tmp_path,
        good__csv=CSV.encode(),
        comma__csv=b"Datum,von,bis\n1,2,3\n",
        tab__csv='Datum\tvon\tbis\t"50Hertz (Negativ)"\n1\t2\t3\tü\n'.encode("latin1"),
        empty__csv=CSV.split("\n")[0].encode(),
        other__dat=CSV.encode(),
    )
    got = {
        r.file_name: (r.sep, r.encoding, r.row_count, r.is_valid)
        for r in dl.validate_delimited_files(spark, path, ACTIVATION_COLUMNS).collect()
    }
    assert got == {
        "good.csv": (";", "utf-8", 2, True),
        "comma.csv": (",", "utf-8", 1, False),
        "tab.csv": ("\t", "latin1", 1, True),
        "empty.csv": (";", "utf-8", 0, False),
        "other.dat": (";", "utf-8", 2, False),
    }


def test_bad_bid_lines_are_set_apart(spark, tmp_path):
    path = land_bytes(tmp_path, a__csv=b"DELIVERY_DATE,PRODUCT\n2024-09-01,NEG_001\n2024-09-01,NEG_002,extra,more\n")
    rows = dl.scan_bid_csv(spark, path, ["DELIVERY_DATE", "PRODUCT"])
    good = rows.filter(F.col(dl.CORRUPT).isNull()).select("PRODUCT").collect()
    bad = rows.filter(F.col(dl.CORRUPT).isNotNull()).select("PRODUCT", dl.CORRUPT).collect()
    assert [r.PRODUCT for r in good] == ["NEG_001"]
    assert [r[dl.CORRUPT] for r in bad] == ["2024-09-01,NEG_002,extra,more"]


def test_columns_are_found_by_name(spark, tmp_path):
    path = land_bytes(tmp_path, a__csv=b"A,B\n1,2\n", b__csv=b"B,A\n20,10\n", c__csv="B\n\u00fc\n".encode("latin1"))
    rows = dl.scan_bid_csv(spark, path, ["A", "B"], encoding="ISO-8859-1")
    assert sorted((r.A or "", r.B, r.source_file) for r in rows.filter(F.col(dl.CORRUPT).isNull()).collect()) == [
        ("", "\u00fc", "c.csv"), ("1", "2", "a.csv"), ("10", "20", "b.csv"),
    ]
    raw = dl.scan_activation_csv(spark, land_bytes(tmp_path / "..", x__csv=b"Datum;von\n\xfc;1\n") + "/x.csv", encoding="ISO-8859-1")
    assert raw.first().Datum == "\u00fc"


def as_xml(spark, path):
    """Row numbers and cells by Spark's XML source alone."""
    raw = spark.read.format("xml").schema(wb.XML_SCHEMA).options(**wb.XML_OPTIONS).load(path)
    values = F.transform("c", lambda c: F.coalesce(c["is"]["t"], c["v"]))
    return raw.select(*wb.SHEET, F.col("_r").alias("row_no"), wb._in_place(F.col("c"), values).alias("cells"), F.col(wb.CORRUPT).alias("corrupt"))


CELLS = "<c><is><t>x</t></is></c>"
SHAPES = {
    "plain": (sheet_xml([["A", "B"], ["a & b <c> \"q\" 'z'", " lead"], [None, 2.5]]), True),
    "places": (sheet_xml([["A", "B", "C"], ["x", None, " y "], [None, None, "&amp;"]], places=True), True),
    "indented": ('<worksheet>\n  <row r="1">\n    <c s="1" t="s">\n      <v>7</v>\n    </c>\n  </row>\n</worksheet>', True),
    "empty": ('<w><row r="1"><c></c><c><v></v></c><c><is><t></t></is></c></row>\n<row r="2"></row></w>', True),
    "comment": (f'<w><row r="1">{CELLS}</row><!-- <row r="2">{CELLS}</row> --></w>', False),
    "section": ('<w><row r="1"><c><v><![CDATA[a</row>b]]></v></c></row></w>', False),
    "blank": ('<w><row r="1"><c><v> </v></c><c><v>\n</v></c></row></w>', False),
    "number": ('<w><row r="1"><c><v>&#65;</v></c></row></w>', False),
    "cut": (f'<w><row r="1">{CELLS}</row><row r="2">{CELLS}', False),
    "closed": (f'<w><row r="1">{CELLS}</row></w><row r="2">{CELLS}</row>', False),
    "alone": (f'<w><row r="1"/><row r="2">{CELLS}</row></w>', False),
}


def test_plain_rows_are_those_of_the_xml_source(spark, tmp_path):
    for name, (text, _) in SHAPES.items():
        land(tmp_path, f"{name}.xlsx", {"S": text})
    path = str(tmp_path)
    text = spark.read.format("text").schema(wb.TEXT_SCHEMA).option("lineSep", wb.ROW_START).load(path)
    odd = [r.path for r in wb._not_plain(text).collect()]
    assert {n for n in SHAPES if not any(f"={n}.xlsx" in p for p in odd)} == {n for n, (_, plain) in SHAPES.items() if plain}
    plain = [str(tmp_path / f"source_file={n}.xlsx") for n, (_, is_plain) in SHAPES.items() if is_plain]
    texts = spark.read.format("text").schema(wb.TEXT_SCHEMA).option("lineSep", wb.ROW_START).option("basePath", path).load(plain)
    order = ["source_file", "row_no"]
    expected = as_xml(spark, path).filter(F.col("source_file").isin([n + ".xlsx" for n, (_, p) in SHAPES.items() if p])).orderBy(*order).collect()
    assert wb._plain_rows(texts).orderBy(*order).collect() == expected


def test_a_large_plain_sheet_is_read_by_several_tasks(spark, tmp_path):
    path = land(tmp_path, "a.xlsx", {"S": [HEADER, *[ROW] * 3000]})
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        rows = wb.scan_sheets(spark, path).filter("cells IS NOT NULL")
        assert rows.count() == 3000 and rows.groupBy(F.spark_partition_id()).count().count() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_landed_sheets_have_no_blanks_between_tags(spark, tmp_path):
    from gridclear.plans.fixture_workbooks import land_sheets

    land_sheets(spark.createDataFrame([("x", None)], "a string, b string"), str(tmp_path / "x"), sheets=1)
    text = "".join(r.value for r in spark.read.text(str(tmp_path / "x")).collect())
    assert "> " not in text and '<row r="1"><c><is><t>a</t></is></c><c><is><t>b</t></is></c></row>' in text


def test_deliveries_that_are_kept_are_compressed(spark, tmp_path, sf_dir):
    from gridclear.plans import file_queries as fq
    from gridclear.plans import market_views as mv

    fq._land_sheet_rows(mv.bid_text(spark, sf_dir), str(tmp_path / "two"), "second")
    files = [p for p in (tmp_path / "two").rglob("part-*")]
    assert files and all(p.name.endswith(".xml.gz") and "source_file=second" in str(p) for p in files)


def test_whole_batches_of_simple_rows_are_cut_as_row_by_row():
    import pyarrow as pa

    texts = ["x", "", " lead", "a &amp; b &lt;c&gt; &quot;q&apos;", "&amp;lt;", "ü € \U0001f600", "1,5", "a\tb\nc", " &amp;"]
    rows = [f' r="{i + 1:03d}">' + "".join(f"<c><is><t>{t}</t></is></c>" for t in (texts[i:] + [t])) + "</row>\n " for i, t in enumerate(texts)]
    odd = [
        f' r="1">{CELLS}</row></w>', f' r="1" spans="1:2">{CELLS}</row>', ' r="2"></row>', ' r="1"><c></c></row>', ' r="1"><c><v>1</v></c></row>',
        ' r="1"><c><is><t> </t></is></c></row>', ' r="1"><c><is><t>&#65;</t></is></c></row>', ' r="1"><c><is><t>\x01</t></is></c></row>',
        ' r="1"><c><is><t>￾</t></is></c></row>', f' r="1">{CELLS}</row><!-- x -->', f' r="1">{CELLS}\n{CELLS}</row>', f' r="1">{CELLS}', "<w>", "",
    ]
    told = wb.is_simple(pa.array([t.encode() for t in rows + odd], pa.binary())).to_pylist()
    assert told == [True] * len(rows) + [False] * len(odd)
    assert all(wb.kind_of(t.encode()) == ("row", None) for t in rows)
    assert [a.to_pylist() for a in wb.simple_cells(pa.array(rows))] == [a.to_pylist() for a in wb.plain_cells(pa.array(rows))]
    assert wb.is_simple(pa.array([rows[0].encode(), b"\xff"], pa.binary())).to_pylist() == [False, False]


def test_simple_rows_of_a_plain_file_are_not_told_one_by_one(spark, tmp_path, monkeypatch):
    """Only the ends of a file, and its header, go through the slow way."""
    def told_slowly(record):
        if record.startswith(b' r="7"'):
            raise AssertionError("a simple row was looked at by itself")
        return kind_of(record)

    kind_of = wb.kind_of
    monkeypatch.setattr(wb, "kind_of", told_slowly)
    path = land(tmp_path, "a.xlsx", {"S": [["A", "B"], *[["x", "y"]] * 20]})
    rows = wb.to_columns(wb.scan_sheets(spark, path), ["A", "B"])
    assert rows.count() == 20 and rows.distinct().count() == 20 and {(r.A, r.B) for r in rows.collect()} == {("x", "y")}


def test_landed_sheets_keep_every_text_and_are_whole(spark, tmp_path):
    from gridclear.plans.fixture_workbooks import land_sheets

    texts = ["a & b", "<c>", '"q" \'z\'', "back\\slash", "a;b", "line\nend", "return\r\nend", "ü", " lead", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string").repartition(2)
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        land_sheets(rows, path, sheets=4, compression=compression)
        found = wb.to_columns(wb.scan_sheets(spark, path), ["n", "t"]).collect()
        assert sorted((int(r.n), r.t) for r in found) == list(enumerate(texts))
        assert {(r.source_file, r.sheet) for r in found} == {(f"book{b}.xlsx", f"S{s}") for b in (0, 1) for s in (0, 1)}
    for text in (r.value for r in spark.read.text(str(tmp_path / "none"), wholetext=True).collect()):
        assert text.startswith("<?xml") and text.count("<worksheet>") == 1 and text.endswith("</worksheet>\n") and "\x00" not in text


def test_many_batches_of_a_sheet_stay_in_order(spark, tmp_path):
    from gridclear.plans.fixture_workbooks import land_sheets

    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(size)
    spark.conf.set(size, "10")
    try:
        land_sheets(spark.range(500).select(F.col("id").cast("string").alias("n")).coalesce(1), str(tmp_path / "x"), sheets=2)
        scanned = wb.to_columns(wb.scan_sheets(spark, str(tmp_path / "x")), ["n"])
        assert sorted(int(r.n) for r in scanned.collect()) == list(range(500))
    finally:
        spark.conf.set(size, usual)
    text = spark.read.format("text").schema(wb.TEXT_SCHEMA).option("lineSep", wb.ROW_START).load(str(tmp_path / "x"))
    assert wb._not_plain(text).count() == 0


def test_wide_jobs_of_an_import_are_compiled(spark, tmp_path, monkeypatch):
    from gridclear.sources import bid_import as bi

    limits = []
    read = bi.read_bids
    monkeypatch.setattr(bi, "read_bids", lambda raw: limits.append(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) or read(raw))
    usual = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    path = land(tmp_path, "a.xlsx", {"S": [HEADER, ROW, ["2024-09-01", "NEG_001", "abc", "GRID_TO_PROVIDER", 1, None]]})
    found = bi.BidImport(spark, wb.scan_sheets(spark, path), ln.read_binary(spark, path, "*", recursive=True).select("path"))
    assert limits == ["8000"] and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == usual
    assert [(r.reason, r["ENERGY_PRICE_[EUR/MWh]"]) for r in found.refused().collect()] == [("unreadable price", "abc")]
    assert found.read.filter("reason IS NULL AND raw IS NOT NULL").count() == 0  # what came is kept of refused bids only


def test_short_numbers_are_those_of_the_wide_way(spark):
    from gridclear.functions import parsing as ps

    texts = ["1", "-1,5", "+0.125", " 7, ", "1.", "999999999999999,999", "1000000000000000", "1,0005", "1e3", ".5", "", " ", "abc", None, "1,2,3", "1\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    short, wide = ps.short_decimal_comma(F.col("t")), ps.decimal_comma(F.col("t"), "decimal(38,12)")
    rows = df.select("t", short.alias("short"), wide.alias("wide")).collect()
    assert {r.t for r in rows if r.short is not None} == {"1", "-1,5", "+0.125", " 7, ", "1.", "999999999999999,999", "1\n"}
    assert all(r.short == r.wide for r in rows if r.short is not None)
