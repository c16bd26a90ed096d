"""Sheets of unpacked workbooks, read by Spark's XML source.

A workbook lands as a folder per sheet, ``source_file=<workbook>/sheet=<name>/``, with the sheet's XML inside, plain or
compressed by gzip: ``row`` elements with their number ``r``, of ``c`` elements that may name their place (``r="B7"``) and
hold a value ``v`` or an inline text ``is/t``.  Rows are read by all tasks.  Files whose rows are all plain, as most programs write
them, are split and cut by patterns; any other file goes through Spark's XML source, which gives the same for plain ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.schema import BIDS_RAW, REQUIRED_BID_COLUMNS, apply_aliases, conform_to_schema
from gridclear.sources.landing import read_binary

CORRUPT = "_corrupt_record"
_CELL = T.StructType(
    [
        T.StructField("_r", T.StringType()),
        T.StructField("is", T.StructType([T.StructField("t", T.StringType())])),
        T.StructField("v", T.StringType()),
    ]
)
XML_SCHEMA = T.StructType(
    [
        T.StructField("_r", T.LongType()),
        T.StructField("c", T.ArrayType(_CELL)),
        T.StructField(CORRUPT, T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("sheet", T.StringType()),
    ]
)
XML_OPTIONS = {"rowTag": "row", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
SHEET = ["source_file", "sheet"]
ROW_START = "<row"
TEXT_SCHEMA = "value string, source_file string, sheet string"
_GAP = r"[ \t\r\n]*+"
# A text is empty or has a character that is no white space; characters that XML forbids or changes are left to its parser.
_CHARACTER = r"[^<>&\r\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\uD800-\uDFFF\uFFFD-\uFFFF]"
_TEXT = rf"(?:(?=[ \t\n]*+[^ \t\n<]){_CHARACTER}*+(?:&(?:amp|lt|gt|quot|apos);{_CHARACTER}*+)*+)?"
_PLAIN_CELL = (
    rf'<c(?: r="[A-Z]{{1,3}}[0-9]{{1,9}}")?(?: s="[0-9]+")?(?: t="[A-Za-z]+")?>{_GAP}'
    rf"(?:<is>{_GAP}<t>{_TEXT}</t>{_GAP}</is>|<v>{_TEXT}</v>)?{_GAP}</c>{_GAP}"
)
PLAIN_ROW = re.compile(rf' r="[0-9]{{1,18}}"(?: spans="[0-9:]*")?>{_GAP}(?:<c><is><t>{_TEXT}</t></is></c>|{_PLAIN_CELL})*+</row>{_GAP}((?:</[A-Za-z]+>{_GAP})*)')
_OPEN = r'<[A-Za-z]+(?: xmlns="[^"<>&]*")?>'
PLAIN_BEGINNING = re.compile(
    rf'(?:<\?xml version="1\.0"(?: encoding="UTF-8")?(?: standalone="(?:yes|no)")?\?>)?{_GAP}'
    rf'(?:{_OPEN}{_GAP})+(?:<dimension ref="[A-Z0-9:]+"/>{_GAP})?(?:{_OPEN}{_GAP})*'
)
OPENED, CLOSED = re.compile(r"<([A-Za-z]+)(?: xmlns=[^<>]*)?>"), re.compile(r"</([A-Za-z]+)>")
CELL = re.compile(rf'<c(?: r="([A-Z]+)[0-9]+")?[^>]*>{_GAP}(?:(<is>{_GAP}<t>|<v>)([^<]*))?')
# Rows whose cells are all a bare inline text, a part of the plain ones, as RE2 spells it: whole batches of them are told and cut at once.
_SIMPLE_CHARACTER = r"[^<>&\r\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}\x{FFFD}-\x{FFFF}]"
_SIMPLE_FILLED = _SIMPLE_CHARACTER.replace("<>&", r"<>& \t\n")
_ENTITY = "&(?:amp|lt|gt|quot|apos);"
_SIMPLE_TEXT = rf"(?:[ \t\n]*(?:{_SIMPLE_FILLED}|{_ENTITY})(?:{_SIMPLE_CHARACTER}|{_ENTITY})*)?"
FIRST_CELL, NEXT_CELL, LAST_CELL = '"><c><is><t>', "</t></is></c><c><is><t>", "</t></is></c></row>"
SIMPLE_ROW = rf'\A r="[0-9]{{1,18}}{FIRST_CELL}{_SIMPLE_TEXT}(?:{NEXT_CELL}{_SIMPLE_TEXT})*{LAST_CELL}[ \t\r\n]*\z'
FIRST_ROW, NUMBER_ONE = r'\A r="0*1"', re.compile(rb' r="0*1"')
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}  # the last one last


def scan_sheets(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame:
    """Rows of every sheet as text: ``source_file, sheet, row_no, header, cells, corrupt``.

    Row 1 is the header; it comes with NULL cells, so that empty sheets are known too.  Rows without any value are left out.
    A row that is no XML has only its text, in ``corrupt``.
    """
    raw = spark.read.format("xml").schema(XML_SCHEMA).options(**XML_OPTIONS)
    text = spark.read.format("text").schema(TEXT_SCHEMA).option("lineSep", ROW_START)
    raw, text = ((r.option("basePath", base) if base else r).load(list(paths)) for r in (raw, text))
    path = F.col("_metadata.file_path")
    odd, headers = _told(spark, text)
    rows = _plain_rows(text.filter(~path.isin(odd)) if odd else text)
    if odd:
        value = F.transform("c", lambda c: F.coalesce(c["is"]["t"], c["v"]))
        parsed = raw.filter(path.isin(odd)).select(*SHEET, F.col("_r").alias("row_no"), _in_place(F.col("c"), value).alias("cells"), F.col(CORRUPT).alias("corrupt"))
        rows = rows.unionByName(parsed)
        headers = headers.unionByName(parsed.filter("row_no = 1 AND corrupt IS NULL").select(*SHEET, "cells"))
    headers = headers.groupBy(*SHEET).agg(_unique(F.first("cells")).alias("header"))
    filled = F.array_join("cells", "") != ""
    data = rows.filter(F.col("corrupt").isNotNull() | ((F.col("row_no") > 1) & filled)).join(F.broadcast(headers), SHEET, "left")
    columns = [*SHEET, "row_no", "header", "cells", "corrupt"]
    nothing = {"row_no": F.lit(0).cast("long"), "cells": F.lit(None).cast("array<string>"), "corrupt": F.lit(None).cast("string")}
    return headers.withColumns(nothing).select(*columns).unionByName(data.select(*columns))


def _told(spark: SparkSession, text: DataFrame) -> tuple[list[str], DataFrame]:
    """Names of files that are not plain, and ``source_file, sheet, cells`` of a row 1 of each sheet among the others, by one pass over all."""
    plain = F.col("is_plain")
    of_plain = [F.when(plain, F.col(c)).alias(c) for c in SHEET]
    told = _files(text).select(F.when(~plain, F.col("path")).alias("odd"), *of_plain, F.when(plain, F.col("header")).alias("header"))
    found = told.groupBy("odd", *SHEET).agg(F.first("header", ignorenulls=True).alias("header")).collect()  # a row per sheet or odd file
    headers = [{**{c: r[c] for c in SHEET}, "cells": cells_of(r["header"])} for r in found if r["header"] is not None]
    kind = pa.schema([*((c, pa.string()) for c in SHEET), ("cells", pa.list_(pa.string()))])
    return [r["odd"] for r in found if r["odd"] is not None], spark.createDataFrame(pa.Table.from_pylist(headers, kind))


def _not_plain(text: DataFrame) -> DataFrame:
    """Files (path) with a row, or anything around the rows, of a shape not known here."""
    return _files(text).filter("NOT is_plain").select("path")


def _files(text: DataFrame) -> DataFrame:
    """``path, source_file, sheet, is_plain, header``: whether a file has rows of known shapes and nothing else, and its first row of number 1 as text.

    A record is the text from one ``<row`` to the next.  In a plain file the first one opens elements, each other one is a whole row, and the last
    one closes those elements too.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            simple = is_simple(batch.column("value"))
            # Of simple rows only the first and the last of a run matter, as the first and last record of a file.
            first = pc.match_substring_regex(batch.column("value"), FIRST_ROW)
            batch = batch.filter(pc.or_(pc.or_(pc.invert(simple), first), run_ends(batch, ["path", "block"])))
            values = batch.column("value").to_pylist()
            told = [kind_of(value) for value in values]
            kinds, tags = (pa.array([t[k] for t in told], pa.string()) for k in (0, 1))
            headers = [v.decode() if t[0] in ("row", "end") and NUMBER_ONE.match(v) else None for v, t in zip(values, told)]
            found = [*(batch.column(c) for c in names), kinds, tags, pa.array(headers, pa.string())]
            yield pa.RecordBatch.from_arrays(found, [*names, "kind", "tags", "header"])

    place, names = F.struct("block", "at"), ["path", *SHEET, "block", "at"]
    records = text.select(
        *SHEET,
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("value"),
    )
    kinds = "path string, source_file string, sheet string, block long, at long, kind string, tags string, header string"
    per_file = records.select(*names, "value").mapInArrow(run, kinds).groupBy("path", *SHEET).agg(
        F.count_if(F.col("kind") == "strange").alias("strange"),
        F.count_if(F.col("kind") == "beginning").alias("beginnings"),
        F.count_if(F.col("kind") == "end").alias("ends"),
        F.min_by(F.struct("kind", "tags"), place).alias("first"),
        F.max_by(F.struct("kind", "tags"), place).alias("last"),
        F.min_by("header", F.when(F.col("header").isNotNull(), place)).alias("header"),
    )
    plain = "strange = 0 AND beginnings = 1 AND ends = 1 AND first.kind = 'beginning' AND last.kind = 'end' AND first.tags = last.tags"
    return per_file.select("path", *SHEET, F.expr(f"coalesce({plain}, false)").alias("is_plain"), "header")


def is_simple(records: pa.Array) -> pa.Array:
    """Whether each record is a simple row, with nothing behind it."""
    try:
        return pc.match_substring_regex(records.cast(pa.string()), SIMPLE_ROW)
    except pa.ArrowInvalid:  # no UTF-8: each record is looked at by itself
        return pa.array(np.zeros(len(records), dtype=bool))


def run_ends(batch: pa.RecordBatch, names: list[str]) -> pa.Array:
    """Whether each row is the first or the last of a run of rows that agree in the named columns."""
    n = batch.num_rows
    changes = np.zeros(max(n - 1, 0), dtype=bool)
    for name in names:
        column = batch.column(name)
        changes |= pc.not_equal(column.slice(1), column.slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
    edge = np.ones(min(n, 1), dtype=bool)
    return pa.array(np.concatenate([edge, changes]) | np.concatenate([changes, edge]))


def kind_of(record: bytes) -> tuple[str, str | None]:
    """What a record is, and the tags that it opens or, from the outermost one, closes."""
    text = record.decode("utf-8", "replace")
    row = PLAIN_ROW.fullmatch(text)
    if row:
        if '<c r="' in text:
            places = [place for place, _, _ in CELL.findall(text)]
            if all(places) and len(set(places)) < len(places):
                return "strange", None
        return ("end", " ".join(CLOSED.findall(row[1])[::-1])) if row[1] else ("row", None)
    if PLAIN_BEGINNING.fullmatch(text):
        return "beginning", " ".join(OPENED.findall(text))
    return "strange", None


def _plain_rows(text: DataFrame) -> DataFrame:
    """``source_file, sheet, row_no, cells, corrupt`` of files whose records are all plain."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            simple = is_simple(batch.column("value"))
            for rows, cut in ((batch.filter(simple), simple_cells), (batch.filter(pc.invert(simple)), plain_cells)):
                if rows.num_rows:
                    found = [*(rows.column(c) for c in SHEET), *cut(rows.column("value"))]
                    yield pa.RecordBatch.from_arrays(found, [*SHEET, "row_no", "cells"])

    rows = text.filter(F.startswith("value", F.lit(" r="))).select(*SHEET, "value")
    found = rows.mapInArrow(run, "source_file string, sheet string, row_no long, cells array<string>")
    return found.withColumn("corrupt", F.lit(None).cast("string"))


def simple_cells(rows: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Numbers and values of simple rows."""
    pieces = pc.split_pattern(pc.replace_substring(pc.replace_substring(rows, FIRST_CELL, NEXT_CELL), LAST_CELL, NEXT_CELL), NEXT_CELL)
    ends, texts = pieces.offsets.to_numpy(), pieces.values
    numbers = pc.cast(pc.utf8_slice_codeunits(texts.take(pa.array(ends[:-1])), 4), pa.int64())  # the first piece: r="7
    cell = np.ones(len(texts), dtype=bool)
    cell[ends[:-1]] = cell[ends[1:] - 1] = False
    values = texts.filter(pa.array(cell))
    if pc.any(pc.match_substring(values, "&")).as_py():
        for entity, character in ENTITIES.items():
            values = pc.replace_substring(values, entity, character)
    return numbers, pa.ListArray.from_arrays(pa.array(ends - 2 * np.arange(len(ends), dtype=ends.dtype)), values)


def plain_cells(rows: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Numbers and values of plain rows of any shape."""
    values = rows.to_pylist()
    numbers = pa.array([int(v[4 : v.index('"', 4)]) for v in values], pa.int64())
    return numbers, pa.array(list(map(cells_of, values)), pa.list_(pa.string()))


def cells_of(row: str) -> list[str | None] | None:
    """Values of a plain row, as by ``_in_place``; None if it has no cells."""
    found = CELL.findall(row)
    if not found:
        return None
    values = [text if tag else None for _, tag, text in found]
    if "&" in row:
        values = [v and unescaped(v) for v in values]
    if '<c r="' not in row or not all(place for place, _, _ in found):
        return values
    places = [column_no(place) for place, _, _ in found]
    named = [None] * max(places)
    for place, value in zip(places, values):
        named[place - 1] = value
    return named


def unescaped(text: str) -> str:
    for entity, character in ENTITIES.items():
        text = text.replace(entity, character)
    return text


def column_no(letters: str) -> int:
    """Place of a column from 1: ``B`` is the second."""
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - 64
    return number


def _in_place(cells: Column, values: Column) -> Column:
    """Values at the places their cells name (``B7`` is the second), else in the order they come."""
    letters = F.transform(cells, lambda c: F.split(F.regexp_extract(c["_r"], "^[A-Z]+", 0), ""))
    places = F.transform(
        letters, lambda chars: F.aggregate(F.filter(chars, lambda x: x != ""), F.lit(0), lambda n, x: n * 26 + F.ascii(x) - 64)
    )
    by_place = F.map_from_arrays(places, values)
    named = F.transform(F.sequence(F.lit(1), F.array_max(places)), lambda k: F.try_element_at(by_place, k))
    return F.when(F.forall(cells, lambda c: c["_r"].isNotNull()) & (F.size(cells) > 0), named).otherwise(values)


def _unique(header: Column) -> Column:
    """A name that occurs again gets its count: ``when``, ``when_2``."""

    def told_apart(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(header, F.lit(1), i), lambda x: x == name))
        return F.when(before > 0, F.concat(name, F.lit("_"), (before + 1).cast("string"))).otherwise(name)

    return F.transform(F.transform(header, lambda h: F.coalesce(F.trim(h), F.lit(""))), told_apart)


def unreadable_files(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``unreadable_sheets`` of all files in the folder; Spark does not list files of no bytes."""
    return unreadable_sheets(read_binary(spark, path, "*", recursive=True).select("path"), rows)


def unreadable_sheets(files: DataFrame, rows: DataFrame) -> DataFrame:
    """(source_file, sheet, error) of sheets among ``files`` (path) of which no header or not all rows could be read.

    ``rows`` are those of the scan, corrupt ones included.
    """
    part = [F.url_decode(F.regexp_extract("path", f"/{c}=([^/]*)/", 1)).alias(c) for c in SHEET]
    state = rows.groupBy(*SHEET).agg(F.count_if(F.col("header").isNotNull()).alias("read"), F.count("corrupt").alias("corrupt"))
    found = files.select(*part).distinct().join(state, SHEET, "left").filter("coalesce(read, 0) = 0 OR corrupt > 0")
    error = F.when(F.coalesce("read", F.lit(0)) == 0, "no header row").otherwise(F.concat(F.col("corrupt").cast("string"), F.lit(" unreadable rows")))
    return found.select(*SHEET, error.alias("error"))


def sheet_manifest(rows: DataFrame, required: list[str] = REQUIRED_BID_COLUMNS) -> DataFrame:
    """Per sheet: its columns, rows, rows with values beyond the header, missing required columns, and whether it can be loaded.

    A last column without any value is not counted as a column.
    """
    good = rows.filter("header IS NOT NULL AND corrupt IS NULL")
    last_filled = F.count_if(F.coalesce(F.get("cells", F.size("header") - 1), F.lit("")) != "")
    rest = F.slice("cells", F.size("header") + 1, F.greatest(F.size("cells"), F.lit(0)))
    beyond = F.when(F.size("cells") > F.size("header"), F.array_join(rest, "") != "")
    per_sheet = good.groupBy(*SHEET, "header").agg(
        F.count("cells").alias("row_count"), last_filled.alias("last_filled"), F.count_if(beyond).alias("beyond_header")
    )
    shown = F.when(F.col("last_filled") > 0, F.col("header")).otherwise(F.slice("header", 1, F.size("header") - 1))
    absent = F.array_except(F.array(*[F.lit(c) for c in required]), F.col("header"))
    return per_sheet.select(
        *SHEET,
        shown.alias("header"),
        "row_count",
        "beyond_header",
        absent.alias("missing_columns"),
        ((F.size(absent) == 0) & (F.col("beyond_header") == 0)).alias("is_valid"),
    )


def to_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """The named columns of sheet rows, NULL where a sheet lacks one; sheets are appended by column name."""
    data = rows.filter(F.col("cells").isNotNull())
    position = {n: F.array_position("header", n).cast("int") for n in names}
    value = {n: F.when(p > 0, F.nullif(F.get("cells", p - 1), F.lit(""))) for n, p in position.items()}
    return data.select(*SHEET, "row_no", *[v.alias(n) for n, v in value.items()])


def to_raw_bids(rows: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Sheet rows in the raw bid schema with file, sheet and load time."""
    wanted = names or [f.name for f in BIDS_RAW.fields if f.name not in SHEET]
    named = conform_to_schema(apply_aliases(to_columns(rows, wanted)), BIDS_RAW)
    return named.withColumn("load_timestamp", F.current_timestamp())


def convert_workbooks(rows: DataFrame, path: str, names: list[str]) -> None:
    """Sheet rows as CSV with a header, one folder per file and sheet."""
    named = to_columns(rows, names).drop("row_no")
    named.write.mode("append").partitionBy(*SHEET).option("header", True).csv(path)


def not_yet_converted(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are new, or newer than their last conversion."""
    done = manifest.select("path", "modificationTime")
    return listing.join(done, ["path", "modificationTime"], "left_anti")
