"""Sheets of workbooks written as XML, as input for the sheet reader."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclear.schema import quoted
from gridclear.session import compiled_in_parts

OPENING = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet>'
CLOSING = "</worksheet>"
ESCAPES = {"&": "&amp;", "<": "&lt;", ">": "&gt;", "\r": "&#13;", "\n": "&#10;"}  # the first one first
# One column of text without line ends, as it is: the CSV source is the one whose files may be named .xml.
AS_IT_IS = {"extension": "xml", "sep": "\x01", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
FAST = {"zlib.compress.level": "BEST_SPEED"}


def land_sheets(df: DataFrame, path: str, prefix: str = "book", sheets: int = 8, compression: str = "none") -> None:
    """All rows of ``df`` as unpacked workbooks of two sheets each, every sheet with a header row."""
    cells = [f"c{i}" for i in range(len(df.columns))]
    numbered = df.withColumn("_id", F.monotonically_increasing_id())
    data = numbered.select(
        (F.col("_id") + 2).alias("r"),
        F.pmod("_id", F.lit(sheets)).alias("no"),
        *[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(cell) for c, cell in zip(df.columns, cells)],
    )
    header = df.sparkSession.range(sheets).select(
        F.lit(1).cast("long").alias("r"), F.col("id").alias("no"), *[F.lit(c).alias(cell) for c, cell in zip(df.columns, cells)]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a task as a text per sheet and batch; every sheet's text opens and closes the worksheet, as it becomes a file."""
        begun, part = set(), 0
        for batch in batches:
            rows, numbers = row_texts(batch, cells), batch.column("no")
            for no in pc.unique(numbers).to_pylist():
                text = joined(rows.filter(pc.equal(numbers, no)))
                yield piece(no, part, text if no in begun else OPENING + text)
                begun.add(no)
            part += 1
        for no in sorted(begun):
            yield piece(no, part, CLOSING)

    texts = header.unionByName(data).mapInArrow(run, "no long, part long, xml string")
    book = F.concat(F.lit(prefix), F.floor(F.col("no") / 2).cast("string"), F.lit(".xlsx"))
    sheet = F.concat(F.lit("S"), F.pmod("no", F.lit(2)).cast("string"))
    # Columns that cannot be null keep their order in the writer, and so the pieces of a file theirs.
    named = texts.select("xml", "part", *[F.coalesce(c, F.lit("")).alias(name) for c, name in ((book, "source_file"), (sheet, "sheet"))])
    placed = named.sortWithinPartitions("source_file", "sheet", "part").select("xml", "source_file", "sheet")
    with compiled_in_parts(df.sparkSession):
        placed.write.mode("append").partitionBy("source_file", "sheet").options(compression=compression, **AS_IT_IS, **FAST).csv(path)


def row_texts(batch: pa.RecordBatch, cells: list[str]) -> pa.Array:
    """Rows as XML: number ``r`` and the texts of ``cells``."""
    parts: list = ['<row r="', pc.cast(batch.column("r"), pa.string()), '">']
    for name in cells:
        parts += ["<c><is><t>", escaped(batch.column(name)), "</t></is></c>"]
    return pc.binary_join_element_wise(*parts, "</row>", "")


def escaped(texts: pa.Array) -> pa.Array:
    for character, entity in ESCAPES.items():
        if pc.any(pc.match_substring(texts, character)).as_py():
            texts = pc.replace_substring(texts, character, entity)
    return texts


def joined(rows: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays([0, len(rows)], rows), "")[0].as_py()


def piece(no: int, part: int, xml: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"no": [no], "part": [part], "xml": [xml]}, pa.schema([("no", pa.int64()), ("part", pa.int64()), ("xml", pa.string())]))


def land_broken_file(spark, path: str, name: str = "broken.xlsx") -> None:
    """A file in the place of a sheet that holds no sheet."""
    spark.createDataFrame([("this is no sheet",)], "value string").coalesce(1).write.mode("append").text(
        f"{path}/source_file={name}/sheet=S0"
    )
