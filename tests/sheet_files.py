"""Unpacked workbooks written as files, for tests."""

from __future__ import annotations

import gzip
from pathlib import Path
from xml.sax.saxutils import escape


def sheet_xml(rows: list[list], places: bool = False) -> str:
    lines = []
    for r, row in enumerate(rows, 1):
        cells = []
        for k, value in enumerate(row):
            at = f' r="{chr(65 + k)}{r}"' if places else ""
            if value is None and places:
                continue
            text = "" if value is None else escape(str(value))
            cells.append(f"<c{at}><v>{text}</v></c>" if isinstance(value, (int, float)) else f"<c{at}><is><t>{text}</t></is></c>")
        lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    return f"<worksheet><sheetData>\n{chr(10).join(lines)}\n</sheetData></worksheet>"


def land(folder: Path, book: str, sheets: dict[str, list[list] | str], packed: bool = False, places: bool = False) -> str:
    """Sheets of a workbook; text in place of rows becomes the file's content as it is."""
    for name, rows in sheets.items():
        place = folder / f"source_file={book}" / f"sheet={name}"
        place.mkdir(parents=True, exist_ok=True)
        text = rows if isinstance(rows, str) else sheet_xml(rows, places)
        if packed:
            (place / "sheet.xml.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (place / "sheet.xml").write_text(text)
    return str(folder)
