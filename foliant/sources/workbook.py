"""Workbooks: small tables as the sheets of an XLSX file, made with the standard library alone."""
from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from foliant.sources.sinks import csv_cell, write_bytes

MOST_ROWS = 1_048_575  #: rows that a sheet of this format can hold below its header
WIDEST = 60  #: characters
EMPTY = "(no data)"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def column_name(i: int) -> str:
    """A, B, ..., Z, AA, ... of 0, 1, ..."""
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


def _text(value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "True" if value else "False"
    if isinstance(value, (list, tuple)):
        return "; ".join(map(_text, value))
    return "".join(c for c in str(value) if c in "\t\n\r" or c >= " ")[:32_767]  # what a cell can hold


def _cell(value, at: str, style: int) -> str:
    if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value and abs(value) != float("inf"):
        return f'<c r="{at}" s="{style}"><v>{value}</v></c>'
    return f'<c r="{at}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{escape(_text(value))}</t></is></c>'


def _sheet(columns: list[str], rows: Iterable[tuple], longest: list[int], count: int) -> Iterator[str]:
    """The parts of a sheet's text, row by row as `rows` gives them; longest: the longest cell of each column."""
    widths = [min(WIDEST, max(len(c), w)) + 2 for c, w in zip(columns, longest, strict=True)]
    last = f"{column_name(len(columns) - 1)}{count + 1}"
    yield f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>'
    yield "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1))
    yield '</cols><sheetData><row r="1">' + "".join(_cell(c, f"{column_name(i)}1", 1) for i, c in enumerate(columns)) + "</row>"
    for n, row in enumerate(rows, 2):
        yield f'<row r="{n}">' + "".join(_cell(v, f"{column_name(i)}{n}", 0) for i, v in enumerate(row)) + "</row>"
    yield f'</sheetData><autoFilter ref="A1:{last}"/></worksheet>'


def workbook_bytes(sheets: list[tuple[str, list[str], Iterable[tuple], list[int], int]]) -> bytes:
    """An XLSX file of (name, columns, rows, longest cells, count): bold header rows that stay in view and filter, columns
    as wide as their longest cell, up to WIDEST. Rows are packed as they come; only the packed file is held."""
    numbers = range(1, len(sheets) + 1)
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in numbers)
    listed = "".join(f'<sheet name={quoteattr(name[:31])} sheetId="{i}" r:id="r{i}"/>' for i, (name, *_) in zip(numbers, sheets, strict=True))
    links = "".join(f'<Relationship Id="r{i}" Type="{_RELATIONS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
    files = {
        "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{parts}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_RELATIONS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELATIONS}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{links}<Relationship Id="r0" Type="{_RELATIONS}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for path, body in files.items():
            z.writestr(path, _HEAD + body)
        for i, (_, *sheet) in zip(numbers, sheets, strict=True):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as entry:
                for text in _sheet(*sheet):
                    entry.write(text.encode())
    return out.getvalue()


def _measured(df: DataFrame) -> list[int]:
    """The number of rows, and the length of the longest cell of each column."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    kind = lambda t: "string" if isinstance(t, ArrayType) and not isinstance(t.elementType, StringType) else t.typeName()
    cells = [csv_cell(F.col(f.name).cast("string") if kind(f.dataType) == "string" else F.col(f.name), kind(f.dataType)) for f in plain.schema]
    count, *longest = plain.agg(F.count("*"), *[F.coalesce(F.max(F.length(c)), F.lit(0)) for c in cells]).first()
    return [count, *longest]


def write_workbook(tables: dict[str, DataFrame], path: str, spark: SparkSession) -> None:
    """Tables as the sheets of one workbook. The format holds MOST_ROWS rows a sheet: a larger table is an error, not cut
    off, and is found by counting before any row comes to the driver; rows then come a partition at a time. An empty
    table has the placeholder."""
    sheets = []
    for name, df in tables.items():
        count, *longest = _measured(df)
        if count > MOST_ROWS:
            raise ValueError(f"{name}: more rows than a sheet holds")
        sheets.append((name, df.columns, map(tuple, df.toLocalIterator()), longest, count) if count else (name, ["note"], [(EMPTY,)], [len(EMPTY)], 1))
    write_bytes(workbook_bytes(sheets), path, spark)


def read_workbook(content: bytes) -> dict[str, list[list[str]]]:
    """The cells of each sheet as text, header rows first."""
    ns = {"m": _MAIN}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iterfind("m:sheets/m:sheet", ns)]
        out = {}
        for i, name in enumerate(names, 1):
            rows = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{i}.xml")).iterfind("m:sheetData/m:row", ns)
            out[name] = [["".join(c.itertext()) for c in row.iterfind("m:c", ns)] for row in rows]
    return out
