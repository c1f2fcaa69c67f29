"""Tabular sources: text and typed CSV (C1, C3), header-only scans (C2), workbooks (C4) and
sheet ranges (C15).

CSV goes through Spark's own reader. A workbook (.xlsx) is a zip of XML parts; it is read
with ``binaryFile`` + ``mapInPandas`` (one file per task, standard library only), yielding
one row per sheet row: (path, sheet, sheet_no, row_no, cells array<string>).
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted extensions of the typed scan, and the default sheet range.
TYPED_EXTENSIONS = (".csv", ".xlsx")
DEFAULT_RANGE = "A1:Z1000"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}

SHEET_ROWS_SCHEMA = "path string, sheet string, sheet_no int, row_no int, cells array<string>"


class TabularError(ValueError):
    pass


def check_extension(path: str) -> str:
    """The extension must be exactly .csv or .xlsx."""
    ext = posixpath.splitext(path)[1]
    if ext not in TYPED_EXTENSIONS:
        raise TabularError(f"Unsupported file extension: {ext or '(none)'}")
    return ext


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every cell as text (no inference), RFC doubled quotes, quoted newlines; an empty cell is ''."""
    df = (spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
          .option("multiLine", True).option("encoding", "UTF-8").csv(path))
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Types inferred (a scan of the data; declare a schema instead for large inputs)."""
    check_extension(path)
    return (spark.read.option("header", True).option("inferSchema", True).option("escape", '"')
            .option("multiLine", True).csv(path))


def csv_headers(spark: SparkSession, path: str) -> list:
    """Column names of one CSV (the reader only looks at the header without inference)."""
    return read_text_csv(spark, path).columns


def headers_table(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """C2 over many files: (path, position, column) from the first line of each CSV.

    ``manifest`` has a ``path`` column; each task opens its files and reads one line.
    """
    from .blobs import read_first_line

    def first_lines(batches):
        import csv
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                header = next(csv.reader([read_first_line(p)]), [])
                rows += [(p, i, c) for i, c in enumerate(header)]
            yield pd.DataFrame(rows, columns=["path", "position", "column"])

    return manifest.select("path").mapInPandas(first_lines, "path string, position int, column string")


# --- workbooks ------------------------------------------------------------------------------

def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def parse_xlsx(content: bytes) -> list:
    """[(sheet name, [(row_no, [cell text...]), ...]), ...] in workbook order. Values are the
    stored text (shared or inline strings, numbers as written); missing cells are ''."""
    zf = zipfile.ZipFile(io.BytesIO(content))
    names = set(zf.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
        for si in root.findall("m:si", _NS):
            shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
    rels = {}
    if "xl/_rels/workbook.xml.rels" in names:
        for r in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels")).findall("pr:Relationship", _NS):
            target = r.get("Target")
            rels[r.get("Id")] = target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    out = []
    for sh in wb.find("m:sheets", _NS).findall("m:sheet", _NS):
        part = rels.get(sh.get(f"{{{_NS['r']}}}id"))
        rows = []
        if part and part in names:
            for row in ET.fromstring(zf.read(part)).iter(f"{{{_NS['m']}}}row"):
                cells: dict = {}
                for pos, c in enumerate(row.findall("m:c", _NS)):
                    ref = c.get("r")
                    idx = _col_index(ref) if ref else pos
                    t = c.get("t")
                    if t == "inlineStr":
                        val = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
                    else:
                        v = c.find("m:v", _NS)
                        val = v.text if v is not None and v.text is not None else ""
                        if t == "s" and val != "":
                            val = shared[int(val)]
                    cells[idx] = val
                width = max(cells) + 1 if cells else 0
                rows.append((int(row.get("r") or (rows[-1][0] + 1 if rows else 1)), [cells.get(i, "") for i in range(width)]))
        out.append((sh.get("name"), rows))
    return out


def _cell_ref(col: int, row: int) -> str:
    s = ""
    col += 1
    while col:
        col, rem = divmod(col - 1, 26)
        s = chr(65 + rem) + s
    return f"{s}{row}"


def build_xlsx(sheets: list) -> bytes:
    """A minimal workbook: ``sheets`` = [(name, [[cell text, ...], ...]), ...], inline strings."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        ct = ['<?xml version="1.0" encoding="UTF-8"?>',
              '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">',
              '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>',
              '<Default Extension="xml" ContentType="application/xml"/>',
              '<Override PartName="/xl/workbook.xml" ContentType="application/'
              'vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>']
        ct += [f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/'
               f'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(sheets))]
        ct.append("</Types>")
        zf.writestr("[Content_Types].xml", "".join(ct))
        zf.writestr("_rels/.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="'
                    + _NS["pr"] + '"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/'
                    'officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        wb = ['<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="' + _NS["m"] + '" xmlns:r="' + _NS["r"]
              + '"><sheets>']
        rel = ['<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="' + _NS["pr"] + '">']
        for i, (name, rows) in enumerate(sheets):
            wb.append(f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="rId{i + 1}"/>')
            rel.append(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/'
                       f'2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>')
            xml = ['<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="' + _NS["m"] + '"><sheetData>']
            for r, cells in enumerate(rows, start=1):
                xml.append(f'<row r="{r}">')
                for c, val in enumerate(cells):
                    if val is None or val == "":
                        continue
                    xml.append(f'<c r="{_cell_ref(c, r)}" t="inlineStr"><is><t xml:space="preserve">'
                               f"{escape(str(val))}</t></is></c>")
                xml.append("</row>")
            xml.append("</sheetData></worksheet>")
            zf.writestr(f"xl/worksheets/sheet{i + 1}.xml", "".join(xml))
        wb.append("</sheets></workbook>")
        rel.append("</Relationships>")
        zf.writestr("xl/workbook.xml", "".join(wb))
        zf.writestr("xl/_rels/workbook.xml.rels", "".join(rel))
    return buf.getvalue()


def read_workbooks(spark: SparkSession, path: str, glob: str = "*.xlsx", recursive: bool = True) -> DataFrame:
    """C4: every sheet row of every workbook under ``path``."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", recursive).load(path).select("path", "content"))
    return workbook_rows(files)


def workbook_rows(files: DataFrame) -> DataFrame:
    def explode_books(batches):
        for pdf in batches:
            out = []
            for p, content in zip(pdf["path"], pdf["content"]):
                for sheet_no, (name, rows) in enumerate(parse_xlsx(bytes(content))):
                    out += [(p, name, sheet_no, r, cells) for r, cells in rows]
            yield pd.DataFrame(out, columns=["path", "sheet", "sheet_no", "row_no", "cells"])

    return files.mapInPandas(explode_books, SHEET_ROWS_SCHEMA)


def parse_range(a1: str = DEFAULT_RANGE) -> tuple:
    """'B2:D10' → (first col 0-based, last col, first row 1-based, last row)."""
    m = re.fullmatch(r"([A-Z]+)(\d+):([A-Z]+)(\d+)", a1.strip().upper())
    if not m:
        raise TabularError(f"Invalid range: {a1}")
    return _col_index(m.group(1)), _col_index(m.group(3)), int(m.group(2)), int(m.group(4))


def sheet_range(rows: DataFrame, a1: str = DEFAULT_RANGE) -> DataFrame:
    """The rectangle of a sheet; rows stay ragged; ``line`` = cells joined by ', '."""
    c0, c1, r0, r1 = parse_range(a1)
    cells = F.slice("cells", c0 + 1, c1 - c0 + 1)
    return (rows.filter(F.col("row_no").between(r0, r1))
            .withColumn("cells", cells)
            .withColumn("line", F.array_join("cells", ", ")))


def cells_as_columns(rows: DataFrame, header: list) -> DataFrame:
    """Sheet rows → one text column per header name (missing cells null)."""
    return rows.select("path", "sheet", "row_no",
                       *[F.element_at(F.col("cells"), i + 1).alias(h) for i, h in enumerate(header)])
