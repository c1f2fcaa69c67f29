"""Quoted CSV read by many tasks, however large one file is.

A line end inside quotes is no record end, so a block of bytes can't tell by itself where its records start.
First, every block reports the parity of its quotes and its first line end under either state (inside or
outside quotes at its start). The parities, summed up in file order, say which state holds, hence where the
first record after each block's start begins. Then every block's records are parsed from there to where the
next block's begin; nothing is shuffled but one small row a block.

This holds for files that quote as RFC 4180 says (a quote only around a cell, doubled inside). A file whose
quotes don't pair up is parsed by one task, in a stream.
"""

from __future__ import annotations

import csv
import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .blobs import _fs
from .files import directory_manifest

BLOCK_BYTES = 32 << 20  # bytes of a block; a task reads it in pieces
PIECE = 1 << 20
BATCH_BYTES = 8 << 20  # cells of one batch of rows that leaves a task
MAX_TASKS = 100_000
BOM = b"\xef\xbb\xbf"

SCAN_SCHEMA = ("path string, size long, block long, odd boolean, cut_outside long, cut_inside long, header array<string>")


class CsvError(ValueError):
    pass


def unique_names(cells: list[str]) -> list[str]:
    """Column names of a header row: a blank one is ``_c<i>``, one that was there before (case ignored) gets its place as suffix."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = cell or f"_c{i}"
        while name.lower() in {n.lower() for n in names}:
            name = f"{name}_{i}"
        names.append(name)
    return names


class _Range(io.RawIOBase):
    """Bytes [begin, end) of an open file as a raw stream."""

    def __init__(self, fh, begin: int, end: int):
        fh.seek(begin)
        self.fh, self.left = fh, end - begin

    def readable(self) -> bool:
        return True

    def readinto(self, buf) -> int:
        data = self.fh.read(min(len(buf), self.left))
        buf[: len(data)] = data
        self.left -= len(data)
        return len(data)


def _records(fh, begin: int, end: int):
    """The records of [begin, end), blank lines left out; a byte that is not UTF-8 becomes U+FFFD."""
    csv.field_size_limit(1 << 31)
    text = io.TextIOWrapper(io.BufferedReader(_Range(fh, begin, end), PIECE), encoding="utf-8", errors="replace", newline="")
    return (row for row in csv.reader(text) if row)


def _scan(fh, begin: int, end: int):
    """(odd number of quotes?, place after the first line end outside quotes if the block starts outside, ... inside)."""
    odd, cuts, at = 0, [None, None], begin
    fh.seek(begin)
    while at < end and (piece := fh.read(min(PIECE, end - at))):
        raw = np.frombuffer(piece, dtype=np.uint8)
        quotes = np.flatnonzero(raw == 0x22)
        if None in cuts:
            ends = np.flatnonzero(raw == 0x0A)
            parity = (np.searchsorted(quotes, ends) + odd) % 2
            for state in (0, 1):
                hit = ends[parity == state] if cuts[state] is None else ends[:0]
                if len(hit):
                    cuts[state] = at + int(hit[0]) + 1
        odd = (odd + len(quotes)) % 2
        at += len(piece)
    return bool(odd), cuts[0], cuts[1]


def csv_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, header, block, begin, stop): the bytes of every block's own records, for each file under ``path``.

    ``path`` is a file or a folder (names that start with '.' or '_' in it are left out, as Spark does). Empty files give no row.
    """
    files = directory_manifest(spark, path).where("length > 0 and not startswith(name, '_')") if _is_folder(path) else _one_file(spark, path)
    files = cut_lineage(files.select("path", F.col("length").alias("size")))
    starts = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block_bytes).cast("long"))).alias("start"))
    tasks = files.agg(F.sum(F.ceil(F.col("size") / block_bytes))).first()[0] or 1
    tasks = min(int(tasks), MAX_TASKS)

    def scan(batches):
        for pdf in batches:
            rows = []
            for p, size, start in zip(pdf["path"], pdf["size"], pdf["start"]):
                fs, inner = _fs(p)
                with fs.open_input_file(inner) as fh:
                    odd, outside, inside = _scan(fh, start, min(start + block_bytes, size))
                    header = None
                    if start == 0:
                        outside = len(BOM) if fh.read_at(len(BOM), 0) == BOM else 0
                        header = next(_records(fh, outside, size), None)
                rows.append((p, size, start // block_bytes, odd, outside, inside, header))
            # whole numbers that may be missing stay whole numbers
            frame = pd.DataFrame(rows, columns=["path", "size", "block", "odd", "cut_outside", "cut_inside", "header"])
            yield frame.astype({"cut_outside": "Int64", "cut_inside": "Int64"})

    # by the place in the list of blocks: one block a task until there are MAX_TASKS
    scanned = cut_lineage(starts.repartition(tasks, "path", "start").mapInPandas(scan, SCAN_SCHEMA))
    by_file = Window.partitionBy("path").orderBy("block")  # one small row a block
    whole = Window.partitionBy("path")
    odd = F.col("odd").cast("int")
    state = F.coalesce(F.sum(odd).over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    placed = (scanned.withColumn("state", state).withColumn("header", F.max("header").over(whole))
              .withColumn("pairs", F.sum(odd).over(whole) % 2 == 0)
              .withColumn("begin", F.when(F.col("block") == 0, F.col("cut_outside"))
                          .when(F.col("pairs"), F.when(F.col("state") == 0, F.col("cut_outside")).otherwise(F.col("cut_inside")))))
    following = F.first("begin", ignorenulls=True).over(by_file.rowsBetween(1, Window.unboundedFollowing))
    return (placed.withColumn("stop", F.coalesce(following, F.col("size")))
            .where("begin is not null and begin < stop and header is not null").select("path", "header", "block", "begin", "stop"))


def _is_folder(path: str) -> bool:
    from pyarrow import fs as pafs

    fs, inner = _fs(path.rstrip("/"))
    kind = fs.get_file_info(inner).type
    if kind == pafs.FileType.NotFound:
        raise CsvError(f"Path does not exist: {path}")
    return kind == pafs.FileType.Directory


def _one_file(spark: SparkSession, path: str) -> DataFrame:
    fs, inner = _fs(path)
    size = fs.get_file_info(inner).size
    return spark.createDataFrame([(path, size)], "path string, length long").where("length > 0")


def header_lists(blocks: DataFrame) -> list[list[str]]:
    """The different header rows, that of the first path first; as many as there are different ones."""
    rows = blocks.where("block = 0").groupBy("header").agg(F.min("path").alias("path")).collect()
    return [unique_names(list(r["header"])) for r in sorted(rows, key=lambda r: r["path"])]


def read_quoted_csv(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every cell as text, from files of any size, each read by many tasks.

    Columns are those of the first file's header, then further ones of the others; cells go by name, and a
    missing cell or column is ''. Cells beyond the header are left out, blank lines too, as the text scan does.
    Lines end with LF or CRLF; quotes are doubled inside quotes. No file with a header at all is an error.
    """
    blocks = cut_lineage(csv_blocks(spark, path, block_bytes))
    names: list[str] = []
    for header in header_lists(blocks):
        names += [n for n in header if n.lower() not in {x.lower() for x in names}]
    if not names:
        raise CsvError(f"No header row: {path}")
    place = {n.lower(): i for i, n in enumerate(names)}
    schema = pa.schema([pa.field(n, pa.string()) for n in names])

    def batch(rows: list) -> pa.RecordBatch:
        cols = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], schema=schema)

    def parse(batches):
        for some in batches:
            for b in some.to_pylist():
                header = unique_names(b["header"])
                target = [place[n.lower()] for n in header]
                straight = target == list(range(len(names)))
                fs, inner = _fs(b["path"])
                with fs.open_input_file(inner) as fh:
                    records = _records(fh, b["begin"], b["stop"])
                    if b["block"] == 0:
                        next(records, None)
                    rows, held = [], 0
                    for row in records:
                        if not straight or len(row) != len(names):
                            cells = [""] * len(names)
                            for i, cell in zip(target, row):
                                cells[i] = cell
                            row = cells
                        rows.append(row)
                        held += sum(map(len, row))
                        if held > BATCH_BYTES or len(rows) >= 10_000:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    tasks = max(1, min(blocks.count(), MAX_TASKS))
    spread = blocks.repartition(tasks, "path", "begin")
    return spread.mapInArrow(parse, ", ".join(f"`{n.replace('`', '``')}` string" for n in names))


def headers_of(spark: SparkSession, path: str) -> DataFrame:
    """C2 over a folder: (path, position, column), the cells of each file's first record as they stand."""
    heads = csv_blocks(spark, path).where("block = 0")
    return heads.select("path", F.posexplode("header").alias("position", "column"))


# --- typed scan -------------------------------------------------------------------------------

# Texts that a typed scan takes as missing, as the pandas reader does by default.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
           "None", "n/a", "nan", "null")
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])\s*$"
_TRUTH = r"^(True|TRUE|true|False|FALSE|false)$"


def column_types(text: DataFrame) -> dict:
    """Column -> boolean, bigint, double or string, the narrowest that takes every cell which isn't missing.

    One aggregate over all columns: every row says what each of its cells can be, and the types merge by AND, in
    the map tasks first. A column with no cell is a string. Whole numbers beyond 64 bits make a double.
    """
    aggs = []
    for i, c in enumerate(text.columns):
        cell = F.col(f"`{c}`")
        cell = F.when(~cell.isin(*MISSING), cell)
        as_long = cell.rlike(_WHOLE) & F.trim(cell).try_cast("bigint").isNotNull()
        aggs += [F.bool_and(cell.rlike(_TRUTH)).alias(f"b{i}"), F.bool_and(as_long).alias(f"l{i}"), F.bool_and(cell.rlike(_NUMBER)).alias(f"d{i}")]
    seen = text.agg(*aggs).first()
    return {c: "boolean" if seen[f"b{i}"] else "bigint" if seen[f"l{i}"] else "double" if seen[f"d{i}"] else "string"
            for i, c in enumerate(text.columns)}


def typed(text: DataFrame, types: dict) -> DataFrame:
    """The text columns cast to ``types``; missing cells are null in every type."""
    def cast(c: str):
        cell = F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`"))
        kind = types[c]
        return (cell if kind == "string" else (F.lower(cell) == "true") if kind == "boolean" else F.trim(cell).cast(kind)).alias(c)

    return text.select(*[cast(c) for c in text.columns])


def read_typed_quoted_csv(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``read_quoted_csv`` with inferred types. The extension of a single file must be ``.csv``."""
    from .tabular import TabularError, check_extension

    if not _is_folder(path) and check_extension(path) != ".csv":
        raise TabularError("A workbook is read with read_workbooks.")
    text = read_quoted_csv(spark, path, block_bytes)
    return typed(text, column_types(text))
