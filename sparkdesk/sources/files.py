"""File-set sources: directory manifest (E1), whole-file text (E2), archive expansion (E3),
preview and dispatch by extension (C9, C10).

Folders are listed inside tasks, level by level, through the file system helper of ``blobs.py`` (Spark's
own file index hides names that start with '_'); bytes are read only for the files kept. Archives are
expanded per file inside tasks (``mapInPandas``).
"""

from __future__ import annotations

import bz2
import functools
import gzip
import io
import os
import posixpath
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..session import cut_lineage, task_slots
from .blobs import _fs

# Archive suffixes in the order they are checked (case-sensitive), and the
# folder that zip listings drop.
ARCHIVE_SUFFIXES = (".zip", ".gz", ".bz2")
MAC_META = "__MACOSX"

ARCHIVE_SCHEMA = "archive string, member string, content binary, status string"


class FileSetError(ValueError):
    pass


PART_BYTES = 16 << 20
LISTING_ROWS = 10_000  # rows of a folder's listing handed on at once
LISTING = "path string, folder boolean, length long, modified long"


def _listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length) of the files under ``path``; names that start with '.' and what
    lies below them are left out. Folders are listed inside tasks, level by level, one row out per file."""
    root = _plain(path)

    def entries(folder: str, first: bool) -> list:
        from pyarrow import fs as pafs

        fs, _ = _fs(path)
        if first:
            info = fs.get_file_info(folder)
            found = [] if info.type == pafs.FileType.NotFound else [info]
        else:
            found = [i for i in fs.get_file_info(pafs.FileSelector(folder)) if not i.base_name.startswith(".")]
        return [(i.path, i.type == pafs.FileType.Directory, i.size or 0, (i.mtime_ns or 0) // 1_000_000)
                for i in found]

    def listed(first: bool):
        def run(batches):
            for pdf in batches:
                for folder in pdf["path"]:
                    found = entries(folder, first)
                    for at in range(0, max(len(found), 1), LISTING_ROWS):
                        yield pd.DataFrame(found[at:at + LISTING_ROWS], columns=["path", "folder", "length", "modified"])
        return run

    slots = task_slots(spark)
    level = cut_lineage(spark.createDataFrame([(root,)], "path string").mapInPandas(listed(True), LISTING))
    if level.isEmpty():
        raise FileSetError(f"Path does not exist: {path}")
    files, descend = level.where("not folder"), True
    while descend and not (folders := level.where("folder")).isEmpty():
        level = cut_lineage(folders.select("path").repartition(slots, "path").mapInPandas(listed(False), LISTING))
        files, descend = files.unionByName(level.where("not folder")), recursive
    return files.select(F.concat(F.lit(_prefix(path)), F.col("path")).alias("path"),
                        F.timestamp_millis("modified").alias("modificationTime"), "length")


def _plain(path: str) -> str:
    """The path as the file system helper sees it."""
    plain = _fs(path)[1].rstrip("/") or "/"
    return plain if "://" in path else os.path.abspath(plain)


def _prefix(path: str) -> str:
    """What Spark's own paths have in front of that."""
    if "://" in path and not path.startswith("file:"):
        plain = _plain(path)
        whole = path.rstrip("/")
        return whole[:-len(plain)] if whole.endswith(plain) else ""
    return "file:"


def _with_content(files: DataFrame, path: str, head: int | None = None) -> DataFrame:
    """The files' bytes besides (the first ``head`` of each if given), read in tasks, in parts of about PART_BYTES."""
    cut = len(_prefix(path))

    def run(batches):
        fs, _ = _fs(path)
        for pdf in batches:
            size = pdf["length"] if head is None else pdf["length"].clip(upper=head)
            part = size.cumsum() // PART_BYTES
            for _, some in pdf.groupby(part, sort=False):
                contents = []
                for p in some["path"]:
                    with fs.open_input_stream(p[cut:], compression=None) as fh:
                        contents.append(fh.read() if head is None else fh.read(head))
                yield some.assign(content=contents)

    schema = StructType([*files.schema.fields, StructField("content", BinaryType())])
    return files.repartition(task_slots(files.sparkSession), "path").mapInPandas(run, schema)


def directory_manifest(spark: SparkSession, path: str, recursive: bool = False, extensions=None,
                       ignore: list | None = None, with_content: bool = False, head: int | None = None) -> DataFrame:
    """Files under ``path`` (flat or recursive) as (path, name, rel_path, length, modificationTime).

    Hidden files and folders are skipped, so are names in ``ignore`` (folders and file names);
    ``extensions`` (list or comma text, always lower-cased and trimmed) keeps files whose
    lower-cased name ends with one of them. ``with_content`` also reads the bytes (one pass
    for jobs that need both the listing rules and the content), only the first ``head`` of each file if given.
    """
    if isinstance(extensions, str):
        extensions = extensions.split(",")
    exts = [e.strip().lower() for e in (extensions or []) if e and e.strip()]
    ignore = list(ignore or [])
    root = path.rstrip("/")
    df = _listing(spark, root, recursive=recursive)
    rel = F.substring("path", len(_prefix(root)) + len(_plain(root).rstrip("/")) + 2, 1 << 30)
    df = df.withColumn("rel_path", rel).withColumn("parts", F.split("rel_path", "/"))
    df = df.withColumn("name", F.element_at("parts", -1)).filter("name <> ''")
    if not recursive:
        df = df.filter(F.size("parts") == 1)
    df = df.filter(~F.exists("parts", lambda p: p.startswith(".")))
    if ignore:
        df = df.filter(~F.exists("parts", lambda p: p.isin(*ignore)))
    if exts:
        low = F.lower("name")
        cond = F.lit(False)
        for e in exts:
            cond = cond | low.endswith(e)
        df = df.filter(cond)
    df = df.select("path", "name", "rel_path", "length", "modificationTime")
    return _with_content(df, root, head) if with_content else df


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Each file's content as one value (path, text)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


def _expand_one(path: str, content: bytes):
    """The members of one archive, one at a time."""
    name = posixpath.basename(path)
    if name.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as zf:
            for info in zf.infolist():
                if info.is_dir() or info.filename.startswith(MAC_META + "/") or f"/{MAC_META}/" in info.filename:
                    continue
                yield path, info.filename, zf.read(info), "ok"
    elif name.endswith(".gz"):
        yield path, name[: -len(".gz")], gzip.decompress(content), "ok"
    elif name.endswith(".bz2"):
        yield path, name[: -len(".bz2")], bz2.decompress(content), "ok"
    else:
        yield path, None, None, "unsupported archive format"


def _member_frames(archives):
    """Members of (path, content) pairs, in frames of about PART_BYTES."""
    columns, rows, held = ["archive", "member", "content", "status"], [], 0
    for path, content in archives:
        for row in _expand_one(path, content):
            rows.append(row)
            held += len(row[2] or b"") + 200
            if held > PART_BYTES:
                yield pd.DataFrame(rows, columns=columns)
                rows, held = [], 0
    yield pd.DataFrame(rows, columns=columns)


def expand_archives(files: DataFrame) -> DataFrame:
    """(path, content) rows → one row per member (archive, member, content, status)."""

    def run(batches):
        for pdf in batches:
            yield from _member_frames((p, bytes(c)) for p, c in zip(pdf["path"], pdf["content"]))

    return files.select("path", "content").mapInPandas(run, ARCHIVE_SCHEMA)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """E3 over a folder: every .zip / .gz / .bz2 file expanded by the task that reads it, one archive at a time."""
    files = _listing(spark, path)
    name = F.element_at(F.split("path", "/"), -1)
    cond = F.lit(False)
    for s in ARCHIVE_SUFFIXES:
        cond = cond | name.endswith(s)
    cut = len(_prefix(path))

    def run(batches):
        fs, _ = _fs(path)

        def contents():
            for pdf in batches:
                for p in pdf["path"]:
                    with fs.open_input_stream(p[cut:], compression=None) as fh:
                        yield p, fh.read()

        yield from _member_frames(contents())

    return files.filter(cond).select("path").repartition(task_slots(spark), "path").mapInPandas(run, ARCHIVE_SCHEMA)


def _preview_one(path: str, content: bytes) -> tuple:
    name = posixpath.basename(path)
    ext = posixpath.splitext(name)[1].lower()
    if ext == ".csv":
        import csv

        first = content.split(b"\n", 1)[0].decode("utf-8").rstrip("\r")
        return (path, "csv", next(csv.reader([first]), []))
    if ext in (".xlsx", ".xls"):
        from .tabular import parse_xlsx

        books = parse_xlsx(content) if ext == ".xlsx" else []
        header = books[0][1][0][1] if books and books[0][1] else []
        return (path, "excel", header)
    if ext == ".zip":
        with zipfile.ZipFile(io.BytesIO(content)) as zf:
            members = [n for n in zf.namelist() if not n.startswith(MAC_META + "/")]
        return (path, "zip", members)
    return (path, "file", [name])


def preview(files: DataFrame) -> DataFrame:
    """Csv / workbook → column names; zip → member names without the mac folder; other →
    base name. ``files(path, content)``."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame([_preview_one(p, bytes(c)) for p, c in zip(pdf["path"], pdf["content"])],
                               columns=["path", "kind", "entries"])

    return files.select("path", "content").mapInPandas(run, "path string, kind string, entries array<string>")


ITEM_SCHEMA = "path string, kind string, item_no int, item string"


def _file_items(path: str, fh):
    """The items of one file, one at a time, from its bytes as an open stream (a CSV is never held whole)."""
    import csv
    import json

    from .tabular import parse_xlsx

    ext = posixpath.splitext(path)[1].lower()
    if ext == ".zip":
        with zipfile.ZipFile(io.BytesIO(fh.read())) as zf:
            for i, n in enumerate(zf.namelist()):
                if not n.startswith(MAC_META + "/") and not n.endswith("/"):
                    yield path, "zip", i, f"{path}/{n}"
    elif ext == ".csv":
        reader = csv.reader(io.TextIOWrapper(fh, encoding="utf-8", newline=""))
        header = next(reader, [])
        for i, r in enumerate(reader):
            if r:
                yield path, "csv", i, json.dumps(dict(zip(header, r)), ensure_ascii=False, separators=(",", ":"))
    elif ext == ".xlsx":
        for _, srows in parse_xlsx(fh.read())[:1]:
            header = srows[0][1] if srows else []
            for i, (_, cells) in enumerate(srows[1:]):
                yield path, "excel", i, json.dumps(dict(zip(header, cells)), ensure_ascii=False, separators=(",", ":"))
    else:
        yield path, "file", 0, path


def _item_frames(opened):
    """Items of (path, stream) pairs, in frames of about PART_BYTES."""
    columns, rows, held = ["path", "kind", "item_no", "item"], [], 0
    for path, fh in opened:
        for row in _file_items(path, fh):
            rows.append(row)
            held += len(row[3]) + 200
            if held > PART_BYTES:
                yield pd.DataFrame(rows, columns=columns)
                rows, held = [], 0
    yield pd.DataFrame(rows, columns=columns)


def dispatch_items(files: DataFrame) -> DataFrame:
    """Items by extension: zip → one item per member path, csv → one JSON object per row,
    xlsx → one JSON object per data row, other → the path itself. ``files(path, content)``."""

    def run(batches):
        for pdf in batches:
            yield from _item_frames((p, io.BytesIO(bytes(c))) for p, c in zip(pdf["path"], pdf["content"]))

    return files.select("path", "content").mapInPandas(run, ITEM_SCHEMA)


def read_items(spark: SparkSession, paths: list, extensions: tuple) -> DataFrame:
    """C9 over folders: ``dispatch_items`` of every file below them with one of the extensions (case as given), listed in tasks and
    read by the task that makes its items, one file at a time. Spark's own file index would hold every file of the folders on
    the driver, also those of other extensions. As there, empty files and names that start with '.' or '_' are left out."""

    def of(path: str) -> DataFrame:
        parts = F.split(F.substring("path", len(_prefix(path)) + len(_plain(path).rstrip("/")) + 2, 1 << 30), "/")
        name = F.element_at(parts, -1)
        wanted = F.lit(False)
        for e in extensions:
            wanted = wanted | name.endswith(e)
        hidden = F.exists(parts, lambda p: p.startswith("_") & ~p.contains("="))
        cut = len(_prefix(path))

        def run(batches):
            fs, _ = _fs(path)

            def opened():
                for pdf in batches:
                    for p in pdf["path"]:
                        with fs.open_input_stream(p[cut:], compression=None) as fh:
                            yield p, fh

            yield from _item_frames(opened())

        files = _listing(spark, path).where((F.col("length") > 0) & wanted & ~hidden)
        return files.select("path").repartition(task_slots(spark), "path").mapInPandas(run, ITEM_SCHEMA)

    items = [of(p) for p in paths]
    return functools.reduce(DataFrame.unionByName, items)


TEXT_PIECE = 32 << 20


def text_pieces(spark: SparkSession, path: str, piece_bytes: int = TEXT_PIECE, recursive: bool = False, extensions=None,
                ignore: list | None = None) -> DataFrame:
    """E2 for files of any size: (path, start, text), one row for each range of a file's bytes, read by many tasks.

    A range begins at the first character that starts in it, so none is cut; put together in order of ``start``
    the pieces are the file. Bytes that are no UTF-8 become U+FFFD. An empty file gives one empty piece.
    """
    files = directory_manifest(spark, path, recursive, extensions, ignore).select("path", F.col("length").alias("size"))
    files = cut_lineage(files)
    step = F.lit(piece_bytes).cast("long")
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), step)).alias("start"))
    # about PART_BYTES of ranges a task, whatever their number
    weight = files.agg(F.sum(F.col("size") + F.lit(1 << 12))).first()[0] or 1
    tasks = min(max(int(weight // max(PART_BYTES, piece_bytes)) + 1, task_slots(spark)), 100_000)
    cut = len(_prefix(path))

    def joint(fh, at: int, size: int) -> int:
        """The first place from ``at`` on that is no further byte of a character (at most three are)."""
        if at <= 0 or at >= size:
            return min(at, size)
        follow = fh.read_at(min(3, size - at), at)
        return at + next((i for i, b in enumerate(follow) if b & 0xC0 != 0x80), len(follow))

    def read(batches):
        fs, _ = _fs(path)
        names = ["path", "start", "text"]
        rows, held = [], 0
        for pdf in batches:
            for p, size, start in zip(pdf["path"], pdf["size"], pdf["start"]):
                with fs.open_input_file(p[cut:]) as fh:
                    begin, end = joint(fh, start, size), joint(fh, start + piece_bytes, size)
                    rows.append((p, start, fh.read_at(end - begin, begin).decode("utf-8", errors="replace") if end > begin else ""))
                held += end - begin
                if held > PART_BYTES:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
        yield pd.DataFrame(rows, columns=names)

    return ranges.repartition(tasks, "path", "start").mapInPandas(read, "path string, start long, text string")


def joined_text(pieces: DataFrame) -> DataFrame:
    """Each file's content as one value (path, text, n_pieces), for files that one row can hold (2 GB in Spark)."""
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    return pieces.groupBy("path").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"), F.count(F.lit(1)).alias("n_pieces"))
