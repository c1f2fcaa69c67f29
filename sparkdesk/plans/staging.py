"""Files that the file-based queries read, derived by Spark from the driver's tables and
written once per table folder into the shared folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import bz2
import gzip
import io
import os
import zipfile

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import shared_path, table
from ..sources.blobs import _fs, put_blob, write_blobs
from ..sources.tabular import build_xlsx

# Rows per generated workbook (a workbook is one task's output; the range read stays within 1000 rows).
WORKBOOK_ROWS = 500
# Documents per generated zip archive.
ZIP_DOCS = 50


# What a task tells of a file that it has put itself: no content passes from the maker to a writer in batches.
BLOB = "path string, size long"


def _tag(sf_dir: str) -> str:
    return os.path.basename(os.path.normpath(sf_dir)).replace(".", "_")


def _done(path: str) -> bool:
    fs, inner = _fs(path.rstrip("/") + "/_DONE")
    from pyarrow import fs as pafs

    return fs.get_file_info(inner).type != pafs.FileType.NotFound


def _mark(path: str) -> None:
    fs, inner = _fs(path.rstrip("/") + "/_DONE")
    with fs.open_output_stream(inner, compression=None) as fh:
        fh.write(b"ok")


def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    """customer written as CSV part files (header on each part)."""
    path = shared_path(spark, "stage", _tag(sf_dir), "customer_csv")
    if not _done(path):
        (table(spark, sf_dir, "customer").write.mode("overwrite").option("header", True)
         .option("escape", '"').csv(path))
        _mark(path)
    return path


def documents_csv(spark: SparkSession, sf_dir: str) -> str:
    """documents written as CSV part files, each text with a quoted word, a CRLF and the id behind it, every cell quoted."""
    path = shared_path(spark, "stage", _tag(sf_dir), "documents_csv")
    if not _done(path):
        tail = F.concat(F.lit('\n"'), F.coalesce("lang", F.lit("")), F.lit('"\r\n'), F.col("doc_id").cast("string"))
        (table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.concat("text", tail).alias("text"))
         .write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        _mark(path)
    return path


def segment_csv(spark: SparkSession, sf_dir: str) -> str:
    """One CSV a market segment, with a header of its own and one row."""
    path = shared_path(spark, "stage", _tag(sf_dir), "segment_csv")
    if not _done(path):
        seg = F.col("c_mktsegment")
        head = F.concat(F.lit("key of "), seg, F.lit(',"name, quoted","line\nend"\r\n'), F.min("c_custkey").cast("string"), F.lit(",a,b\r\n"))
        files = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(head.cast("binary").alias("content"))
        write_blobs(files.select(F.concat(F.lit(path + "/"), seg, F.lit(".csv")).alias("path"), "content")).count()
        _mark(path)
    return path


def customer_workbooks(spark: SparkSession, sf_dir: str) -> str:
    """One workbook per (segment, block of WORKBOOK_ROWS customer keys); sheet = segment,
    row 1 = header, then the customers in key order, every cell as text."""
    path = shared_path(spark, "stage", _tag(sf_dir), "workbooks")
    if _done(path):
        return path
    cust = table(spark, sf_dir, "customer")
    cols = cust.columns
    text = cust.select(*[F.col(c).cast("string").alias(c) for c in cols],
                       F.floor(F.col("c_custkey") / WORKBOOK_ROWS).cast("bigint").alias("block"))

    def one_book(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c_custkey", key=lambda s: s.astype("int64"))
        seg, block = pdf["c_mktsegment"].iloc[0], int(pdf["block"].iloc[0])
        rows = [cols] + pdf[cols].fillna("").values.tolist()
        target = f"{path}/{seg}_{block}.xlsx"
        return pd.DataFrame({"path": [target], "size": [put_blob(target, build_xlsx([(seg, rows)]))]})

    text.groupBy("c_mktsegment", "block").applyInPandas(one_book, BLOB).agg(F.sum("size")).collect()
    _mark(path)
    return path


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder tree made from ``documents``:

    ``<source>/doc_<id>.<ext>`` with content by ``doc_id % 6``: text (.txt), gzip (.txt.gz),
    bzip2 (.txt.bz2), PNG-signed (.png), PDF-signed (.pdf), JPEG-signed (.jpg); per source and
    block of ZIP_DOCS ids a zip ``<source>/archive_<block>.zip`` holding the texts plus a
    ``__MACOSX/`` member; hidden ``.cache_<block>`` files and a ``skipme/`` folder per source.
    """
    path = shared_path(spark, "stage", _tag(sf_dir), "files")
    if _done(path):
        return path
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")

    def singles(batches):
        for pdf in batches:
            out = []

            def put(target: str, data: bytes) -> None:
                out.append((target, put_blob(target, data)))  # noqa: B023

            for doc_id, source, text in zip(pdf["doc_id"], pdf["source"], pdf["text"]):
                data = (text or "").encode("utf-8")
                kind = int(doc_id) % 6
                base = f"{path}/{source}/doc_{doc_id}"
                if kind == 0:
                    put(base + ".txt", data)
                elif kind == 1:
                    put(base + ".txt.gz", gzip.compress(data, mtime=0))
                elif kind == 2:
                    put(base + ".txt.bz2", bz2.compress(data))
                elif kind == 3:
                    put(base + ".png", b"\x89PNG\r\n\x1a\n" + data)
                elif kind == 4:
                    put(base + ".pdf", b"%PDF-1.4\n" + data)
                else:
                    put(base + ".jpg", b"\xff\xd8\xff\xe0" + data)
                if int(doc_id) % ZIP_DOCS == 0:
                    put(f"{path}/{source}/.cache_{doc_id}", b"hidden")
                    put(f"{path}/{source}/skipme/doc_{doc_id}.txt", data)
            yield pd.DataFrame(out, columns=["path", "size"])

    def one_zip(pdf: pd.DataFrame) -> pd.DataFrame:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for doc_id, text in sorted(zip(pdf["doc_id"], pdf["text"])):
                zf.writestr(f"docs/doc_{doc_id}.txt", (text or "").encode("utf-8"))
            zf.writestr("__MACOSX/._docs", b"meta")
        src, block = pdf["source"].iloc[0], int(pdf["block"].iloc[0])
        target = f"{path}/{src}/archive_{block}.zip"
        return pd.DataFrame({"path": [target], "size": [put_blob(target, buf.getvalue())]})

    files = docs.mapInPandas(singles, BLOB)
    zips = (docs.withColumn("block", F.floor(F.col("doc_id") / ZIP_DOCS).cast("bigint"))
            .groupBy("source", "block").applyInPandas(one_zip, BLOB))
    files.unionByName(zips).agg(F.sum("size")).collect()
    _mark(path)
    return path
