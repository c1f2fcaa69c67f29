"""Whole-file writes from tasks, on any filesystem pyarrow can address (local, HDFS, S3 ...).

Spark has no writer for arbitrary binary files; tasks write them with ``pyarrow.fs`` so the
same code works on a shared cluster folder, never on a machine-local temporary one.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def _fs(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def put_blob(path: str, data: bytes) -> int:
    """Writes bytes to a path (parents created); returns their number."""
    fs, inner = _fs(path)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(inner, compression=None) as fh:
        fh.write(data)
    return len(data)


def write_blobs(df: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Writes each row's bytes to its path (parents created); returns (path, size) rows.
    Lazy: the files are written when the result is computed. A task gets rows in batches of up to 10,000, so
    large contents made in Python are better put by the task that makes them (``put_blob``)."""

    def write(batches):
        for pdf in batches:
            out = [(p, put_blob(p, bytes(content))) for p, content in zip(pdf[path_col], pdf[content_col])]
            yield pd.DataFrame(out, columns=["path", "size"])

    return df.select(path_col, content_col).mapInPandas(write, "path string, size long")


def read_first_line(path: str) -> str:
    """The first CSV record of a file, however long: up to the first line end outside quotes."""
    fs, inner = _fs(path)
    head, done = b"", 0
    quoted = False
    with fs.open_input_stream(inner, compression=None) as fh:
        while part := fh.read(1 << 16):
            head += part
            for at in range(done, len(head)):
                if head[at] == 0x22:
                    quoted = not quoted
                elif head[at] == 0x0A and not quoted:
                    return head[:at].decode("utf-8-sig").rstrip("\r")
            done = len(head)
    return head.decode("utf-8-sig").rstrip("\r")
