"""Sinks: CSV export of a result (A8), plain overwrite/append writes (E10), header-only table.

Rows are written by the executors as part files; the row count comes from an
``Observation`` on the same job, so the result is never collected and never re-read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MSG_EMPTY = "No data returned from SQL query"


class ExportError(ValueError):
    pass


@dataclass(frozen=True)
class ExportResult:
    path: str
    rows: int  # data rows, header not counted
    size_mb: float


def _hadoop(spark: SparkSession, path: str):
    """The file system and path object Spark itself uses for a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def export_csv(df: DataFrame, path: str, include_headers: bool = True, mode: str = "overwrite",
               single_file: bool = False) -> ExportResult:
    """Write a result as CSV; an empty result is an error (checked from the same job's count)
    and leaves an earlier export untouched: rows are written aside and swapped in.

    ``single_file`` coalesces to one part only for results the caller knows are small.
    """
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}.aside-{uuid.uuid4().hex[:8]}" if mode == "overwrite" else path
    obs = Observation("export")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.coalesce(1)
    (out.write.mode(mode)
        .option("header", include_headers)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(aside))
    rows = int(obs.get["rows"])
    fs, target = _hadoop(spark, path)
    if aside != path:
        written = _hadoop(spark, aside)[1]
        if rows == 0:  # the previous export stays as it is
            fs.delete(written, True)
        else:
            fs.delete(target, True)
            fs.rename(written, target)
    if rows == 0:
        raise ExportError(MSG_EMPTY)
    return ExportResult(path, rows, round(fs.getContentSummary(target).getLength() / (1024 * 1024), 6))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", override: bool = True, **options) -> None:
    """Overwrite is the default; append otherwise."""
    df.write.mode("overwrite" if override else "append").options(**options).format(fmt).save(path)


def write_header_only(df_or_schema, path: str, spark=None) -> None:
    """A CSV that holds only the header row."""
    if isinstance(df_or_schema, DataFrame):
        df = df_or_schema.limit(0)
    else:
        df = spark.createDataFrame([], df_or_schema)
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
