"""Query-log audit (A9): the SQL keyword guard applied to a table of submitted query texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    guard_allows,
    guard_allows_whole_word,
    guard_first_keyword,
    guard_first_word_keyword,
    statement_kind,
)
from ..session import spread_small


def audit_queries(df: DataFrame, query_col: str = "query") -> DataFrame:
    """Per query text: statement kind, first offending keyword (substring and whole-word), verdicts."""
    q = F.col(query_col)
    df = spread_small(df)  # regex scans of whole texts are CPU-bound
    return df.select(
        "*",
        statement_kind(q).alias("kind"),
        guard_first_keyword(q).alias("keyword"),
        guard_allows(q).alias("allowed"),
        guard_first_word_keyword(q).alias("word_keyword"),
        guard_allows_whole_word(q).alias("allowed_whole_word"),
    )


def audit_summary(audited: DataFrame, keys: list) -> DataFrame:
    """Counts per key: total, allowed, rejected, and rejected only by the substring rule."""
    return audited.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("allowed"), 1)).alias("n_allowed"),
        F.count(F.when(~F.col("allowed"), 1)).alias("n_rejected"),
        F.count(F.when(~F.col("allowed") & F.col("allowed_whole_word"), 1)).alias("n_false_reject"),
    )
