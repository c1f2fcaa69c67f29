"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is merged once: those that come out as one token are *proven*.
A pre-token that equals a proven string counts 1 without any merging; only the others are merged,
and the result is remembered per worker.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a special string inside a text is
one token; rows are independent, so ties, repeats, null ids and extra columns change nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Splitter, byte_alphabet, byte_symbols, load_model, merge, with_classes
from .common import Memo

# Fixed value: the pre-token pattern of the byte-level vocabulary, with the class names to fill in.
BYTE_LEVEL = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"


@functools.lru_cache(maxsize=4)
def proven_whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings, as text, that merge to exactly one token."""
    model = load_model(path)
    back = {c: b for b, c in enumerate(byte_alphabet())}
    proven = set()
    for token in model["vocab"]:
        if all(c in back for c in token) and len(merge(token, model["ranks"])) == 1:
            try:
                proven.add(bytes(back[c] for c in token).decode("utf-8"))
            except UnicodeDecodeError:  # part of a character: no pre-token can equal it
                continue
    return frozenset(proven)


class Counter:
    """Counts the tokens of one text."""

    def __init__(self, path: str, proven, patterns):
        model = load_model(path)
        self.splitter = Splitter(patterns, model["specials"])
        ranks = model["ranks"]
        self.known = Memo(lambda p: len(merge(byte_symbols(p), ranks)), seed=dict.fromkeys(proven, 1))

    def __call__(self, text: str) -> int:
        total = 0
        for special, part in self.splitter.segments(text):
            total += 1 if special else sum(map(self.known.__getitem__, self.splitter.pretokens(part)))
        return total


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """The number of tokens of a text column (long)."""
    shipped = spark.sparkContext.broadcast((proven_whole_tokens(path), with_classes(BYTE_LEVEL)))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path, *shipped.value)
        for texts in batches:
            yield pd.Series([counter(t) if t else 0 for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, max_tokens: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit for every row."""
    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    rows = rows.select(key, F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long").alias("n_bytes"),
                       token_count(docs.sparkSession, F.col("_text"), path).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > max_tokens)
