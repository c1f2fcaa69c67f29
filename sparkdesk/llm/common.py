"""Helpers shared by the corpus operators: bounded samples, ASCII words, hashing, written tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, fresh_shared_path

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def crc_mod(key: Column, m: int) -> Column:
    """crc32 of the key as text, modulo m (null for a null key)."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(m))


def bounded_sample(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of every group, chosen by the hash of ``key`` (the same rows on every run).

    Groups are label values. Their counts set a hash threshold first, so that about 2n rows of a
    group reach the window that cuts at n, however many rows the table has.
    """
    counts = {r[0]: r[1] for r in df.groupBy(group).count().collect()}
    if not counts:
        return df
    rank = F.xxhash64(F.lit(17), F.col(key))
    share = F.lit(1.0)
    for value, cnt in counts.items():
        if cnt > 2 * n:
            share = F.when(F.col(group) == F.lit(value), F.lit(2.0 * n / cnt)).otherwise(share)
    inside = F.pmod(rank, F.lit(1 << 30)) < share * F.lit(float(1 << 30))
    order = Window.partitionBy(group).orderBy(F.xxhash64(F.lit(29), F.col(key)), F.col(key))
    return df.where(inside).withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).drop("_rn")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a uint64 array over all bits (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """A dictionary of strings that fills itself through ``make``. At ``limit`` keys the present ones become the old half, and
    what is not asked for again goes with the next turn; strings over ``longest`` characters are made each time, so memory is bounded."""

    longest = 64

    def __init__(self, make, limit: int = 200_000, seed: dict | None = None):
        super().__init__(seed or {})
        self.make, self.limit, self.seed, self.old = make, limit, seed or {}, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        value = self.old.get(key)
        return self.keep(key, self.make(key) if value is None else value)

    def keep(self, key, value):
        if len(self) >= self.limit + len(self.seed):
            self.old = dict(self)
            self.clear()
            self.update(self.seed)
        self[key] = value
        return value


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again: later plans start from the files."""
    spark: SparkSession = df.sparkSession
    path = fresh_shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    return cut_lineage(df)


def pieces(total: int, step: int):
    """(start, end) ranges that cover ``total``."""
    for s in range(0, total, step):
        yield s, min(total, s + step)
