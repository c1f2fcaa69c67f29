"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum (combined before the shuffle) and a join on the node, written to the
shared folder; no component and no edge list is ever held by one task or the driver. A pass of local
union-find inside each partition shortens long chains first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The partition's edges as stars around the smallest node of each local tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    rows = [(x, root(x)) for x in list(parent) if root(x) != x]
    yield pd.DataFrame(rows, columns=["a", "b"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of long ids -> (node, label): the smallest id reachable, for every node with an edge
    except the labels themselves. Null ids, loops and repeated edges are ignored."""
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    e = checkpointed(e.mapInPandas(local_forest, "a long, b long").distinct())
    while True:
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = checkpointed(small)
        roots = e.select(F.col("b").alias("a")).distinct()
        if e.join(roots, "a", "left_semi").isEmpty() and e.groupBy("a").count().where("count > 1").isEmpty():
            return e.select(F.col("a").alias("node"), F.col("b").alias("label"))
