"""Exact k nearest points per query, within a group, by pivots and a shuffle join of bounded blocks.

1. ``n_pivots`` vectors (a fixed, hash-chosen sample) are the pivots. Every point goes to the cell of its nearest pivot; a
   (group, cell) keeps its number of points and the least and greatest distance to its pivot.
2. The points of a cell lie within d(q, pivot) + greatest distance of a query, so the cells' counts give a bound on the query's
   k-th distance. A cell is needed only if the triangle inequality and the plane between two pivots allow a point that near.
3. Points of a cell are cut into blocks and the queries that need it into shares, both of bounded size by their counts; every block
   meets every share once, in its own group. Each keeps a local top k per query, ties at the k-th distance by the lower id; a
   window keeps k of them.

Nothing but the pivots passes through the driver, and no (query, point) pair becomes a row unless it is in a local top k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_PIVOTS = 64
BLOCK_POINTS, SHARE_QUERIES = 2048, 2048
SLICE_QUERIES = 256  # queries whose distances a task holds at once
SLACK = 1e-6  # of rounding, relative
OUTSIDE = -1  # cell of zero vectors under cosine: met by every query


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row of a to every row of b (cosine: rows are unit vectors)."""
    if metric == "cosine":
        return 1.0 - a @ b.T
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0.0))


def unit(mat: np.ndarray) -> np.ndarray:
    return mat / np.maximum(np.linalg.norm(mat, axis=1, keepdims=True), 1e-12)


def matrix(vectors, metric: str) -> np.ndarray:
    mat = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return unit(mat) if metric == "cosine" else mat


def with_cells(points: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    """user, id, vec, cell, radius (Euclidean distance to the cell's pivot)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                mat = matrix(pdf["vec"], metric)
                d = distances(mat, pivots, "l2")
                cell = d.argmin(axis=1)
                radius = d[np.arange(len(d)), cell]
                if metric == "cosine":
                    cell = np.where((mat == 0).all(axis=1), OUTSIDE, cell)
                yield pdf.assign(cell=cell, radius=radius)

    return points.mapInPandas(run, "user string, id long, vec array<double>, cell long, radius double")


def needed_cells(d: np.ndarray, gap: np.ndarray, cell: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, limit: float) -> np.ndarray:
    """Which of a group's cells can hold one of the query's k nearest points (distances d to all pivots, gap between pivots)."""
    inside = cell != OUTSIDE
    at = np.where(inside, cell, 0)
    reach = np.where(inside, d[at] + high, np.inf)
    order = np.argsort(reach)
    enough = np.flatnonzero(np.cumsum(n[order]) >= k)
    bound = min(limit, float(reach[order[enough[0]]]) if len(enough) else np.inf)
    own = int(d.argmin())
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(gap[own, at] > 0, (d[at] ** 2 - d[own] ** 2) / (2 * gap[own, at]), 0.0)
    least = np.maximum.reduce([d[at] - high, low - d[at], plane])
    return ~inside | (least <= bound + SLACK * (1 + abs(bound) if np.isfinite(bound) else 1) + SLACK * d[at])


def nearest(points: DataFrame, queries: DataFrame, k: int, metric: str = "l2", exclude_self: bool = False, max_distance: float | None = None,
            n_pivots: int = N_PIVOTS) -> DataFrame:
    """points(user, id, vec), queries(query_id, user, vec, source_id) -> query_id, user, id, distance, rank.

    ``max_distance`` keeps only nearer points (strictly). Rows with a null user, id or vector take no part; queries without a
    point give no row; ties go to the lower id."""
    spark = points.sparkSession
    points = points.select("user", F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")).dropna()
    asked = queries.select("query_id", "user", F.col("vec").cast("array<double>").alias("vec"), F.col("source_id").cast("long").alias("source_id")).dropna(subset=["query_id", "user", "vec"])
    chosen = points.orderBy(F.xxhash64(F.lit(3), "id", "vec"), "id").select("vec").limit(n_pivots).toPandas()["vec"]  # n_pivots vectors at most
    out = "query_id long, user string, id long, distance double"
    if not len(chosen):
        return spark.createDataFrame([], out + ", rank int")
    pivots = np.unique(matrix(chosen, metric), axis=0)
    gap = distances(pivots, pivots, "l2")
    placed = with_cells(points, pivots, metric)
    cells = placed.groupBy("user", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("radius").alias("low"), F.max("radius").alias("high"))
    of_user = cells.groupBy("user").agg(F.collect_list(F.struct("cell", "n", "low", "high")).alias("cells"))  # n_pivots + 1 at most
    # arrays of numbers: an array of structs is a Python object a field for every query of a batch
    of_user = of_user.select("user", *[F.col(f"cells.{c}").alias(f"cells_{c}") for c in ("cell", "n", "low", "high")])
    if metric == "cosine":
        limit = np.inf if max_distance is None else float(np.sqrt(2 * max(max_distance, 0.0)))
    else:
        limit = np.inf if max_distance is None else float(max_distance)
    wanted = k + 1 if exclude_self else k

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            of = pdf[["cells_cell", "cells_n", "cells_low", "cells_high"]].to_numpy()
            for s in range(0, len(pdf), SLICE_QUERIES):
                mat = matrix(pdf["vec"].iloc[s:s + SLICE_QUERIES], metric)
                for d, vec, (cell, n, low, high) in zip(distances(mat, pivots, "l2"), mat, of[s:s + SLICE_QUERIES], strict=True):
                    every = metric == "cosine" and not vec.any()
                    found.append(cell.tolist() if every else cell[needed_cells(d, gap, cell, n, low, high, wanted, limit)].tolist())
            yield pdf[["user", "query_id", "vec", "source_id"]].assign(need=found)

    routed = asked.join(of_user, "user").mapInPandas(route, "user string, query_id long, vec array<double>, source_id long, need array<long>")
    shares = routed.select("user", F.explode("need").alias("cell")).groupBy("user", "cell").agg(F.count(F.lit(1)).alias("asking"))
    parts = cells.join(shares, ["user", "cell"]).select("user", "cell", F.ceil(F.col("n") / BLOCK_POINTS).cast("long").alias("blocks"),
                                                        F.ceil(F.col("asking") / SHARE_QUERIES).cast("long").alias("shares"))
    left = placed.join(parts, ["user", "cell"]).select(
        "user", "cell", F.pmod(F.xxhash64("id", "vec"), F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "id", "vec")
    right = routed.select("*", F.explode("need").alias("cell")).drop("need").join(parts, ["user", "cell"]).select(
        "user", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("query_id", "vec"), F.col("shares")).alias("share"),
        "query_id", "source_id", "vec")

    def meet(key, pts: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(pts) or not len(qs):
            return pd.DataFrame({"query_id": [], "user": [], "id": [], "distance": []})
        ids, sources, asking = pts["id"].to_numpy(), qs["source_id"].to_numpy(), qs["query_id"].to_numpy()
        mat, most = matrix(pts["vec"], metric), np.inf if max_distance is None else max_distance
        parts = []
        for s in range(0, len(qs), SLICE_QUERIES):
            d = distances(matrix(qs["vec"].iloc[s:s + SLICE_QUERIES], metric), mat, metric)
            if exclude_self:
                d[sources[s:s + SLICE_QUERIES, None] == ids[None, :]] = np.inf
            kth = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
            q, p = np.nonzero((d <= kth[:, None]) & np.isfinite(d) & (d < most))
            # ties beyond k: those of the lowest ids are the ones that the last ranking keeps
            order = np.lexsort((ids[p], d[q, p], q))
            q, p = q[order], p[order]
            first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else q
            near = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) < k
            q, p = q[near], p[near]
            parts.append(pd.DataFrame({"query_id": asking[s + q], "user": key[0], "id": ids[p], "distance": d[q, p]}))
        return pd.concat(parts)

    keys = ["user", "cell", "block", "share"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, out)
    best = Window.partitionBy("query_id").orderBy(F.col("distance").asc(), F.col("id").asc())
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= int(k))
