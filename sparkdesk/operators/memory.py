"""Per-user memory (D-1..D-8): an operation log folded into state, and exact nearest neighbours.

Fold. The log has (seq, op, assistant_id, user_id, memory_id, content, embedding). The owner
of an id is the user of its first valid add; a later add of a live id is a duplicate. An
update / delete counts only if its fields are present, its user is the owner, it comes after
the add and no valid delete precedes it. Everything is aggregates per (assistant, id) and
joins back on that key: partial aggregation combines a hot id map-side and AQE splits a
skewed join partition; no window has to hold a whole id's history in one task.

Search. k nearest memories of the same user (L2 by default, cosine optional), exact. A
bounded query block (size checked) is shipped to every task with ``mapInPandas``: each task
computes distances chunk-wise with NumPy and keeps a local top-k per query; a window top-k
over those survivors gives the answer. More queries meet the memories in a shuffle join of
blocks that pivots leave over (``metric_join``); no (query, memory) pair ever becomes a row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fits
from .metric_join import distances, nearest, unit

# Modes and the default number of results.
MODES = ("add", "update", "delete", "search")
DEFAULT_K = 3
# Up to this many queries or templates are shipped to the tasks; above, they are joined.
QUERY_BLOCK_ROWS = 20_000

KEY = ["assistant_id", "memory_id"]


def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")


def validate_ops(log: DataFrame) -> DataFrame:
    """D-6: adds ``error`` (null when the row is well-formed)."""
    op = F.col("op")
    err = (F.when(~op.isin(*MODES) | op.isNull(), F.lit("invalid mode"))
           .when(~_present("assistant_id") | ~_present("user_id"), F.lit("assistant and user are required"))
           .when((op == "add") & ~_present("content"), F.lit("content is required"))
           .when((op == "update") & (~_present("memory_id") | ~_present("content")),
                 F.lit("memory_id and content are required"))
           .when((op == "delete") & ~_present("memory_id"), F.lit("memory_id is required"))
           .when((op == "search") & ~_present("content"), F.lit("query is required")))
    return log.withColumn("error", err)


def mint_ids(log: DataFrame) -> DataFrame:
    """D-1: an add without an id gets one of its own, made from the assistant and the position in the log."""
    made = F.concat(F.lit("mem-"), F.col("assistant_id").cast("string"), F.lit("-"), F.col("seq").cast("string"))
    return log.withColumn("memory_id", F.when((F.col("op") == "add") & ~_present("memory_id"), made).otherwise(F.col("memory_id")))


def fold_status(log: DataFrame) -> DataFrame:
    """Status of every log row: invalid | added | duplicate | updated | deleted | not found | search.

    Searches and invalid rows, those without an id among them, take no part in the joins by id."""
    every = mint_ids(validate_ops(log))
    stateless = F.col("error").isNotNull() | (F.col("op") == "search")
    plain = every.where(stateless).withColumn("status", F.when(F.col("error").isNotNull(), F.lit("invalid")).otherwise(F.lit("search")))
    v = every.where(~stateless)
    adds = (v.filter(F.col("op") == "add")
            .groupBy(*KEY).agg(F.min("seq").alias("add_seq"), F.min_by("user_id", "seq").alias("owner")))
    with_add = v.join(adds, KEY, "left")
    owned = F.col("owner").isNotNull() & (F.col("user_id") == F.col("owner")) & (F.col("seq") > F.col("add_seq"))
    dels = (with_add.filter(owned & (F.col("op") == "delete"))
            .groupBy(*KEY).agg(F.min("seq").alias("del_seq")))
    full = with_add.join(dels, KEY, "left")
    status = (F.when(F.col("op") == "add", F.when(F.col("seq") == F.col("add_seq"), F.lit("added")).otherwise(F.lit("duplicate")))
              .when((F.col("op") == "update") & owned & (F.col("del_seq").isNull() | (F.col("seq") < F.col("del_seq"))),
                    F.lit("updated"))
              .when((F.col("op") == "delete") & owned & (F.col("seq") == F.col("del_seq")), F.lit("deleted"))
              .otherwise(F.lit("not found")))
    return full.withColumn("status", status).select(*plain.columns).unionByName(plain)


def fold_state(status: DataFrame) -> DataFrame:
    """Live memories after the log: last added/updated version of ids without a valid delete."""
    alive = status.groupBy(*KEY).agg(
        F.max(F.when(F.col("status") == "deleted", 1)).alias("gone"),
        F.max(F.when(F.col("status").isin("added", "updated"),
                     F.struct("seq", "content", *(["embedding"] if "embedding" in status.columns else []))))
        .alias("last"),
        F.max(F.when(F.col("status") == "added", F.col("user_id"))).alias("user_id"))
    cols = [F.col("last.content").alias("content"), F.col("last.seq").alias("last_seq")]
    if "embedding" in status.columns:
        cols.append(F.col("last.embedding").alias("embedding"))
    return alive.filter(F.col("gone").isNull() & F.col("last").isNotNull()).select(*KEY, "user_id", *cols)


def write_state(state: DataFrame, path: str) -> None:
    """D-5: one collection per assistant: the state is written partitioned by assistant, and a
    re-run replaces only the assistants it holds (dynamic partition overwrite)."""
    (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("assistant_id").parquet(path))


def read_collections(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """D-5: the state of the assistants that ``wanted(assistant_id)`` names. The folders of other assistants are
    not read: Spark prunes partitions by the wanted side when it runs."""
    ids = wanted.select("assistant_id").distinct()
    return spark.read.parquet(path).join(ids, "assistant_id", "left_semi")


# --- nearest neighbours -----------------------------------------------------------------------

# Queries scored together inside one task (bounds the distance matrix to chunk x batch rows).
QUERY_CHUNK = 1024


def _local_topk(queries: pd.DataFrame, k: int, metric: str, exclude_self: bool):
    """Per-batch scorer: memories (user, id, vec) against the shipped queries of the same user;
    emits only a local top-k per query (ties at the k-th distance kept)."""
    q_by_user = {}
    for user, grp in queries.groupby("user"):
        mat = np.stack([np.asarray(v, dtype=np.float64) for v in grp["vec"]])
        q_by_user[user] = (grp["query_id"].to_numpy(), grp["source_id"].to_numpy(),
                           unit(mat) if metric == "cosine" else mat)

    def run(batches):
        for pdf in batches:
            out = []
            for user, grp in pdf.groupby("user"):
                if user not in q_by_user:
                    continue
                qids, sources, qall = q_by_user[user]
                mat = np.stack([np.asarray(v, dtype=np.float64) for v in grp["vec"]])
                if metric == "cosine":
                    mat = unit(mat)
                ids = grp["id"].to_numpy()
                for c0 in range(0, len(qids), QUERY_CHUNK):
                    dist = distances(qall[c0:c0 + QUERY_CHUNK], mat, metric)
                    if exclude_self:
                        dist = np.where(sources[c0:c0 + QUERY_CHUNK, None] == ids[None, :], np.inf, dist)
                    kk = min(k, dist.shape[1])
                    for qi in range(dist.shape[0]):
                        row = dist[qi]
                        idx = np.argpartition(row, kk - 1)[:kk] if kk < len(row) else np.arange(len(row))
                        cut = row[idx].max()
                        for j in np.nonzero(row <= cut)[0]:
                            if np.isfinite(row[j]):
                                out.append((int(qids[c0 + qi]), user, int(ids[j]), float(row[j])))
            yield pd.DataFrame(out, columns=["query_id", "user", "id", "distance"])

    return run


def knn(memories: DataFrame, queries: DataFrame, k: int = DEFAULT_K, metric: str = "l2",
        exclude_self: bool = False, ship: bool = True) -> DataFrame:
    """Exact k nearest memories per query, within the query's user.

    ``memories(user, id, vec)``; ``queries(query_id, user, vec, source_id)``. ``exclude_self``
    drops the memory whose id equals the query's source_id. Output: query_id, user, id,
    distance, rank (ties broken by id).

    A batch of at most QUERY_BLOCK_ROWS queries (checked) is shipped to the tasks, unless ``ship`` is off; more queries
    meet the memories in a shuffle join of blocks that pivots leave over (see ``metric_join``). No (query, memory) pair is
    ever a row but for the local top k.
    """
    q = queries.select("query_id", "user", "vec", F.col("source_id")).dropDuplicates()
    mem = memories.select("user", "id", "vec")
    if not ship or not fits(q, QUERY_BLOCK_ROWS):
        return nearest(mem, q, k, metric, exclude_self)
    scored = mem.mapInPandas(_local_topk(q.toPandas(), k, metric, exclude_self), "query_id long, user string, id long, distance double")
    w = Window.partitionBy("query_id").orderBy(F.col("distance").asc(), F.col("id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= int(k))


def result_lines(ranked: DataFrame, content: Column, keys: list) -> DataFrame:
    """D-7: '- text (memory_id: id)' lines joined by newline in rank order, per key."""
    line = F.concat(F.lit("- "), content, F.lit(" (memory_id: "), F.col("id").cast("string"), F.lit(")"))
    return (ranked.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("rank", "id", line.alias("line")))).alias("hits"))
            .select(*keys, F.transform("hits", lambda h: h["id"]).alias("ids"),
                    F.array_join(F.transform("hits", lambda h: h["line"]), "\n").alias("result")))


def none_found(lines: DataFrame, queries: DataFrame, query_text: Column, keys: list) -> DataFrame:
    """D-7: one row for every row of ``queries`` (keys and ``user`` among its columns): its lines, or the
    'none found' line and no ids."""
    none = F.concat(F.lit("No memories found for user_id "), F.col("user"), F.lit(" with query: "), query_text)
    asked = queries.select(*keys, "user", none.alias("none"))
    return asked.join(lines.select(*keys, "ids", "result"), keys, "left").select(
        *keys, "user", F.coalesce("ids", F.array().cast("array<long>")).alias("ids"), F.coalesce("result", "none").alias("result"))


def best_template(rows: DataFrame, templates: DataFrame, max_distance: float | None, metric: str = "l2", ship: bool = True) -> DataFrame:
    """D-8: nearest template of the row's agent; kept only under ``max_distance`` (None = no
    threshold); rows without a match stay, with nulls. ``rows(id, user, vec)``, one row per id,
    ``templates(template_id, user, vec)``. Up to QUERY_BLOCK_ROWS templates (checked) are shipped to
    every task, unless ``ship`` is off, and each row is scored where it lies; more meet the rows in a shuffle join of the
    blocks that the threshold and the pivots leave over (see ``metric_join``)."""
    t = templates.select("template_id", "user", "vec")
    if not ship or not fits(t, QUERY_BLOCK_ROWS):
        asked = rows.select(F.col("id").alias("query_id"), "user", "vec", F.lit(None).cast("long").alias("source_id"))
        found = nearest(t.withColumnRenamed("template_id", "id"), asked, 1, metric, max_distance=max_distance)
        found = found.select(F.col("query_id").alias("id"), F.col("id").alias("template_id"), "distance")
        return rows.select("id", "user").join(found, "id", "left").select("id", "user", "template_id", "distance")
    block = t.toPandas()  # bounded by the check above
    by_user = {}
    for user, grp in block.groupby("user"):
        mat = np.stack([np.asarray(v, dtype=np.float64) for v in grp["vec"]])
        by_user[user] = (grp["template_id"].to_numpy(), unit(mat) if metric == "cosine" else mat)
    limit = None if max_distance is None else float(max_distance)

    def run(batches):
        for pdf in batches:
            tid = np.full(len(pdf), None, dtype=object)
            dist = np.full(len(pdf), np.nan)
            for user, grp in pdf.groupby("user"):
                if user not in by_user:
                    continue
                ids, tmat = by_user[user]
                mat = np.stack([np.asarray(v, dtype=np.float64) for v in grp["vec"]])
                d = distances(unit(mat) if metric == "cosine" else mat, tmat, metric)
                # nearest, ties to the lowest template id
                order = np.lexsort((np.broadcast_to(ids, d.shape), d), axis=1)[:, 0]
                best_d = d[np.arange(len(d)), order]
                pos = grp.index.to_numpy()
                keep = np.ones(len(pos), dtype=bool) if limit is None else best_d < limit
                tid[pos[keep]] = ids[order][keep]
                dist[pos[keep]] = best_d[keep]
            yield pd.DataFrame({"id": pdf["id"], "user": pdf["user"], "template_id": pd.array(tid, dtype="Int64"),
                                "distance": dist})

    return rows.select("id", "user", "vec").mapInPandas(run, "id long, user string, template_id long, distance double")
