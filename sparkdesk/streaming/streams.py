"""Structured Streaming forms (ours; the reference has no streams).

Stateless operators work on a streaming DataFrame unchanged: the tenant filter (a filter, or a
stream-static semi-join with a broadcast id list), the SQL audit and row items. The memory log
is folded per micro-batch in ``foreachBatch``: the previous snapshot is turned back into log
rows that sort before the new ones, folded together with the batch, and the new snapshot is
written under the batch id (a retried batch rewrites the same folder, so the sink is idempotent).
``memory_status_stream`` keeps one small state per memory id instead, so a batch costs what its own rows cost.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.utils import AnalysisException

from ..operators import memory
from ..operators.audit import audit_queries
from ..operators.governed import AccessContext, TenantColumns, tenant_filter
from ..operators.workitems import row_items

LOG_COLS = ["seq", "op", "assistant_id", "user_id", "memory_id", "content"]
SNAPSHOT_SCHEMA = ("assistant_id string, memory_id string, owner string, add_seq long, content string, "
                   "content_seq long, del_seq long")


def governed_stream(stream: DataFrame, spec: TenantColumns, ctx: AccessContext) -> DataFrame:
    return tenant_filter(stream, spec, ctx)


def audit_stream(stream: DataFrame, query_col: str = "query") -> DataFrame:
    return audit_queries(stream, query_col)


def items_stream(stream: DataFrame) -> DataFrame:
    return row_items(stream)


def snapshot_to_log(snap: DataFrame) -> DataFrame:
    """Previous state → the log rows that reproduce it (add, last content, delete)."""
    base = snap.select("assistant_id", "memory_id", F.col("owner").alias("user_id"), "add_seq", "content",
                       "content_seq", "del_seq")
    adds = base.select(F.col("add_seq").alias("seq"), F.lit("add").alias("op"), "assistant_id", "user_id",
                       "memory_id", "content")
    upds = base.filter(F.col("content_seq") > F.col("add_seq")).select(
        F.col("content_seq").alias("seq"), F.lit("update").alias("op"), "assistant_id", "user_id", "memory_id",
        "content")
    dels = base.filter(F.col("del_seq").isNotNull()).select(
        F.col("del_seq").alias("seq"), F.lit("delete").alias("op"), "assistant_id", "user_id", "memory_id",
        F.lit(None).cast("string").alias("content"))
    return adds.unionByName(upds).unionByName(dels)


def status_to_snapshot(status: DataFrame) -> DataFrame:
    """Per id: owner and add seq, latest content and its seq, delete seq (tombstones kept)."""
    g = status.groupBy(*memory.KEY).agg(
        F.min(F.when(F.col("status") == "added", F.col("seq"))).alias("add_seq"),
        F.min_by(F.when(F.col("status") == "added", F.col("user_id")),
                 F.when(F.col("status") == "added", F.col("seq"))).alias("owner"),
        F.max(F.when(F.col("status").isin("added", "updated"), F.struct("seq", "content"))).alias("last"),
        F.min(F.when(F.col("status") == "deleted", F.col("seq"))).alias("del_seq"))
    return g.filter(F.col("add_seq").isNotNull()).select(
        *memory.KEY, "owner", "add_seq", F.col("last.content").alias("content"),
        F.col("last.seq").alias("content_seq"), "del_seq")


def latest_snapshot(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest snapshot, or the newest one older than epoch ``before`` (a replayed batch starts there)."""
    try:
        snaps = spark.read.schema(SNAPSHOT_SCHEMA + ", epoch long").parquet(root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        # first batch: nothing written yet
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)
    if before is not None:
        snaps = snaps.filter(F.col("epoch") < before)
    last = snaps.agg(F.max("epoch")).first()[0]
    if last is None:
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)
    return snaps.filter(F.col("epoch") == last).drop("epoch")


def memory_fold_batch(root: str, status_root: str | None = None):
    """foreachBatch function: fold one micro-batch of the log into the snapshot under ``root``."""

    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        prev = latest_snapshot(spark, root, before=epoch)
        batch_log = batch.select(*LOG_COLS)
        status = memory.fold_status(snapshot_to_log(prev).unionByName(batch_log))
        snap = status_to_snapshot(status)
        snap.write.mode("overwrite").parquet(f"{root}/epoch={epoch}")
        if status_root is not None:
            seqs = batch_log.select("seq")
            (status.join(seqs, "seq", "left_semi").write.mode("overwrite")
             .parquet(f"{status_root}/epoch={epoch}"))

    return fold


def live_memories(spark: SparkSession, root: str) -> DataFrame:
    """Current state from the latest snapshot: ids without a delete."""
    snap = latest_snapshot(spark, root)
    return snap.filter(F.col("del_seq").isNull()).select(
        *memory.KEY, F.col("owner").alias("user_id"), "content", F.col("content_seq").alias("last_seq"))


# --- one state per memory id ------------------------------------------------------------------

STATUS_SCHEMA = ("seq long, op string, assistant_id string, user_id string, memory_id string, content string, error string, "
                 "status string")
# of an id that was added once: its owner, the add's place in the log, and whether it was deleted since
ID_STATE = "owner string, add_seq long, gone boolean"


def _id_statuses(key, frames, state):
    """The statuses of one id's operations in a micro-batch, in log order, and its state after them."""
    ops = pd.concat(list(frames), ignore_index=True).sort_values("seq", kind="stable", ignore_index=True)
    owner, add_seq, gone = state.get if state.exists else (None, None, False)
    out = []
    for seq, op, user in zip(ops["seq"], ops["op"], ops["user_id"]):
        if op == "add":
            out.append("added" if add_seq is None else "duplicate")
            if add_seq is None:
                owner, add_seq = user, int(seq)
        elif add_seq is None or gone or user != owner or seq <= add_seq:
            out.append("not found")
        else:
            out.append("updated" if op == "update" else "deleted")
            gone = gone or op == "delete"
    if add_seq is not None:
        state.update((owner, add_seq, bool(gone)))
    yield ops.assign(status=out)


def memory_status_stream(log: DataFrame) -> DataFrame:
    """D-1 to D-3 and D-6 as a stream: the status of every operation, as ``memory.fold_status`` gives it, append mode.

    ``log`` holds LOG_COLS; other columns are left out. The state of an id is its owner, the place of its add and
    whether it was deleted; ids that were never added keep none. Searches and invalid rows, those without an id among
    them, need no state and are not shuffled. The result is that of the batch fold if no operation of an id comes in a later
    micro-batch than one behind it in the log; inside a micro-batch any order will do. A task holds one id's rows of
    one micro-batch: bound the batch with the source's rate option where one id may get very many at once.
    """
    checked = memory.mint_ids(memory.validate_ops(log.select(*LOG_COLS)))
    stateless = F.col("error").isNotNull() | (F.col("op") == "search")
    plain = checked.where(stateless).withColumn("status", F.when(F.col("error").isNotNull(), F.lit("invalid")).otherwise(F.lit("search")))
    kept = (checked.where(~stateless).groupBy(*memory.KEY)
            .applyInPandasWithState(_id_statuses, STATUS_SCHEMA, ID_STATE, "append", GroupStateTimeout.NoTimeout))
    names = [*LOG_COLS, "error", "status"]
    return kept.select(*names).unionByName(plain.select(*names))
