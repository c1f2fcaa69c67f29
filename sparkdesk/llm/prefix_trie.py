"""Prefix trie of conversations by padded turn-id matrices.

1. Turns become (digest of role and text, words) in the scan; texts do not travel. Conversations are gathered as lists of these
   small records, and the head that a conversation shares with its base is put before its own turns.
2. The sequences are range-partitioned by (turn digests, conversation id) and sorted, so equal beginnings lie together and
   a beginning that most conversations share spreads over many partitions.
3. Every partition is cut, in order, into *shards* of at most ``cells`` matrix cells. A shard numbers its turn digests and
   writes them into a matrix padded with -1. np.lexsort orders the rows; column-change masks, OR-accumulated from left to right,
   mark where the nodes of each depth start; reduceat sums the members, children, leaves and saved tokens of all nodes of a depth.
4. Nodes on the path of a shard's first or last row may go on in the next shard. Their partial sums (two paths for each shard) are
   recombined by node; all other nodes are final. The ids that end at a node are streamed into its hash in ascending order.

Only one row per shard and depth reaches the recombining task; a conversation is one row (16 bytes a turn), as a text is one row of
documents.

Defined results: a null role or text is empty; turns are ordered by turn (null first), then by digest; repeated rows are turns
of their own; rows with a null conversation id belong to no conversation and are left out. An empty table gives
no nodes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fits
from .common import written

CELLS = 4_000_000
PIECE = 10_000  # ids in one string of ids
NODE = ("key binary, parent_key binary, edge boolean, parent_edge boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, words long, ends_sha256 string, first long, ends string")
COLUMNS = [c.split(" ")[0] for c in NODE.split(", ")]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def node_key(sequence: bytes) -> bytes:
    return hashlib.md5(sequence, usedforsecurity=False).digest()


def turn_lists(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns: its turns in order as structs (turn, id, words)."""
    said, who = F.coalesce(text, F.lit("")), F.coalesce(role, F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary"))).alias("id"),
        F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))


def with_shared_heads(lists: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Each conversation with the first ``head`` (at most ``most``) turns of conversation ``base`` (none if absent) in place of its own first ones."""
    bases = lists.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    rows = lists.withColumn("_h", head).withColumn("_of", base).join(bases, F.col("_of") == F.col("_base"), "left")
    own = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return rows.select("conv_id", F.when(F.col("_head").isNull(), own).otherwise(F.concat(F.slice("_head", F.lit(1), F.col("_h")), own)).alias("turns"))


def matrix_nodes(ids: list[bytes], words: list, convs: np.ndarray) -> Iterator[pd.DataFrame]:
    """The nodes of one shard, a frame per depth. Those on the first and last row's paths are ``edge`` nodes: their sums leave out
    what edge nodes add, and the ids that end there follow as pieces of text (rows without n_convs)."""
    length = np.array([len(x) // 16 for x in ids])
    rows, width = len(ids), int(length.max())
    inside = np.arange(width) < length[:, None]
    m, w = np.full((rows, width), -1, np.int64), np.zeros((rows, width), np.int64)
    if width:
        m[inside] = np.unique(np.frombuffer(b"".join(ids), "S16"), return_inverse=True)[1]  # numbered in byte order
        w[inside] = np.concatenate([np.asarray(x, np.int64) for x in words])
    order = np.lexsort([convs, *m.T[::-1]])
    m, w, convs, length = m[order], w[order], convs[order], length[order]
    first, last = ids[order[0]], ids[order[-1]]
    change = np.ones((rows, width + 1), bool)  # column d: a node of depth d starts here, or would if the row were long enough
    change[1:, 0] = False
    change[1:, 1:] = np.logical_or.accumulate(m[1:] != m[:-1], axis=1)
    leaves, saved, child = (np.zeros(rows, np.int64) for _ in range(3))  # of the deeper nodes that are no edge, at the rows where they start
    starts = np.flatnonzero(change[:, width])
    for d in range(width, -1, -1):
        up = np.flatnonzero(change[:, max(d - 1, 0)])
        size, up_end = np.diff(starts, append=rows), np.append(up[1:], rows)
        edge, up_edge = (starts == 0) | (starts + size == rows), (up == 0) | (up_end == rows)
        of, up_keys = np.searchsorted(up, starts, side="right") - 1, {}
        last_words = w[starts, d - 1] if d else np.zeros(1, np.int64)
        member = m[starts, d - 1] >= 0 if d else np.ones(1, bool)
        kids = np.add.reduceat(child, starts)
        inner = starts[member & ~edge]
        child[:] = 0
        child[inner] = 1
        leaves[inner] += kids[member & ~edge] == 0
        saved[inner] += ((size - 1) * last_words)[member & ~edge]
        ends = np.add.reduceat((length == d).astype(np.int64), starts)  # the shorter rows come first
        over = up_edge[of] & (d > 0)
        on = np.flatnonzero(edge).tolist()
        keys, tops, hashes, pieces = [None] * len(starts), [None] * len(starts), [NO_ENDS] * len(starts), []
        for k in on:
            keys[k] = node_key((first if starts[k] == 0 else last)[:16 * d])
        for k in np.flatnonzero(over).tolist():
            tops[k] = up_keys[of[k]] if of[k] in up_keys else up_keys.setdefault(of[k], node_key((first if up[of[k]] == 0 else last)[:16 * (d - 1)]))
        for k in np.flatnonzero(member & (ends > 0)).tolist():
            here = list(map(str, convs[starts[k]:starts[k] + ends[k]].tolist()))
            if edge[k]:
                pieces += [{"key": keys[k], "first": int(here[p]), "ends": ",".join(here[p:p + PIECE])} for p in range(0, len(here), PIECE)]
            else:
                hashes[k] = hashlib.sha256(",".join(here).encode()).hexdigest()
        yield pd.DataFrame({
            "key": keys, "parent_key": tops, "edge": edge, "parent_edge": over, "conv_id": np.minimum.reduceat(convs, starts), "depth": d,
            "parent_conv_id": pd.array(np.minimum.reduceat(convs, up)[of], dtype="Int64"), "n_convs": size, "n_children": kids,
            "n_leaves": np.add.reduceat(leaves, starts), "saved_tokens": np.add.reduceat(saved, starts), "words": last_words, "ends_sha256": hashes,
            "first": None, "ends": None})[member]
        if pieces:
            yield pd.DataFrame(pieces, columns=COLUMNS, dtype=object)
        starts = up


def shard_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cuts a sorted partition into shards of at most CELLS matrix cells."""
    ids, words, convs, width = [], [], [], 1
    for pdf in batches:
        for c, x, n in zip(pdf["conv_id"].tolist(), pdf["ids"], pdf["words"], strict=True):
            wide = max(width, len(x) // 16)
            if ids and (len(ids) + 1) * wide > CELLS:
                yield from matrix_nodes(ids, words, np.array(convs, np.int64))
                ids, words, convs, wide = [], [], [], max(1, len(x) // 16)
            width = wide
            ids.append(bytes(x))
            words.append(n)
            convs.append(c)
    if ids:
        yield from matrix_nodes(ids, words, np.array(convs, np.int64))


def recombine(pdf: pd.DataFrame) -> pd.DataFrame:
    """Edge nodes, their partial sums added over the shards: what edge nodes themselves add goes up to their parents, deepest first."""
    nodes = {r["key"]: r | {"more": np.zeros(2, np.int64)} for r in pdf.sort_values("depth", ascending=False).to_dict("records")}
    for r in nodes.values():
        r["more"] += (r["n_children"] == 0, (r["n_convs"] - 1) * r["words"])
        top = nodes.get(r["parent_key"])
        r["parent_conv_id"] = top["conv_id"] if top else None
        if top:
            top["n_children"] += 1
            top["more"] += r["more"]
    for r in nodes.values():
        leaves, saved = r.pop("more").tolist()
        r["n_leaves"] += leaves
        r["saved_tokens"] += saved
    out = pd.DataFrame(list(nodes.values()), columns=pdf.columns)
    out["parent_conv_id"] = out["parent_conv_id"].astype("Int64")
    return out


def hashed_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, sha256 of its pieces joined by commas), from pieces sorted by key and first id; one running hash at a time."""
    key, running = None, None
    for pdf in batches:
        done = []
        for k, text in zip(pdf["key"], pdf["ends"], strict=True):
            if k == key:
                running.update(b",")
            else:
                if running:
                    done.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256()
            running.update(text.encode())
        yield pd.DataFrame(done, columns=["key", "ends_sha256"])
    if running:
        yield pd.DataFrame([(key, running.hexdigest())], columns=["key", "ends_sha256"])


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """conv_id, turns (structs with id and words) -> one row per distinct beginning: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    flat = sequences.select("conv_id", F.coalesce(F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")), F.lit(b"")).alias("ids"),
                            F.transform("turns", lambda t: t["words"]).alias("words"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(flat, "trie-rows").repartitionByRange(parts, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    nodes = written(ranged.mapInPandas(shard_nodes, NODE), "trie-nodes")
    edges = nodes.where("edge").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("words").alias("words"))
    edges = written(edges.groupBy().applyInPandas(recombine, edges.schema), "trie-edges")
    pieces = nodes.where("ends is not null").select("key", "first", "ends").repartition("key").sortWithinPartitions("key", "first")
    hashes = pieces.select("key", "ends").mapInPandas(hashed_ends, "key binary, ends_sha256 string")
    top = edges.join(hashes, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).select(OUT)
    inner = nodes.where("not edge and n_convs is not null")
    above = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    above = F.broadcast(above) if fits(above, 200_000) else above
    under = inner.where("parent_edge").join(above, "parent_key").withColumn("parent_conv_id", F.col("_above"))
    return top.unionByName(inner.where("not parent_edge").select(OUT)).unionByName(under.select(OUT))
