"""Line dedup by sharded minimal perfect hashes.

1. Every document gives the 128-bit hashes of its distinct long lines; they are counted with map-side
   combining (number of documents, largest document id). Lines below ``min_docs`` are dropped.
2. The rest is cut into shards by hash. Each shard gets a minimal perfect hash (levels of collision-free
   bits with ranks) that numbers its keys 0..n-1, and three arrays in that order: a 64-bit fingerprint,
   the document count and the largest document id.
3. Documents probe the arrays: hash the line, look up its number, compare the fingerprint, decide.

Up to ``broadcast_keys`` indexed lines (32 bytes each) the arrays are broadcast. Beyond that the
probes travel: they meet their shard's arrays in groups of about ``group_probes``, and only the lines to drop
come back.

Defined results: null and empty texts are one empty line. Every row counts as a document, repeated rows
too; a null id sorts below every other. Rows that share the largest id all keep the line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, written

STRIP = " \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)
KEYS_PER_SHARD = 50_000


def long_line_hashes(text: str, min_chars: int) -> list[tuple[int, int, int]]:
    """(line number, high hash, low hash) of the lines whose key has at least min_chars code points."""
    import xxhash

    out = []
    for k, line in enumerate(text.split("\n")):
        key = line.strip(STRIP)
        if len(key) >= min_chars:
            h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass").lower())
            out.append((k, h >> 64, h & 0xFFFFFFFFFFFFFFFF))
    return out


class PerfectHash:
    """A minimal perfect hash over 128-bit keys: each level keeps the keys that fall alone on a bit."""

    def __init__(self, levels: list[bytes], sizes: list[int]):
        self.sizes = sizes
        self.bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=s).astype(bool) for b, s in zip(levels, sizes, strict=True)]
        ranks = np.cumsum([0, *(int(b.sum()) for b in self.bits)])
        self.numbers = [np.cumsum(b) - 1 + r for b, r in zip(self.bits, ranks, strict=False)]

    @staticmethod
    def at(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(high + low * np.uint64(2 * level + 1) + np.uint64(level)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels, sizes, left = [], [], np.arange(len(high))
        while len(left):
            size = max(64, 2 * len(left))
            pos = cls.at(high[left], low[left], len(sizes), size)
            alone = np.bincount(pos, minlength=size)[pos] == 1
            bits = np.zeros(size, bool)
            bits[pos[alone]] = True
            levels.append(np.packbits(bits).tobytes())
            sizes.append(size)
            left = left[~alone]
        return cls(levels, sizes)

    def lookup(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each key; for a key that was not indexed any number, or -1."""
        out = np.full(len(high), -1)
        open_ = np.arange(len(high))
        for level, (bits, numbers, size) in enumerate(zip(self.bits, self.numbers, self.sizes, strict=True)):
            pos = self.at(high[open_], low[open_], level, size)
            hit = bits[pos]
            out[open_[hit]] = numbers[pos[hit]]
            open_ = open_[~hit]
        return out


def as_u64(values) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def index_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """The perfect hash and the arrays of one shard."""
    high, low = as_u64(pdf["high"]), as_u64(pdf["low"])
    ph = PerfectHash.build(high, low)
    order = np.argsort(ph.lookup(high, low))
    return pd.DataFrame({
        "shard": [int(pdf["shard"].iloc[0])], "sizes": [ph.sizes],
        "levels": [[np.packbits(b).tobytes() for b in ph.bits]],
        "fingerprints": [low[order].tobytes()],
        "counts": [pdf["n_docs"].to_numpy(np.int64)[order].tobytes()],
        "largest": [pdf["largest"].to_numpy(np.int64)[order].tobytes()]})


INDEX = "shard long, sizes array<long>, levels array<binary>, fingerprints binary, counts binary, largest binary"


class Shard:
    """One shard's arrays, as a probe sees them."""

    def __init__(self, row):
        self.hash = PerfectHash([bytes(b) for b in row["levels"]], [int(s) for s in row["sizes"]])
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.largest = np.frombuffer(row["largest"], np.int64)

    def dropped(self, high: np.ndarray, low: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which lines (with the id of the document that asks) are indexed and kept by a larger id."""
        at = self.hash.lookup(high, low)
        out = np.zeros(len(at), bool)
        found = np.flatnonzero(at >= 0)
        found = found[self.fingerprints[at[found]] == low[found]]
        out[found] = self.largest[at[found]] != ids[found]
        return out


def frequent_lines(docs: DataFrame, key: str, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """high, low, n_docs, largest of every long line that enough documents hold."""

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(h, l, i) for i, t in zip(pdf["id"], pdf["text"], strict=True) if t
                    for h, l in {(h, l) for _, h, l in long_line_hashes(t, min_chars)}]
            a = np.array([r[:2] for r in rows], np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"high": a[:, 0], "low": a[:, 1], "id": [r[2] for r in rows]})

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    return (rows.mapInPandas(hashes, "high long, low long, id long").groupBy("high", "low")
            .agg(F.count("*").alias("n_docs"), F.max("id").alias("largest")).where(F.col("n_docs") >= min_docs))


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    return lines.withColumn("shard", F.pmod("high", F.lit(shards))).groupBy("shard").applyInPandas(index_shard, INDEX)


def keep_lines(text: str | None, drop: set[int] | np.ndarray) -> tuple[int, int, str]:
    lines = (text or "").split("\n")
    gone = set(drop)
    return len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else (text or "")


SHAPE = "n_lines long, n_dropped long, kept string"


def _by_broadcast(docs: DataFrame, index: DataFrame, shards: int, min_chars: int) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in index.collect()])

    @F.pandas_udf(SHAPE)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        arrays = {r["shard"]: Shard(r) for r in shipped.value}
        for ids, texts in batches:
            found = [(n, *h, i) for n, (i, t) in enumerate(zip(ids, texts, strict=True)) if t for h in long_line_hashes(t, min_chars)]
            high, low = (np.array([f[c] for f in found], np.uint64) for c in (2, 3))
            owner = np.array([f[4] for f in found], np.int64)
            shard = np.mod(high.view(np.int64), shards)
            drop = np.zeros(len(found), bool)
            for s in np.unique(shard):
                if s in arrays:
                    mine = shard == s
                    drop[mine] = arrays[s].dropped(high[mine], low[mine], owner[mine])
            gone: dict[int, list[int]] = {}
            for k in np.flatnonzero(drop):
                gone.setdefault(found[k][0], []).append(found[k][1])
            yield pd.DataFrame([keep_lines(t, gone.get(n, ())) for n, t in enumerate(texts)], columns=["n_lines", "n_dropped", "kept"])

    return docs.withColumn("_r", run("_id", "_text"))


def _by_routing(docs: DataFrame, index: DataFrame, shards: int, min_chars: int, group_probes: int) -> DataFrame:
    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, k, n, h, l) for i, k, t in zip(pdf["_id"], pdf["_hash"], pdf["_text"], strict=True) if t
                    for n, h, l in long_line_hashes(t, min_chars)]
            a = np.array([r[3:] for r in rows], np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"_id": [r[0] for r in rows], "_hash": [r[1] for r in rows], "line": [r[2] for r in rows],
                                "high": a[:, 0], "low": a[:, 1]})

    def answer(asked: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(arrays):
            return asked.iloc[:0][["_id", "_hash", "line"]]
        drop = Shard(arrays.iloc[0]).dropped(as_u64(asked["high"]), as_u64(asked["low"]), asked["_id"].to_numpy(np.int64))
        return asked.loc[drop, ["_id", "_hash", "line"]]

    asked = written(docs.select("_id", "_hash", "_text").mapInPandas(probes, "_id long, _hash long, line long, high long, low long")
                    .distinct().withColumn("shard", F.pmod("high", F.lit(shards))), "line-probes")
    # a shard that a hot line sends many probes to is met in as many groups as they fill
    groups = asked.groupBy("shard").count().select("shard", F.ceil(F.col("count") / group_probes).cast("long").alias("salts"))
    asked = asked.join(groups, "shard").withColumn("salt", F.pmod(F.xxhash64("_id", "_hash", "line"), "salts")).drop("salts")
    spread = index.join(groups, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    gone = (asked.groupBy("shard", "salt").cogroup(spread.groupBy("shard", "salt"))
            .applyInPandas(answer, "_id long, _hash long, line long")
            .groupBy("_id", "_hash").agg(F.collect_set("line").alias("_gone")))

    @F.pandas_udf(SHAPE)
    def run(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([keep_lines(t, () if g is None else [int(x) for x in g]) for t, g in zip(texts, gone, strict=True)],
                            columns=["n_lines", "n_dropped", "kept"])

    joined = docs.join(gone, ["_id", "_hash"], "left")
    return joined.withColumn("_r", run("_text", "_gone")).drop("_gone")


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, key: str = "doc_id", text: str = "text",
                broadcast_keys: int = 1_000_000, group_probes: int = 200_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """key, carried columns, n_lines, n_dropped, kept for every row."""
    lines = written(frequent_lines(docs, key, text, min_docs, min_chars), "frequent-lines")
    n = lines.count()
    shards = max(1, -(-n // KEYS_PER_SHARD))
    index = written(build_index(lines, shards), "line-index")
    rows = docs.select(F.struct(key, *carry).alias("_row"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("_id"),
                       F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_hash"))
    out = (_by_broadcast(rows, index, shards, min_chars) if n <= broadcast_keys
           else _by_routing(rows, index, shards, min_chars, group_probes))
    return out.select("_row.*", "_r.*")
