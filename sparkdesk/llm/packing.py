"""Lexical retrieval packing: windows of related documents, found with a sharded BM25 inverted index.

1. Every text is encoded once (its ids, then the end id). A document fills whole windows by itself; what is left over,
   its *tail* (shorter than a window), is packed with other tails. Terms are vocabulary ids, so document frequencies, document
   count and mean length over all tails are at most one number per vocabulary entry.
2. A tail is routed by its rarest term that at least ``min_df`` tails hold. Routes are laid end to end by their tokens and
   cut into shards of about ``shard_tokens``; a route that holds more than a shard spreads its rows over several.
3. Each shard builds an inverted index of its tails (BM25 weights with the global statistics). The next unused tail is the
   seed of a window: its ``query_terms`` heaviest terms are looked up, and unused tails fill the window in order of score (then
   of row). The tail that crosses the window's end is cut there, and its rest is the next seed, so windows are full. What is
   left at the end of a shard is cut into sequences of power-of-two lengths: nothing is padded.

Defined results: a null or empty text is its end id alone. Rows with the same or a null id are packed one by one; rows of pieces
carry the id only. An empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import load_model, with_classes
from .bpe_batch import batch_encoder, point_classes
from .common import mix64, written
from .encoding import WORD_LEVEL, inner_pairs

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = [c.split(" ")[0] for c in PIECE.split(", ")]
BATCH_BYTES = 4 << 20
K1, B = 1.2, 0.75


def id_count(path: str, end_id: int) -> int:
    model = load_model(path)
    return max(*model["vocab"].values(), *model["specials"].values(), end_id) + 1


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(batches: Iterator[pd.DataFrame], path: str, shipped, end_id: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(document ids, id arrays with the end id), a few megabytes of text at a time."""
    encoder = batch_encoder(path, *shipped)
    for pdf in batches:
        keys, texts, held = [], [], 0
        for key, text in zip(pdf["doc_id"].astype(object), pdf["text"], strict=True):
            keys.append(None if pd.isna(key) else int(key))
            texts.append(text or "")
            held += len(texts[-1])
            if held > BATCH_BYTES:
                yield keys, [np.append(x, end_id) for x in encoder.encode_all(texts)]
                keys, texts, held = [], [], 0
        if keys:
            yield keys, [np.append(x, end_id) for x in encoder.encode_all(texts)]


def tails_and_windows(path: str, window: int, end_id: int):
    """Task function: tail rows (ids as bytes), the pieces of whole windows, and at the end the task's document frequencies."""
    size = id_count(path, end_id)
    shipped = (with_classes(WORD_LEVEL), inner_pairs(path), point_classes())
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 33
        sequence, df, tokens, tails = row, np.zeros(size, np.int64), 0, 0
        for keys, ids in encoded(batches, path, shipped, end_id):
            out = []
            for key, x in zip(keys, ids, strict=True):
                whole = len(x) - len(x) % window
                for s in range(0, whole, window):
                    out.append((key, s, window, crc(x[s:s + window]), len(x), 2 * sequence, 0, None, None))
                    sequence += 1
                if whole < len(x):
                    tail = x[whole:]
                    df[np.unique(tail)] += 1
                    tokens, tails = tokens + len(tail), tails + 1
                    out.append((key, whole, len(tail), None, len(x), None, None, row, tail.astype(kind).tobytes()))
                row += 1
            yield pd.DataFrame(out, columns=[*COLUMNS, "row", "ids"], dtype=object).assign(counts=None)
        counts = [*df.tolist(), tails, tokens]
        yield pd.DataFrame({c: None for c in [*COLUMNS, "row", "ids"]}, index=[0], dtype=object).assign(counts=[counts])

    return run, kind


class Index:
    """BM25 inverted index of one shard's tails."""

    def __init__(self, ids: np.ndarray, size: np.ndarray, idf: np.ndarray, mean: float, query_terms: int):
        v = len(idf)
        uniq, tf = np.unique(np.repeat(np.arange(len(size)), size) * v + ids, return_counts=True)
        doc, term = np.divmod(uniq, v)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[doc] / mean))
        by_term = np.argsort(term, kind="stable")
        self.docs, self.weights, self.n = doc[by_term], weight[by_term], len(size)
        self.first = np.searchsorted(term[by_term], np.arange(v + 1))
        heavy = np.lexsort((term, -weight, doc))
        begin = np.searchsorted(doc, np.arange(len(size) + 1))
        self.query = [term[heavy[a:min(b, a + query_terms)]] for a, b in zip(begin[:-1], begin[1:], strict=True)]

    def scores(self, doc: int) -> np.ndarray:
        lists = [slice(self.first[t], self.first[t + 1]) for t in self.query[doc]]
        return np.bincount(np.concatenate([self.docs[s] for s in lists]), np.concatenate([self.weights[s] for s in lists]), minlength=self.n)


def fill_windows(index: Index, size: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (tail, from, length). All but the last are full."""
    unused, windows, nearest = np.ones(len(size), bool), [], 0
    carry = None
    while True:
        while nearest < len(size) and not unused[nearest]:
            nearest += 1
        if carry is None:
            if nearest == len(size):
                return windows
            carry, unused[nearest] = (nearest, 0), False
        seed, start = carry
        now, room, carry = [(seed, start, int(size[seed]) - start)], window - int(size[seed]) + start, None
        score = np.where(unused, index.scores(seed), -1.0)
        while room:
            best = int(score.argmax())
            if score[best] < 0:
                break
            take = min(int(size[best]), room)
            now.append((best, 0, take))
            unused[best], score[best], room = False, -1.0, room - take
            if take < size[best]:
                carry = (best, take)
        windows.append(now)


def power_lengths(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def cut_to(parts: list[tuple[int, int, int]], lengths: list[int]) -> list[list[tuple[int, int, int]]]:
    """The parts, in order, as sequences of just these lengths."""
    out, rest = [], list(reversed(parts))
    for room in lengths:
        out.append([])
        while room:
            tail, start, n = rest.pop()
            take = min(n, room)
            out[-1].append((tail, start, take))
            room -= take
            if take < n:
                rest.append((tail, start + take, n - take))
    return out


def pack_shard(pdf: pd.DataFrame, kind: str, idf: np.ndarray, mean: float, window: int, query_terms: int) -> pd.DataFrame:
    pdf = pdf.sort_values("row", ignore_index=True)
    ids = [np.frombuffer(x, kind).astype(np.int64) for x in pdf["ids"]]
    size = np.array([len(x) for x in ids])
    windows = fill_windows(Index(np.concatenate(ids), size, idf, mean, query_terms), size, window)
    left = sum(n for *_, n in windows[-1])
    if left < window:
        windows[-1:] = cut_to(windows[-1], power_lengths(left))
    keys, starts, totals = pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None).tolist(), pdf["start"].tolist(), pdf["doc_tokens"].tolist()
    base, out = int(pdf["shard"].iloc[0]) << 24, []
    for k, parts in enumerate(windows):
        offset = 0
        for tail, s, n in parts:
            out.append((keys[tail], starts[tail] + s, n, crc(ids[tail][s:s + n]), totals[tail], 2 * (base + k) + 1, offset))
            offset += n
    return pd.DataFrame(out, columns=COLUMNS, dtype=object)


def route_of(flat: np.ndarray, size: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """The rarest common enough term of each tail, as its place in the order of rarity."""
    return np.minimum.reduceat(rarity[flat], np.cumsum(size) - size)


def pack(docs: DataFrame, path: str, end_id: int, window: int = 2048, shard_tokens: int = 1_000_000, query_terms: int = 32, min_df: int = 4,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    spark = docs.sparkSession
    first, kind = tails_and_windows(path, window, end_id)
    made = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(first, PIECE + ", row long, ids binary, counts array<long>")
    made = written(made, "packing-tails")
    sums = made.where("counts is not null").select(F.posexplode("counts").alias("term", "n")).where("n > 0").groupBy("term").agg(F.sum("n").alias("n"))
    found = sums.toPandas()  # at most one row per vocabulary entry
    size = id_count(path, end_id)
    df = np.zeros(size + 2)
    df[found["term"]] = found["n"]
    tails, tokens = df[size], df[size + 1]
    df = df[:size]
    idf, mean = np.log1p((tails - df + 0.5) / (df + 0.5)), tokens / max(tails, 1)
    rarity = np.empty(size, np.int64)
    rarity[np.lexsort((np.arange(size), df, df < min_df))] = np.arange(size)

    tail = made.where("row is not null").select("row", "doc_id", "start", "doc_tokens", "ids")

    def arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(x) for x in pdf["ids"]]) // np.dtype(kind).itemsize
        return route_of(np.frombuffer(b"".join(pdf["ids"]), kind), lengths, rarity), lengths

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                route, lengths = arrays(pdf)
                total = np.bincount(route, lengths)
                yield pd.DataFrame({"route": np.flatnonzero(total), "tokens": total[total > 0].astype(np.int64)})

    loads = tail.select("ids").mapInPandas(weigh, "route long, tokens long").groupBy("route").agg(F.sum("tokens").alias("tokens")).toPandas()
    load = np.zeros(size)
    load[loads["route"]] = loads["tokens"]
    begin = np.cumsum(load) - load

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                route, _ = arrays(pdf)
                part = (mix64(pdf["row"].to_numpy().astype(np.uint64)) >> np.uint64(11)) / float(1 << 53)
                yield pdf.assign(shard=((begin[route] + part * load[route]) // shard_tokens).astype(np.int64))

    schema = "row long, doc_id long, start long, doc_tokens long, ids binary, shard long"
    packed = tail.mapInPandas(shard, schema).groupBy("shard").applyInPandas(lambda pdf: pack_shard(pdf, kind, idf, mean, window, query_terms), PIECE)
    return made.where("row is null and counts is null").select(COLUMNS).union(packed)
