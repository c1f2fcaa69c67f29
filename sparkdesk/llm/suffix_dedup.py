"""Repeated byte strings by run-length suffix indexes.

A byte goes when a string of ``length`` bytes (default 400) over it also starts anywhere else in the corpus.

1. **Anchors.** In every window of 400 bytes the smallest 160-byte hash (the leftmost of equals) is the
   window's anchor. Equal windows have equal anchors at the same offset, so only texts around equal anchors
   have to meet. Windows that share one anchor position form a *context* (at most 640 bytes); each
   window lies in exactly one.
2. Contexts are counted by (anchor, content hash). A context seen twice is repeated whole. An anchor with
   one context, seen once, is unique text and goes no further.
3. **Index.** Different contexts of one anchor (the edges of copies) are fetched and dealt into buckets.
   Each bucket sorts its suffixes, forms the Burrows-Wheeler transform, and keeps it as runs with the
   suffix positions sampled at run heads and run tails. The common prefix with the neighbour above is
   computed at run heads only, with the neighbour below at run tails only; between samples it falls by one
   for each byte. So one pass in text order streams the matching statistics of every position against
   all others, and starts with 400 or more are repeated.
4. Anchors with more than ``max_contexts`` different contexts (a passage that very many documents
   share, at its edges) would overfill a bucket. Their windows are halved by their distance from the anchor,
   again and again. The windows of one cell all hold the cell's *core*, so only cells with equal cores have to meet: the
   core is the new anchor, what the cell's windows cover the new context. A cell seen twice is repeated whole, a
   core with one cell is done, and few cells of one core go to the index. At one window a cell is its core.

Defined results: null and empty texts have 0 bytes; texts under 400 bytes lose nothing; a repeated row is
another place where its strings start; null ids take part. Texts of any size are read in pieces of 2**20 bytes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, pieces, written

GRAM = 160  # long enough that a common line alone brings no texts together
PIECE = 1 << 20
CONTEXTS_PER_BUCKET = 1_000
MAX_CONTEXTS = 200
BASE = np.uint64(0xD1342543DE82EF95)


class Anchors:
    """Anchor positions of a byte string, with the window starts that each one rules."""

    def __init__(self, length: int):
        self.length, self.width = length, length - GRAM + 1
        self.byte = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        inverse = pow(int(BASE), -1, 1 << 64)
        self.power = np.cumprod(np.full(n, BASE)) * np.uint64(inverse)
        self.undo = np.cumprod(np.full(n, np.uint64(inverse))) * BASE

    def __call__(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, first and last window start and place of the anchor of each context (data has at least `length` bytes)."""
        n, w = len(data), self.width
        if n > len(self.power):
            self.grow(1 << n.bit_length())
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[data] * self.power[:n], out=total[1:])
        h = mix64((total[GRAM:] - total[:-GRAM]) * self.undo[:n - GRAM + 1])
        # the position in the low bits makes the leftmost of equal hashes the smallest key
        low = np.uint64(0xFFFFFF)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        full = -(-len(key) // w) * w
        blocks = np.full(full, ~np.uint64(0))
        blocks[:len(key)] = key
        blocks = blocks.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        starts = n - self.length + 1
        at = (np.minimum(back[:starts], ahead[w - 1:w - 1 + starts]) & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        return h[at[first]], first, np.append(first[1:] - 1, starts - 1), at[first]


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


CONTEXT = "id long, th long, anchor long, ctx long, first long, last long, lead int"


def contexts(docs: DataFrame, length: int) -> DataFrame:
    """id, th, anchor, ctx, first, last, lead (bytes from the first window start to the anchor): every context of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        anchors = Anchors(length)
        for pdf in batches:
            out = []
            for i, th, text in zip(pdf["id"], pdf["th"], pdf["text"], strict=True):
                data = text_bytes(text)
                for s, e in pieces(max(0, len(data) - length + 1), PIECE):
                    part = data[s:e + length - 1]
                    h, first, last, at = anchors(part)
                    raw = memoryview(part)
                    ctx = np.array([xxhash.xxh3_64_intdigest(raw[a:b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)], np.uint64)
                    out.append((np.full(len(h), i), np.full(len(h), th), h.view(np.int64), ctx.view(np.int64), first + s, last + s, (at - first).astype(np.int32)))
            if out:
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pd.DataFrame(dict(zip(("id", "th", "anchor", "ctx", "first", "last", "lead"), columns, strict=True)))

    return docs.where(F.octet_length("text") >= length).mapInPandas(run, CONTEXT)


class RunIndex:
    """The run-compressed Burrows-Wheeler transform of some strings, with run ends sampled."""

    def __init__(self, strings: list[bytes]):
        m = len(strings)
        sizes = np.array([len(s) + 1 for s in strings])
        self.starts = np.cumsum(np.append(0, sizes[:-1]))
        # symbols: every string ends in a mark of its own, below all bytes
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + m
        text[self.starts + sizes - 1] = np.arange(m)
        self.text, n = text, len(text)
        self.ranks = {1: text}
        width, key = 1, text
        while True:
            order = np.argsort(key, kind="stable") if width > 1 else None
            if order is not None:
                step = np.append(False, key[order][1:] != key[order][:-1])
                rank = np.empty(n, np.int64)
                rank[order] = np.cumsum(step)
                self.ranks[width] = rank
                if rank[order[-1]] == n - 1:
                    break
            rank = self.ranks[width]
            after = np.zeros(n, np.int64)
            after[:n - width] = rank[width:] + 1
            key = rank * (max(n, m + 256) + 2) + after
            width *= 2
        suffixes = order
        before = text[suffixes - 1]
        new = np.append(True, before[1:] != before[:-1])
        heads, tails = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:] - 1, n - 1)
        self.runs = len(heads)
        self.head_at, self.tail_at = suffixes[heads], suffixes[tails]
        self.above = np.where(heads > 0, self.common(self.head_at, suffixes[heads - 1]), 0)
        self.below = np.where(tails < n - 1, self.common(self.tail_at, suffixes[(tails + 1) % n]), 0)

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes p and q, from the ranks of doubling widths."""
        n, out = len(self.text), np.zeros(len(p), np.int64)
        for width in sorted(self.ranks, reverse=True):
            rank = self.ranks[width]
            a, b = np.minimum(p + out, n - 1), np.minimum(q + out, n - 1)
            out += np.where((rank[a] == rank[b]) & (a != b), width, 0)
        return out

    def matching_statistics(self) -> np.ndarray:
        """For every text position, the longest match that starts at another position."""
        n = len(self.text)
        out = np.zeros(n, np.int64)
        for at, value in ((self.head_at, self.above), (self.tail_at, self.below)):
            sample = np.full(n, -1)
            sample[at] = value
            last = np.maximum.accumulate(np.where(sample >= 0, np.arange(n), 0))
            out = np.maximum(out, sample[last] - (np.arange(n) - last))
        return out


def ranges(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Sorted window starts as (from, to) byte ranges, one for each run of neighbouring starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist(), strict=True))


SPAN = "id long, th long, begin long, end long"


def index_bucket(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """One bucket: repeated ranges of the contexts that were seen once."""
    pdf = pdf.drop_duplicates(["anchor", "ctx"]).sort_values(["anchor", "ctx"])
    index = RunIndex([bytes(b) for b in pdf["data"]])
    longest = index.matching_statistics()
    rows = []
    for start, i, th, first, last, n in zip(index.starts, pdf["id"], pdf["th"], pdf["first"], pdf["last"], pdf["n"], strict=True):
        if n == 1:
            repeated = np.flatnonzero(longest[start:start + last - first + 1] >= length) + first
            rows += [(i, th, a, b) for a, b in ranges(repeated, length)]
    return pd.DataFrame(rows, columns=["id", "th", "begin", "end"], dtype="int64")


CELL = CONTEXT + ", n long, data binary"


def cells(edges: DataFrame, size: int, length: int) -> DataFrame:
    """The contexts cut at multiples of ``size`` in the distance from window start to anchor. Halving makes two rows of one at most."""
    names = [c.split()[0] for c in CELL.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for pdf in batches:
            out = []
            for i, th, anchor, first, last, lead, n, data in zip(*(pdf[c].tolist() for c in ("id", "th", "anchor", "first", "last", "lead", "n", "data")), strict=True):
                raw, low = memoryview(data), lead - (last - first)
                for c in range(low // size, lead // size + 1):
                    near, far = max(low, c * size), min(lead, (c + 1) * size - 1)
                    begin, end = lead - far, lead - near  # window starts, from the context's first one
                    core = raw[lead - c * size:lead - (c + 1) * size + 1 + length]
                    mine = raw[begin:end + length]
                    key = xxhash.xxh3_64_intdigest(core, seed=(anchor * 256 + c) & ((1 << 64) - 1))
                    out.append((i, th, key, xxhash.xxh3_64_intdigest(mine), first + begin, first + end, far, n, bytes(mine)))
            if out:
                made = pd.DataFrame(out, columns=names)
                yield made.assign(anchor=made["anchor"].astype("uint64").to_numpy().view(np.int64), ctx=made["ctx"].astype("uint64").to_numpy().view(np.int64))

    return edges.mapInPandas(run, CELL)


def refined(edges: DataFrame, length: int, max_contexts: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Contexts of crowded anchors: (repeated ranges, cells for the index)."""
    size, spans, calm = 1 << (length - GRAM).bit_length(), [], []
    while size > 1 and not edges.isEmpty():
        size //= 2
        part = written(cells(edges, size, length), "suffix-cells")
        kinds = written(part.groupBy("anchor", "ctx").agg(F.sum("n").alias("n"), F.min(F.struct("id", "th", "first", "last", "lead", "data")).alias("at")), "suffix-kinds")
        spans.append(part.where("n = 1").select("id", "th", "anchor", "ctx", "first", "last").join(kinds.where("n > 1").select("anchor", "ctx"), ["anchor", "ctx"])
                     .select("id", "th", F.col("first").alias("begin"), (F.col("last") + length).alias("end")))
        several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
        met = kinds.join(several, "anchor").select("at.*", "anchor", "ctx", "n", "kinds")
        calm.append(met.where(F.col("kinds") <= max_contexts).drop("kinds"))
        edges = met.where(F.col("kinds") > max_contexts).drop("kinds")
    return spans, calm


def fetched(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted contexts, cut out of their documents."""
    per = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("anchor", "ctx", "first", "last", "lead", "n", "crowded")).alias("wanted"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, th, text, wanted_ in zip(pdf["id"], pdf["th"], pdf["text"], pdf["wanted"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                yield pd.DataFrame([(i, th, w["anchor"], w["ctx"], w["first"], w["last"], w["lead"], w["n"], w["crowded"], data[w["first"]:w["last"] + length])
                                    for w in wanted_], columns=["id", "th", "anchor", "ctx", "first", "last", "lead", "n", "crowded", "data"])

    rows = docs.where(F.octet_length("text") >= length).join(per, ["id", "th"])
    return rows.mapInPandas(cut, CONTEXT + ", n long, crowded boolean, data binary")


def repeated_ranges(docs: DataFrame, length: int, max_contexts: int) -> DataFrame:
    """id, th, begin, end: byte ranges covered by repeated strings (ranges may overlap)."""
    all_ = written(contexts(docs, length), "suffix-contexts")
    per_anchor = (all_.groupBy("anchor").agg(F.count("*").alias("total"), (F.min("ctx") < F.max("ctx")).alias("several"))
                  .where("total > 1").select("anchor", "several"))
    repeated = written(all_.join(per_anchor, "anchor"), "suffix-repeated")
    seen = written(repeated.groupBy("anchor", "ctx", "several").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "th", "first", "last", "lead")).alias("at")), "suffix-anchors")
    whole = repeated.join(seen.where("n > 1").select("anchor", "ctx"), ["anchor", "ctx"]).select(
        "id", "th", F.col("first").alias("begin"), (F.col("last") + length).alias("end"))
    edges = seen.where("several")
    kinds = edges.groupBy("anchor").agg(F.count("*").alias("kinds"))
    edges = edges.join(kinds, "anchor").select("at.*", "anchor", "ctx", "n", (F.col("kinds") > max_contexts).alias("crowded"))
    data = written(fetched(docs, edges, length), "suffix-edges")
    spans, refined_ = refined(data.where("crowded").drop("crowded"), length, max_contexts)
    calm = functools.reduce(DataFrame.unionByName, refined_, data.where("not crowded").drop("crowded"))
    buckets = max(1, -(-calm.count() // CONTEXTS_PER_BUCKET))
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-buckets // 8))
    found = (calm.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).repartition(parts, "bucket")
             .groupBy("bucket").applyInPandas(lambda pdf: index_bucket(pdf, length), SPAN))
    return functools.reduce(DataFrame.union, spans, whole.union(found))


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((int(s["begin"]), int(s["end"])) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, length: int = 400, max_contexts: int = MAX_CONTEXTS, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """key, n_bytes, spans (removed byte ranges, maximal), kept (the remaining bytes) for every row."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    spans = repeated_ranges(rows.drop("key"), length, max_contexts).groupBy("id", "th").agg(
        F.collect_set(F.struct("begin", "end")).alias("found"))

    @F.pandas_udf("n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for t, f in zip(texts, found, strict=True):
            data = (t or "").encode("utf-8", "surrogatepass")
            gone = merged(f) if f is not None else []
            kept = [data[a:b] for a, b in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(data)], strict=True)]
            out.append((len(data), [{"begin": a, "end": b} for a, b in gone], b"".join(kept)))
        return pd.DataFrame(out, columns=["n_bytes", "spans", "kept"])

    out = rows.join(spans, ["id", "th"], "left").select("key", cut("text", "found").alias("r"))
    return out.select(F.col("key").alias(key), "r.n_bytes", "r.spans", "r.kept")
