"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's words are hashed, five neighbouring words give a k-gram hash, and of every six neighbouring
k-grams (a span of ten words) the smallest hash is kept as a fingerprint. Equal ten-word spans have equal
k-grams and thus the same smallest one, at the same place in the span, so every shared span of ten words
shares a fingerprint: nothing is missed. Fingerprints of documents and benchmark are joined, and each hit
is extended: the ten words around it in the document must equal the ten words of the item's window.

Items of fewer than ten words (but not none) are one window each; documents are probed with all spans
of those lengths.

The benchmark's windows are broadcast up to ``broadcast_windows`` rows (checked by a count). Beyond that
the join shuffles fingerprints only and fetches the words for the documents with a hit.

Defined results: null texts have no words; null item ids mark words but are not listed; equal windows of
several items count for each; repeated rows of a document each return the same result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN, GRAM = 10, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Characters that lower() leaves alone unless they are A-Z; any other text takes the slower exact way.
CHANGED_BY_LOWER = r"[^\x00-\x7F -¿×ß-ÿ‐-‧€]"


def lower_ascii(text: Column) -> Column:
    exact = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(text.rlike(CHANGED_BY_LOWER), exact).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def grams(hashes: Column, k: int) -> Column:
    """Hashes of every k neighbouring words."""
    n = F.size(hashes)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
                  ).otherwise(F.array().cast("array<bigint>"))


def smallest(g: Column, w: int) -> Column:
    """The smallest of every w neighbouring hashes."""
    if w == 1:
        return g
    n = F.size(g)
    return F.when(n >= w, F.transform(F.sequence(F.lit(0), n - w), lambda i: F.least(*[F.get(g, i + j) for j in range(w)]))
                  ).otherwise(F.array().cast("array<bigint>"))


# The outer forms of explode are used throughout: for the inner ones Catalyst infers a filter on the array,
# pushes it below the projections and so computes every nested expression again for each element.


def fingerprinted(rows: DataFrame, span: int) -> DataFrame:
    """rows with _words -> + _g (k-gram hashes) and _m (the kept hash of each span)."""
    k = GRAM if span == SPAN else span
    rows = rows.withColumn("_h", F.transform("_words", lambda x: F.xxhash64(x)))
    rows = rows.withColumn("_g", grams(F.col("_h"), k)).drop("_h")
    return rows.withColumn("_m", smallest(F.col("_g"), span - k + 1))


def item_windows(items: DataFrame, span: int) -> DataFrame:
    """_v, _offset, _window, _items: every distinct window with its fingerprint(s) and the items that hold it."""
    w = span - (GRAM if span == SPAN else span) + 1
    f = fingerprinted(items, span)
    f = f.select("_item", "_words", "_g", F.posexplode_outer("_m").alias("_i", "_v"))
    offsets = F.filter(F.sequence(F.lit(0), F.lit(w - 1)), lambda o: F.get("_g", F.col("_i") + o) == F.col("_v"))
    f = f.select("_item", "_v", F.explode_outer(offsets).alias("_offset"), F.slice("_words", F.col("_i") + 1, span).alias("_window"))
    return f.where("_v is not null").groupBy("_v", "_offset", "_window").agg(F.collect_set("_item").alias("_items"))


def span_hits(docs: DataFrame, windows: DataFrame, span: int, small: bool) -> DataFrame:
    """_id, _hash, _start, _span, _items: verified windows of the documents (rows with _words)."""
    f = fingerprinted(docs, span)
    if small:
        f = f.select("_id", "_hash", "_words", "_g", F.explode_outer(F.array_distinct("_m")).alias("_v"))
        f = f.join(F.broadcast(windows), "_v")
    else:
        marked = (f.select("_id", "_hash", F.explode_outer(F.array_distinct("_m")).alias("_v"))
                  .join(windows.select("_v").distinct(), "_v", "left_semi")
                  .groupBy("_id", "_hash").agg(F.collect_set("_v").alias("_vs")))
        f = (f.drop("_m").dropDuplicates(["_id", "_hash"]).alias("f")
             .join(marked.alias("m"), F.col("f._id").eqNullSafe(F.col("m._id")) & (F.col("f._hash") == F.col("m._hash")))
             .select("f._id", "f._hash", "_words", "_g", F.explode("_vs").alias("_v")).join(windows, "_v"))
    places = F.filter(F.sequence(F.lit(0), F.size("_g") - 1), lambda p: F.get("_g", p) == F.col("_v"))
    f = f.select("_id", "_hash", "_words", "_window", "_items", "_offset", F.explode_outer(places).alias("_place"))
    f = f.withColumn("_start", F.col("_place") - F.col("_offset"))
    return (f.where((F.col("_start") >= 0) & (F.col("_start") + span <= F.size("_words")))
            .where(F.slice("_words", F.col("_start") + 1, span) == F.col("_window"))
            .select("_id", "_hash", "_start", F.lit(span).alias("_span"), "_items"))


def covered(hits: Column) -> Column:
    """Number of words in the union of sorted (start, span) ranges."""
    def step(acc, x):
        end = F.greatest(acc["end"], x["_start"] + x["_span"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], x["_start"])).alias("n"))

    return F.aggregate(F.array_sort(hits), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda a: a["n"].cast("long"))


def _rows(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, broadcast_windows: int):
    """The documents as words, and the verified hits of every window length that the items have."""
    d = docs.select(F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("_hash"), words(F.col(text)).alias("_words"))
    b = benchmark.select(F.col(item).cast("string").alias("_item"), words(F.col(text)).alias("_words"))
    lengths = [r[0] for r in b.select(F.least(F.size("_words"), F.lit(SPAN)).alias("n")).distinct().collect()]  # at most 11
    hits = []
    for span in sorted(n for n in lengths if n > 0):
        chosen = b.where(F.size("_words") >= SPAN) if span == SPAN else b.where(F.size("_words") == span)
        windows = item_windows(chosen, span)
        small = windows.limit(broadcast_windows + 1).count() <= broadcast_windows
        hits.append(span_hits(d, windows, span, small))
    return d, hits


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                       broadcast_windows: int = 500_000) -> DataFrame:
    """_id and _hash (xxhash64 of the text) of the documents with a hit, once each."""
    d, hits = _rows(docs, benchmark, key, text, item, broadcast_windows)
    found = d.select("_id", "_hash").where(F.lit(False))
    for h in hits:
        found = found.unionByName(h.select("_id", "_hash"))
    return found.distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  broadcast_windows: int = 500_000) -> DataFrame:
    """key, n_words, n_hit, n_items, items (sorted texts), contaminated for every row of docs."""
    d, hits = _rows(docs, benchmark, key, text, item, broadcast_windows)
    base = d.select("_id", "_hash", F.size("_words").alias("_n"), F.lit(1).alias("_row"))
    parts = [base.select("_id", "_hash", "_n", "_row", F.lit(None).cast("struct<_start:int,_span:int>").alias("_hit"),
                         F.lit(None).cast("array<string>").alias("_items"))]
    for h in hits:
        parts.append(h.select("_id", "_hash", F.lit(None).cast("int").alias("_n"), F.lit(0).alias("_row"),
                              F.struct("_start", "_span").alias("_hit"), "_items"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    per = rows.groupBy("_id", "_hash").agg(F.max("_n").alias("_n"), F.sum("_row").cast("int").alias("_copies"),
                                           F.collect_set("_hit").alias("_hits"), F.collect_set("_items").alias("_lists"))
    out = per.select(F.col("_id").alias(key), F.col("_n").cast("long").alias("n_words"), covered(F.col("_hits")).alias("n_hit"),
                     F.array_sort(F.array_distinct(F.flatten("_lists"))).alias("items"), "_copies")
    out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).drop("_copy", "_copies")
    return out.select(key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                      (F.col("n_hit") > 0).alias("contaminated"))
