"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct 5-word shingles; two link at Jaccard >= 0.8. Shingles are ordered by
document frequency, rarest first. If two sets of sizes n overlap in o or more shingles, then for every l their
prefixes of length n - o + l share at least l shingles. Each document picks its own l: a longer prefix costs
more list entries, but asks for more shared entries before a pair is verified. The estimate is
(entries read) x (1 + VERIFY / l); the cheapest l up to MAX_MATCH is taken, and a pair must share the smaller
of the two documents' l.

Steps, all of them Spark shuffles of packed arrays:

1. Documents with the same set are one class (a 128-bit signature), so copies are never paired.
2. Shingle hashes travel, packed by hash shard, to where frequencies are counted over all classes; only
   shingles of two or more classes go back, packed by class. A class keeps them (its *shared* shingles)
   only if they reach 80 % of its size: otherwise nothing can link to it.
   *Hot* shingles (``hot_least`` classes or more) would all meet in one shard, so they go straight to
   their classes. They are found by counts over all documents; the count need not be exact, since any
   order of shingles that all classes share gives the same links.
3. Before pairs are listed, two rounds of stars link most near copies: every class is verified against the
   leader that most of its prefix lists name. Lists whose classes are all connected by then are done.
4. In the lists that remain, every pair of classes from different components is counted, kept if it shares
   enough prefix entries, and verified. The component that holds most of a list is never paired with
   itself, so the work follows the output and no large group is squared.

Verification is exact on the shared shingles: common ones are shared by definition.

Defined results: null, empty and blank texts have no shingles (n_shingles 0) and link with nothing; fewer
than five words are one shingle; repeated rows belong to one class; a null doc_id takes part, but a
component's id is the smallest non-null one (null only if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, mix64, written
from .components import components

WORDS = 5
PERCENT = 80
MAX_MATCH = 3
VERIFY = 8.0
TOKENS_PER_SHARD = 2_000_000
CLASSES_PER_SHARD = 4_000
BATCH_TOKENS = 1_000_000
PACK_TOKENS = 400_000  # tokens a task packs for the shards at once
OFTEN = 5  # counts of a batch that are passed on
HOT_LEAST, HOT_MOST = 10_000, 200_000  # classes that make a shingle hot; length of the list of hot shingles


class Shingles:
    """The sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self.words = words
        self.hashes = Memo(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
        if not found:
            return np.zeros(0, np.uint64)
        h = np.array([self.hashes[w] for w in found], np.uint64)
        k = min(self.words, len(h))
        total = np.zeros(len(h) - k + 1, np.uint64) + np.uint64(k)
        for j in range(k):
            total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j])
        return np.unique(total)


def signature(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signed(sig: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(sig, np.int64).tolist())


def often_seen(sets: list[np.ndarray]) -> pd.DataFrame:
    """One row (often, counts): the shingles that several of a batch's sets hold."""
    h, k = np.unique(np.concatenate(sets), return_counts=True)
    many = k >= max(2, OFTEN * int(k.sum()) // BATCH_TOKENS)
    return pd.DataFrame({"id": pd.array([None], "Int64"), "n": 0, "s1": 0, "s2": 0, "often": [h[many].view(np.int64)], "counts": [k[many]]})


def described(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, n, s1, s2 of every row (the signature in two halves); besides, rows with often, counts for batches of sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, held, tokens = Shingles(), {}, 0
        for pdf in batches:
            sizes, sigs = [], []
            for t in pdf["text"]:
                s = shingles(t)
                sig = signature(s)
                sizes.append(len(s))
                sigs.append(_signed(sig))
                if len(s) and sig not in held:
                    held[sig] = s
                    tokens += len(s)
                    if tokens >= BATCH_TOKENS:
                        yield often_seen(list(held.values()))
                        held, tokens = {}, 0
            halves = np.array(sigs, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "n": sizes, "s1": halves[:, 0], "s2": halves[:, 1], "often": None, "counts": None})
        if held:
            yield often_seen(list(held.values()))

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "id long, n long, s1 long, s2 long, often array<long>, counts array<long>")


def hot_shingles(batches: DataFrame, total: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of the hot shingles: at most HOT_MOST, since all counts add up to ``total``."""
    counted = (batches.select(F.explode(F.arrays_zip("often", "counts")).alias("e")).groupBy(F.col("e.often").alias("h"))
               .agg(F.sum("e.counts").alias("k")).where(F.col("k") >= max(least, -(-total // HOT_MOST))).toPandas())
    h = counted["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], counted["k"].to_numpy(np.int64)[order]


def _pack6(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack6(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def class_buckets(sigs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(sigs) % np.uint64(buckets)).astype(np.int64)


def packed_shingles(docs: DataFrame, text: str, bits: int, buckets: int, hot) -> DataFrame:
    """Rows (shard, sigs, sizes, refs, low): the shingles of a batch of classes that fall into a shard.

    The shard is the top bits of the hash; the 48 low bits travel. Hot shingles have shards beyond those, one
    for each bucket of classes; their place in the list of hot ones travels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, held, tokens = Shingles(), {}, 0
        hot_hashes = hot.value[0]

        def flush() -> pd.DataFrame:
            sigs = np.frombuffer(b"".join(held), np.uint8).reshape(-1, 16)
            sizes = np.array([len(s) for s in held.values()], np.uint32)
            h = np.concatenate(list(held.values()))
            ref = np.repeat(np.arange(len(held)), sizes)
            shard = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
            if len(hot_hashes):
                place = np.minimum(np.searchsorted(hot_hashes, h), len(hot_hashes) - 1)
                is_hot = hot_hashes[place] == h
                h = np.where(is_hot, place.astype(np.uint64), h)
                shard = np.where(is_hot, (1 << bits) + class_buckets(sigs.view(np.uint64)[ref, 0], buckets), shard)
            order = np.argsort(shard, kind="stable")
            values, starts = np.unique(shard[order], return_index=True)
            rows = []
            for s, part in zip(values, np.split(order, starts[1:]), strict=True):
                there, local = np.unique(ref[part], return_inverse=True)
                rows.append((int(s), sigs[there].tobytes(), sizes[there].tobytes(), local.astype(np.uint16).tobytes(), _pack6(h[part])))
            return pd.DataFrame(rows, columns=["shard", "sigs", "sizes", "refs", "low"])

        for pdf in batches:
            for t in pdf["text"]:
                s = shingles(t)
                if len(s) and (sig := signature(s)) not in held:
                    held[sig] = s
                    tokens += len(s)
                    if tokens >= PACK_TOKENS or len(held) >= 60_000:
                        yield flush()
                        held, tokens = {}, 0
        if held:
            yield flush()

    return docs.select(F.col(text).alias("text")).mapInPandas(run, "shard long, sigs binary, sizes binary, refs binary, low binary")


def shared_shingles(pdf: pd.DataFrame, bits: int, buckets: int, hot: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    """One hash shard: frequencies over distinct classes; the shingles of two or more, packed by class bucket.

    A shard of hot shingles takes their frequencies from the list."""
    shard = int(pdf["shard"].iloc[0])
    sigs = np.concatenate([np.frombuffer(b, np.uint64).reshape(-1, 2) for b in pdf["sigs"]])
    sizes = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["sizes"]])
    base = np.cumsum([0, *(len(b) // 16 for b in pdf["sigs"])])
    ref = np.concatenate([np.frombuffer(b, np.uint16) + np.int32(s) for b, s in zip(pdf["refs"], base, strict=False)])
    h = np.concatenate([_unpack6(b) for b in pdf["low"]])
    _, first, cls = np.unique(sigs, axis=0, return_index=True, return_inverse=True)
    own = first.astype(np.int32)[cls.reshape(-1)]
    keep = own[ref] == ref  # a class that several batches sent counts once
    h, ref = h[keep], ref[keep]
    del keep, own, cls
    if shard >= 1 << bits:
        hashes, counts = hot
        top = (hashes >> np.uint64(64 - bits)) << np.uint64(48) if bits else np.uint64(0)
        df, h = counts[h.astype(np.int64)], ((hashes & np.uint64((1 << 48) - 1)) | top)[h.astype(np.int64)]
    else:
        order = np.argsort(h, kind="stable")
        h, ref = h[order], ref[order]
        new = np.append(True, h[1:] != h[:-1])
        df = np.diff(np.append(np.flatnonzero(new), len(h))).astype(np.uint32)[np.cumsum(new, dtype=np.int32) - 1] if len(h) else np.zeros(0, np.int64)
        many = df >= 2
        h, ref, df = h[many] | (np.uint64(shard) << np.uint64(48)), ref[many], df[many]
    bucket = class_buckets(sigs[:, 0], buckets).astype(np.int32)[ref]
    order = np.lexsort((ref, bucket))
    values, starts = np.unique(bucket[order], return_index=True)
    rows = []
    for b, part in zip(values, np.split(order, starts[1:]) if len(order) else [], strict=True):
        there, counts = np.unique(ref[part], return_counts=True)  # part is sorted by ref
        rows.append((int(b), sigs[there].tobytes(), sizes[there].tobytes(), counts.astype(np.uint32).tobytes(), h[part].tobytes(),
                     np.minimum(df[part], 0xFFFFFFFF).astype(np.uint32).tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "sigs", "sizes", "counts", "hashes", "dfs"])


def chosen_match(dfs: np.ndarray, unique: int, n: int, need: int) -> tuple[int, list[int]]:
    """The cheapest l for a class and the end of its prefix, in shared shingles, for each l up to it."""
    best, ends = (float("inf"), 1), []
    for match in range(1, min(MAX_MATCH, need) + 1):
        end = max(0, min(len(dfs), n - need + match - unique))
        ends.append(end)
        best = min(best, (float(dfs[:end].sum()) * (1 + VERIFY / match), match))
    return best[1], ends[:best[1]]


def prefixes(pdf: pd.DataFrame) -> pd.DataFrame:
    """One class bucket: classes that can link, with their shared shingles and their prefix entries."""
    sigs = np.concatenate([np.frombuffer(b, np.uint64).reshape(-1, 2) for b in pdf["sigs"]])
    sizes = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["sizes"]])
    counts = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["counts"]])
    h = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["hashes"]])
    df = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["dfs"]])
    uniq, first, cls = np.unique(sigs, axis=0, return_index=True, return_inverse=True)
    owner = np.repeat(cls.reshape(-1), counts)
    order = np.lexsort((h, df, owner))
    h, df, owner = h[order], df[order], owner[order]
    cut = np.searchsorted(owner, np.arange(len(uniq) + 1))
    rows = []
    for c in range(len(uniq)):
        n = int(sizes[first[c]])
        need = -(-PERCENT * n // 100)
        mine, f = h[cut[c]:cut[c + 1]], df[cut[c]:cut[c + 1]]
        if len(mine) < need:
            continue
        match, ends = chosen_match(f.astype(np.int64), n - len(mine), n, need)
        level = np.searchsorted(ends, np.arange(ends[-1]), side="right") + 1
        rows.append((int(pdf["bucket"].iloc[0]) << 32 | c, *uniq[c].view(np.int64).tolist(), n, match,
                     np.sort(mine).tobytes(), mine[:ends[-1]].view(np.int64).copy(), level.astype(np.int32)))
    return pd.DataFrame(rows, columns=["cid", "s1", "s2", "n", "match", "shared", "entries", "levels"])


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose Jaccard similarity reaches the threshold."""

    @F.pandas_udf("boolean")
    def links(x: pd.Series, y: pd.Series, nx: pd.Series, ny: pd.Series) -> pd.Series:
        out = []
        for p, q, n, m in zip(x, y, nx, ny, strict=True):
            common = len(np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True))
            out.append(100 * common >= PERCENT * (n + m - common))
        return pd.Series(out, dtype=bool)

    a = classes.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("shared").alias("xa"))
    b = classes.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("xb"))
    return pairs.join(a, "a").join(b, "b").where(links("xa", "xb", "na", "nb")).select("a", "b")


def mixed_lists(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries with their component, in the lists that still hold several components, and each list's largest."""
    e = entries.withColumn("comp", F.col("cid"))
    if labels is not None:
        e = entries.join(labels, entries["cid"] == labels["node"], "left").withColumn("comp", F.coalesce("label", "cid")).drop("node", "label")
    lists = (e.groupBy("token", "comp").agg(F.count("*").alias("k")).groupBy("token")
             .agg(F.count("*").alias("comps"), F.max(F.struct("k", "comp")).alias("top")).where("comps > 1")
             .select("token", F.col("top.comp").alias("largest")))
    return e.join(lists, "token")


def star_pairs(entries: DataFrame, round_: int) -> DataFrame:
    """Each class with the leader that most of its lists name (one pair for each class at most).

    A list's leader is its class with the fewest shingles of its own, which among near copies is the one
    nearest to their source."""
    rank = F.struct((F.col("n") - F.col("held")).alias("own"), F.xxhash64(F.lit(round_), "cid").alias("h"), F.col("cid").alias("lead"), F.col("comp").alias("lead_comp"))
    leads = entries.where("level = 1").groupBy("token").agg(F.min(rank).alias("l")).select("token", "l.lead", "l.lead_comp")
    named = entries.where("level = 1").join(leads, "token").where("comp <> lead_comp").groupBy("cid", "lead").agg(F.count("*").alias("k"))
    best = named.groupBy("cid").agg(F.max(F.struct("k", "lead")).alias("t"))
    return best.select(F.least("cid", "t.lead").alias("a"), F.greatest("cid", "t.lead").alias("b")).distinct()


def remaining_pairs(entries: DataFrame) -> DataFrame:
    """All pairs of classes of different components that share enough prefix entries."""
    small = entries.where("comp <> largest").select("token", *[F.col(c).alias(f"{c}_a") for c in ("cid", "comp", "n", "held", "match", "place", "level")])
    other = entries.select("token", "largest", *[F.col(c).alias(f"{c}_b") for c in ("cid", "comp", "n", "held", "match", "place", "level")])
    # The t-th common entry of a linked pair stands where t - 1 + (shared shingles from there on) still reach the
    # overlap asked for, on both sides; the first l common entries all do, so the others need not be counted.
    left = "least(held_a - place_a, held_b - place_b) + least(match_a, match_b) - 1"
    reach = F.expr(f"{100 + PERCENT} * ({left}) >= {PERCENT} * (n_a + n_b) and "
                   f"{100 + PERCENT} * least(held_a, held_b) >= {PERCENT} * (n_a + n_b)")
    once = F.expr("comp_a <> comp_b and (comp_b = largest or cid_a < cid_b)")
    near = F.expr(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    level = F.expr("greatest(level_a, level_b) <= least(match_a, match_b)")
    met = small.join(other, "token").where(once & near & reach & level)
    pair = (F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b"))
    return (met.groupBy(*pair).agg(F.count("*").alias("k"), F.max(F.expr("least(match_a, match_b)")).alias("need"))
            .where("k >= need").select("a", "b"))


def linked_classes(docs: DataFrame, text: str, total: int, n_docs: int, hot: tuple[np.ndarray, np.ndarray],
                   rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """classes (cid, s1, s2, n, shared) that can link, and links (a, b) that connect all linked ones."""
    bits = max(0, (max(1, total) // TOKENS_PER_SHARD).bit_length())
    buckets = max(1, -(-n_docs // CLASSES_PER_SHARD))
    spark = docs.sparkSession
    parts = spark.sparkContext.defaultParallelism
    shipped = spark.sparkContext.broadcast(hot)  # at most HOT_MOST entries
    shards = (1 << bits) + (buckets if len(hot[0]) else 0)
    packed = packed_shingles(docs, text, bits, buckets, shipped).repartition(max(parts, shards), "shard")
    shared = packed.groupBy("shard").applyInPandas(
        lambda pdf: shared_shingles(pdf, bits, buckets, shipped.value), "bucket long, sigs binary, sizes binary, counts binary, hashes binary, dfs binary")
    classes = written(shared.repartition(max(parts, buckets), "bucket").groupBy("bucket").applyInPandas(
        prefixes, "cid long, s1 long, s2 long, n long, match int, shared binary, entries array<long>, levels array<int>"), "ngram-classes")
    entries = classes.select("cid", "n", (F.octet_length("shared") / 8).cast("long").alias("held"), "match",
                             F.posexplode(F.arrays_zip("entries", "levels")).alias("place", "e")).select(
        "cid", "n", "held", "match", "place", F.col("e.entries").alias("token"), F.col("e.levels").alias("level"))
    open_, links, labels = entries, None, None
    for r in range(rounds):
        open_ = written(mixed_lists(entries, labels), "ngram-lists")
        found = written(verified(star_pairs(open_, r), classes), "ngram-links")
        links = found if links is None else links.union(found)
        labels = written(components(links), "ngram-labels")
    found = written(verified(remaining_pairs(mixed_lists(entries, labels)), classes), "ngram-links")
    return classes, links.union(found)


def components_of(docs: DataFrame, key: str = "doc_id", text: str = "text", hot_least: int = HOT_LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    all_ = written(described(docs, key, text), "ngram-docs")
    rows = all_.where("often is null").drop("often", "counts")
    total, n_docs = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot = hot_shingles(all_.where("often is not null"), total, hot_least)
    classes, links = linked_classes(docs, text, total, n_docs, hot)
    labels = components(links)
    known = classes.select("s1", "s2", "cid").join(labels, F.col("cid") == labels["node"], "left").select(
        "s1", "s2", F.coalesce("label", "cid").alias("label"))
    sets = rows.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("least")).join(known, ["s1", "s2"], "left")
    sets = written(sets, "ngram-sets")
    groups = sets.where("label is not null").groupBy("label").agg(F.min("least").alias("group_least"))
    ids = sets.join(groups, "label", "left").select("s1", "s2", F.coalesce("group_least", "least").alias("component"))
    out = rows.join(ids, ["s1", "s2"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
