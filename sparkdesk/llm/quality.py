"""Quality classification: logistic regression over hashed word n-grams, follow-the-regularised-leader.

Features of a text: words, word pairs, and pairs of word *shapes* (case, digits, punctuation, "same word
as before"), each hashed into 2**18 slots; value log(1 + count), scaled to length 1. Weights are learned
by per-coordinate FTRL-proximal updates over a bounded sample of labelled rows (``sample_per_label``,
default 6,000 of each label, in hash order, two passes) and a text's score is the logistic of the
sparse dot product.

Defined results: null and empty texts have no features, so their score is that of the bias alone; with no
labelled rows every score is 0.5. Rows are independent; labels of the same doc_id all count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, bounded_sample, mix64

BITS = 18
TOKEN = re.compile(r"\w+|[^\w\s]+")


def _token(t: str) -> tuple[int, int]:
    """A token's hash and the hash of its shape."""
    import xxhash

    if t[0].isalnum():
        kind = "U" if t.isupper() and len(t) > 1 else "T" if t[0].isupper() else "9" if t[0].isdigit() else "l"
        kind += str(min(len(t) // 4, 3))
    else:
        kind = t[:3]
    return xxhash.xxh3_64_intdigest(t), xxhash.xxh3_64_intdigest(kind, seed=1)


class Features:
    """Slots and values of a text's n-grams."""

    def __init__(self):
        self.tokens = Memo(_token)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found = TOKEN.findall(text) if text else []
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        both = np.array([self.tokens[t] for t in found], np.uint64)
        w, shape = both[:, 0], both[:, 1].copy()
        again = w[1:] == w[:-1]
        shape[1:][again] = np.uint64(7)
        grams = np.concatenate([w, w[:-1] * np.uint64(3) + mix64(w[1:]), shape[:-1] * np.uint64(5) + mix64(shape[1:])])
        slots, counts = np.unique(mix64(grams) >> np.uint64(64 - BITS), return_counts=True)
        values = np.log1p(counts)
        return slots.astype(np.int64), values / np.linalg.norm(values)


def train_ftrl(rows, passes: int = 2, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.1):
    """rows: (label, slots, values). Weights with the bias last."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(passes):
        for label, slots, values in rows:
            i, x = np.append(slots, size - 1), np.append(values, 1.0)
            w = weights(i)
            g = (1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ x))))) - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(size))


def fit(docs: DataFrame, labels: DataFrame, label: str, sample_per_label: int = 6000) -> np.ndarray:
    """docs: (doc_id, text); labels: (doc_id, <label>). Both already restricted to training rows.

    Labels other than 0 and 1 are ignored; a repeated id trains once, with its least text. The two labels are weighed by their true shares: the sample thins them unevenly above the bound, and
    the bias is set right for that."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
    shares = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    wanted = bounded_sample(known, "label", "doc_id", sample_per_label)
    kept = {r[0]: r[1] for r in wanted.groupBy("label").count().collect()}
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")  # at most 2 x sample_per_label ids
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # one text of a repeated id

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        features = Features()
        pdf = pdf.sort_values(["h", "doc_id"])
        w = train_ftrl([(y, *features(t)) for y, t in zip(pdf["label"], pdf["text"], strict=True)])
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()]})

    got = rows.withColumn("h", F.xxhash64(F.lit(5), "doc_id")).withColumn("all", F.lit(1)).groupBy("all").applyInPandas(one, "w binary").collect()
    weights = np.frombuffer(got[0]["w"], np.float32).copy() if got else np.zeros((1 << BITS) + 1, np.float32)
    if got and all(kept.get(k) for k in (0, 1)):
        weights[-1] += math.log(shares[1] / shares[0]) - math.log(kept[1] / kept[0])
    return weights


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, features = shipped.value.astype(float), Features()
        for texts in batches:
            out = []
            for t in texts:
                slots, values = features(t)
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, float(w[slots] @ values + w[-1]))))))
            yield pd.Series(out, dtype="float64")

    return docs.select(F.col(key), run(F.col(text)).alias("score"))
