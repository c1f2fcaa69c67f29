"""Language identification by nearest centroid over normalised TF-IDF character n-grams.

* Document frequencies of hashed 1- to 3-grams are counted over **all** training rows.
* Every language gets several centroids: spherical k-means over a bounded sample of its rows
  (``sample_per_lang``, default 1,500; the bound holds for the centroid fit only).
* A text goes to the language of the centroid with the largest cosine. Distance-based rejection: each
  centroid keeps a cosine below which hardly any of its own members lie; texts below it are ``rejected``.

Defined results: a null text or one without a letter is ``und`` with score 0; a training table without
usable rows gives ``und`` for every row; ties go to the first language in order. Rows are independent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, mix64

BITS = 12
DIM = 1 << BITS
LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")
CHUNK = 1 << 20


def has_letter(text: str) -> bool:
    """Whether the text holds a letter (superscripts, fractions and number signs are none)."""
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of the whole text; runs of other characters are one space."""
    clean = " " + NOT_LETTERS.sub(" ", text.lower()) + " "
    total = np.zeros(DIM)
    for s in range(0, len(clean), CHUNK):
        c = np.frombuffer(clean[s:s + CHUNK + 2].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        own = min(CHUNK, len(clean) - s)
        g = c
        for n in (1, 2, 3):
            if n > 1:
                g = g[:-1] * np.uint64(1 << 21) + c[n - 1:]
            grams = g[:own]
            total += np.bincount((mix64(grams + np.uint64(n << 60)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=DIM)
    return total


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(gram_counts(text)) * idf
    return v / (np.linalg.norm(v) or 1.0)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts hold each hashed n-gram, and how many texts there are, over all rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIM, np.int64), 0
        for pdf in batches:
            for t in pdf["text"]:
                df += gram_counts(t) > 0
                n += 1
        yield pd.DataFrame({"gram": np.arange(DIM + 1), "df": np.append(df, n)})

    rows = texts.select("text").mapInPandas(count, "gram int, df long").groupBy("gram").agg(F.sum("df").alias("df"))
    out = np.zeros(DIM + 1, np.int64)
    for r in rows.collect():  # DIM + 1 rows, whatever the input
        out[r["gram"]] = r["df"]
    return out[:DIM], int(out[DIM])


def cluster(vectors: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starts; centroids and their rejection cosines."""
    centers = [vectors.mean(axis=0)]
    nearest = vectors @ centers[0]
    for _ in range(1, min(k, len(vectors))):
        centers.append(vectors[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, vectors @ centers[-1])
    c = np.array(centers)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    for _ in range(rounds):
        own = np.argmax(vectors @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = vectors[own == j].mean(axis=0)
                c[j] = m / (np.linalg.norm(m) or 1.0)
    cos = vectors @ c.T
    own = np.argmax(cos, axis=1)
    limits = np.array([0.8 * np.quantile(cos[own == j, j], 0.01) if (own == j).any() else 0.0 for j in range(len(c))])
    return c, limits


def fit(train: DataFrame, clusters: int = 4, sample_per_lang: int = 1500) -> dict:
    """train: (doc_id, text, lang). Returns the broadcastable model."""
    train = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    df, n = document_frequencies(train)
    idf = np.log((n + 1) / (df + 1)) + 1
    sample = bounded_sample(train, "lang", "doc_id", sample_per_lang)

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in pdf.sort_values("doc_id")["text"] if has_letter(t)]
        if not texts:
            return pd.DataFrame({"lang": [], "center": [], "limit": []})
        c, limits = cluster(np.array([vector(t, idf) for t in texts], np.float32), clusters)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "center": [x.astype(float) for x in c], "limit": limits})

    # at most `clusters` rows of DIM numbers for each language
    rows = sample.select("doc_id", "lang", "text").groupBy("lang").applyInPandas(
        centroids, "lang string, center array<double>, limit double").collect()
    rows.sort(key=lambda r: (r["lang"], r["center"]))
    return {"idf": idf, "langs": [r["lang"] for r in rows], "centers": np.array([r["center"] for r in rows]),
            "limits": np.array([r["limit"] for r in rows])}


def identify(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score, rejected for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shipped.value
        for texts in batches:
            out = []
            for t in texts:
                if not t or not m["langs"] or not has_letter(t):
                    out.append(("und", 0.0, True))
                    continue
                cos = m["centers"] @ vector(t, m["idf"])
                j = int(np.argmax(cos))
                out.append((m["langs"][j], float(min(1.0, max(0.0, cos[j]))), bool(cos[j] < m["limits"][j])))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "rejected"])

    return docs.select(F.col(key), run(F.col(text)).alias("_r")).select(key, "_r.lang_pred", "_r.score", "_r.rejected")
