"""Toxicity by compression distance: separate zstandard dictionaries, window compression lengths.

Two dictionaries are trained with zstandard, one on windows of ordinary text and one on the passages that
set the toxic training texts apart (spans around words far commoner there). A window is compressed twice:
once with the ordinary dictionary alone and once with the toxic dictionary's content in front of it, so
that whatever ordinary text offers is open to both, and the difference in length is what the toxic
dictionary saves. A text's evidence is its largest and its mean saving over all windows of the whole text;
a logistic threshold over both is calibrated on training rows that the dictionaries have not seen.

Fitted on a bounded sample of labelled rows (``sample_per_label``, default 4,000 of each label).

Defined results: null and empty texts count as one empty window (saving 0). Without rows of both labels
every score is 0. Rows are independent; ties and repeats change nothing.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample

WINDOW, STEP, LEVEL = 256, 232, 9
ORDINARY_BYTES, TOXIC_BYTES = 32768, 1024
WORD = re.compile(rb"[^\s.,;:!?|\"'()]+")


def windows(text: str | None) -> list[bytes]:
    """Overlapping windows over all bytes of the lower-cased text."""
    b = (text or "").lower().encode("utf-8", "surrogatepass")
    return [b[i:i + WINDOW] for i in range(0, max(1, len(b) - WINDOW + STEP), STEP)]


class Savings:
    """Bytes that the toxic dictionary saves, per window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard as z

        params = z.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0, source_size=WINDOW,
            dict_size=len(ordinary) + len(toxic))
        self.plain, self.with_toxic = (
            z.ZstdCompressor(compression_params=params, dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT))
            for d in (ordinary, toxic + ordinary))

    def __call__(self, text: str | None) -> tuple[float, float]:
        saved = [len(self.plain.compress(w)) - len(self.with_toxic.compress(w)) for w in windows(text)]
        return float(max(saved)), sum(saved) / len(saved)


def telling_words(toxic: list[bytes], ordinary: list[bytes], least_z: float = 6.0, least_ratio: float = 4.0) -> set[bytes]:
    """Words whose share of toxic texts is far above their share of ordinary ones."""
    t, o = Counter(), Counter()
    for counts, texts in ((t, toxic), (o, ordinary)):
        for b in texts:
            counts.update(set(WORD.findall(b)))
    a, b = len(toxic), len(ordinary)
    out = set()
    for w, n in t.items():
        p = (n + o[w]) / (a + b)
        z = (n / a - o[w] / b) / math.sqrt(p * (1 - p) * (1 / a + 1 / b) + 1e-12)
        if n >= 3 and z >= least_z and n / a >= least_ratio * o[w] / b:
            out.add(w)
    return out


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes], ordinary_windows: int) -> tuple[bytes, bytes]:
    import zstandard as z

    def trained(size: int, samples: list[bytes]) -> bytes:
        try:
            return z.train_dictionary(size, samples).as_bytes()
        except z.ZstdError:  # too few samples to train on: their own bytes
            return b"".join(samples)[-size:]

    words = telling_words(toxic, ordinary) or {w for b in toxic for w in WORD.findall(b)} - {w for b in ordinary for w in WORD.findall(b)}
    spans = [b[max(0, m.start() - 1):m.end() + 1] for b in toxic for m in WORD.finditer(b) if m.group() in words]
    groups = [b"".join(spans[i:i + 8]) for i in range(0, len(spans), 8)]
    plain = [b[i:i + WINDOW] for b in ordinary for i in range(0, max(1, len(b)), WINDOW)]
    plain = [plain[i] for i in np.random.default_rng(0).permutation(len(plain))[:ordinary_windows]]
    return trained(ORDINARY_BYTES, plain), trained(TOXIC_BYTES, groups)


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps of a lightly regularised logistic fit; weights with the bias last."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(h, x.T @ (p - y) + 1e-3 * w), -5, 5)
    return w


def fit_texts(rows: list[tuple[int, str]], ordinary_windows: int = 20_000) -> dict:
    """rows: (label, text) in a fixed order. Half of them train the dictionaries, half the thresholds."""
    first, second = rows[::2], rows[1::2]
    toxic = [(t or "").lower().encode("utf-8", "surrogatepass") for y, t in first if y == 1]
    ordinary = [(t or "").lower().encode("utf-8", "surrogatepass") for y, t in first if y == 0]
    if not toxic or not ordinary or len({y for y, _ in second}) < 2:
        return {}
    o, t = train_dictionaries(toxic, ordinary, ordinary_windows)
    savings = Savings(o, t)
    x = np.array([savings(text) for _, text in second])
    return {"ordinary": o, "toxic": t, "weights": logistic(x, np.array([float(y) for y, _ in second]))}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_per_label: int = 4000, ordinary_windows: int = 20_000) -> dict:
    """docs: (doc_id, text); labels: (doc_id, <label>). Both already restricted to training rows.

    The ordinary dictionary is trained on at most ``ordinary_windows`` windows of the sampled texts, drawn evenly; a repeated id
    trains once, with its least text. The two labels are weighed by their true shares: the sample holds them evenly thinned only above
    the bound, and the bias is set right for that."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
    shares = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    wanted = bounded_sample(known, "label", "doc_id", sample_per_label)
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")  # at most 2 x sample_per_label ids
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # one text of a repeated id

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "doc_id"])
        return pd.DataFrame({"m": [pickle.dumps(fit_texts(list(zip(pdf["label"], pdf["text"], strict=True)), ordinary_windows))]})

    got = rows.withColumn("h", F.xxhash64(F.lit(5), "doc_id")).withColumn("all", F.lit(1)).groupBy("all").applyInPandas(one, "m binary").collect()
    model = pickle.loads(got[0]["m"]) if got else {}
    if model and len(shares) == 2:
        kept = {k: min(v, sample_per_label) for k, v in shares.items()}
        model["weights"][-1] += math.log(shares[1] / shares[0]) - math.log(kept[1] / kept[0])
    return model


def toxicity(spark: SparkSession, text: Column, model: dict) -> Column:
    """Score in 0..1 of a text column."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shipped.value
        savings = Savings(m["ordinary"], m["toxic"]) if m else None
        for texts in batches:
            if savings is None:
                yield pd.Series([0.0] * len(texts), dtype="float64")
                continue
            x = np.array([(*savings(t), 1.0) for t in texts]).reshape(-1, 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ m["weights"], -30, 30))))

    return run(text)
