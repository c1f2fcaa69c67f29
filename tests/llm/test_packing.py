"""Batch encoding against the library, BM25 against brute force, and packing against its contract."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkdesk.llm import bpe_batch, packing
from sparkdesk.llm.bpe import with_classes
from sparkdesk.llm.encoding import WORD_LEVEL, inner_pairs

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, lang string, row string, ids string, shard string, start string"


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return bpe_batch.BatchEncoder(PATH, with_classes(WORD_LEVEL), inner_pairs(PATH), bpe_batch.point_classes())


def odd_texts():
    rnd = random.Random(2)
    return ["", " ", "'", "''", "a'", "aaaaaaa aaaa aaa aa", "don't 'tis ''s 's's rock'n'roll they'll'd we've'", "x" * 5000 + " zz" * 10, "½ ① ²³ ×÷ª ÉTÉ İß", "<|endoftext|> it's",
            "日本 text", "tail '", *["".join(rnd.choice("ab cd's'll're've'm1²½é×!\t\n'' İß") for _ in range(60)) for _ in range(500)]]


def test_batch_encoding_equals_the_library(encoder):
    texts = odd_texts()
    for _ in range(2):  # the second time from what was learnt
        assert [x.tolist() for x in encoder.encode_all(texts)] == [library_ids(t) for t in texts]
    encoder.limit = 50
    for k in range(0, len(texts), 40):
        assert [x.tolist() for x in encoder.encode_all(texts[k:k + 40])] == [library_ids(t) for t in texts[k:k + 40]]
    assert encoder.encode_all([]) == []


def test_colliding_hashes_are_noticed(encoder):
    other = bpe_batch.BatchEncoder(PATH, encoder.splitter and with_classes(WORD_LEVEL), (encoder.plain, encoder.final), encoder.classes)
    other.of_byte = np.zeros(256, np.uint64)  # every pre-token hashes alike
    assert [x.tolist() for x in other.encode_all(["one two", "three"])] == [library_ids("one two"), library_ids("three")]


def test_bm25_scores_and_windows():
    rnd = np.random.default_rng(4)
    v = 40
    tails = [rnd.zipf(1.6, n) % v for n in rnd.integers(1, 30, 60)]
    size = np.array([len(x) for x in tails])
    df = Counter(t for x in tails for t in set(x.tolist()))
    idf = np.array([math.log1p((60 - df[t] + 0.5) / (df[t] + 0.5)) for t in range(v)])
    mean = size.mean()
    index = packing.Index(np.concatenate(tails), size, idf, mean, query_terms=5)

    def weight(t, d):
        tf = int((tails[d] == t).sum())
        return idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * size[d] / mean))

    for d in range(60):
        query = sorted(set(tails[d].tolist()), key=lambda t: (-weight(t, d), t))[:5]
        want = [sum(weight(t, e) for t in query) for e in range(60)]
        assert np.allclose(index.scores(d), want)
    windows = packing.fill_windows(index, size, 32)
    assert all(sum(n for *_, n in w) == 32 for w in windows[:-1])
    spans = sorted((t, s, n) for w in windows for t, s, n in w)
    at = {}
    for t, s, n in spans:
        assert s == at.get(t, 0)
        at[t] = s + n
    assert at == dict(enumerate(size.tolist()))
    second = windows[0][1][0]  # the best unused neighbour of the first seed
    score = index.scores(0)
    score[0] = -1
    assert second == int(score.argmax())


def check(rows, docs, window):
    left = Counter((d, len(i := [*library_ids(t), 1]), zlib.crc32(np.array(i, "<u4").tobytes())) for d, t, *_ in docs)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for found in by.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == window or (at < window and at & (at - 1) == 0)
    ids = {}
    for d, t, *_ in docs:
        ids.setdefault(d, []).append(np.array([*library_ids(t), 1], "<u4"))
    tokens = Counter()
    for r in rows:
        tokens[r["doc_id"]] += r["length"]
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in ids[r["doc_id"]])
    assert tokens == Counter({d: sum(map(len, x)) for d, x in ids.items()}) and sum(left.values()) == len(docs)


@pytest.mark.parametrize("shard_tokens", [300, 10 ** 6])
def test_packing_keeps_its_contract(spark, shard_tokens):
    rnd = random.Random(1)
    texts = [None, "", "long words " * 400, *odd_texts()[:40], *[" ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "rare%d" % rnd.randrange(9)]) for _ in range(rnd.randrange(200)))
                                                              for _ in range(120)], *["the same copy of a text"] * 80]
    docs = [(i if i % 50 else None, t, "en", "r", "i", "s", "0") for i, t in enumerate(texts)] + [(7, "again seven", "", "", "", "", "")]
    rows = packing.pack(spark.createDataFrame(docs, SCHEMA).repartition(4), PATH, 1, window=64, shard_tokens=shard_tokens, min_df=2).collect()
    check(rows, docs, 64)


def test_packing_of_no_documents(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH, 1).count() == 0
