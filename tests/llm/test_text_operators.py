"""Row-wise operators and exact dedup operators against brute force on small awkward tables."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkdesk.llm import decontaminate, encoding, lang_id, line_dedup, ngram_join, quality, suffix_dedup, token_counts, toxicity

LETTERS = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `_id` string, `_text` string, high string"


def table(spark, texts):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in texts], DOCS)


def awkward():
    rnd = random.Random(3)
    odd = ["".join(chr(rnd.choice([rnd.randrange(32, 127), 32, 10, 9, 0x85, 0xA0, 0x1C, rnd.randrange(0xC0, 0x2FF), rnd.randrange(0x370, 0x3FF),
                                   rnd.randrange(0x1F300, 0x1F6FF)])) for _ in range(rnd.randrange(1, 150))) for _ in range(120)]
    return [None, "", " ", "\n\n", "a" * 4000, "<|endoftext|> it's 123 <|startoftext|>", "İSTANBUL Σίσυφος ΣΑΣ ǅ", "Á", *odd]


def test_token_counts_and_encoding_equal_the_library(spark):
    texts = list(enumerate(awkward())) + [(0, None), (None, "hello world")]
    docs = table(spark, texts)
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    got = sorted(map(tuple, token_counts.count_tokens(docs, path, max_tokens=20).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 20) for i, t in texts), key=str)
    assert got == want
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = sorted(((r[0], list(r[1]), r[2]) for r in encoding.encode(docs, path).collect()), key=str)
    ids = [(i, lib.encode(t or "", add_special_tokens=False).ids) for i, t in texts]
    assert got == sorted(((i, x, lib.decode(x, skip_special_tokens=False)) for i, x in ids), key=str)
    digest = {(r["doc_id"], r["ids_sha256"]) for r in encoding.encoding_digest(docs, path).collect()}
    assert (5, hashlib.sha256(" ".join(map(str, dict(ids)[5])).encode()).hexdigest()) in digest


def test_forced_cuts_lie_inside_no_token():
    plain, final = encoding.inner_pairs(public_tokenizers.path("word_bpe_49k.json"))
    assert "th" in plain and "ng" in final
    cut = encoding.fragments("thqzth", plain, final)
    assert "".join(cut) == "thqzth" and all(x + y not in plain for x, y in [("q", "z")] if len(cut) > 1)


def test_decontamination_both_join_ways(spark):
    items = [(1, " ".join(LETTERS[:12])), (2, " ".join(LETTERS[:12])), (3, "tiny one"), (4, ""), (5, None), (6, "q r s t u v w"), (None, "zz yy"), (7, "a " * 12)]
    whole = "x " + " ".join(LETTERS).upper() + " end"
    docs = table(spark, [(1, whole), (2, "tiny One tiny one"), (None, "zz-yy ÉÀ"), (4, None), (5, ""), (1, whole), (6, "a " * 30), (7, " ".join(LETTERS[:9]))])
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted([(1, 28, 19, ["1", "2", "6"]), (1, 28, 19, ["1", "2", "6"]), (2, 4, 4, ["3"]), (None, 3, 2, []), (4, 0, 0, []), (5, 0, 0, []),
                   (6, 30, 30, ["7"]), (7, 9, 0, [])], key=str)
    for bound in (500_000, 0):
        out = decontaminate.contamination(docs, bench, broadcast_windows=bound).select("doc_id", "n_words", "n_hit", "items").collect()
        assert sorted(((r[0], r[1], r[2], list(r[3])) for r in out), key=str) == want
    empty = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert len(empty) == 8 and not any(r["contaminated"] for r in empty)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def brute_lines(rows, min_docs, min_chars):
    keys = [[(x.strip(line_dedup.STRIP).encode().lower(), len(x.strip(line_dedup.STRIP))) for x in (t or "").split("\n")] for _, t in rows]
    low = -(1 << 63)
    held = collections.defaultdict(list)
    for (i, _), ks in zip(rows, keys, strict=True):
        for k in set(ks):
            held[k].append(low if i is None else i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= min_docs and k[1] >= min_chars}
    out = []
    for (i, t), ks in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        keep = [x for x, k in zip(lines, ks, strict=True) if k not in gone or gone[k] == (low if i is None else i)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_line_dedup_broadcast_and_routed(spark, bound):
    rnd = random.Random(1)
    lines = [f"Line {k} of the shared kind É" for k in range(8)] + ["short", "", " \t "]
    rows = [(i, "\n".join(rnd.choice(["", "  "]) + rnd.choice([str.upper, str])(rnd.choice(lines)) for _ in range(rnd.randrange(1, 6)))) for i in range(40)]
    rows += [(39, rows[39][1]), (None, lines[0]), (None, None), (50, ""), (51, "\n")]
    out = line_dedup.dedup_lines(table(spark, rows), min_docs=5, min_chars=20, broadcast_keys=bound).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute_lines(rows, 5, 20)
    assert line_dedup.dedup_lines(table(spark, rows).limit(0), broadcast_keys=bound).count() == 0


def test_perfect_hash_is_minimal():
    import numpy as np

    rng = np.random.default_rng(0)
    high, low = (rng.integers(0, 2**64, 5000, dtype=np.uint64) for _ in range(2))
    high[:100] = high[0]  # keys that differ in one half only
    assert sorted(line_dedup.PerfectHash.build(high, low).lookup(high, low).tolist()) == list(range(5000))


def brute_spans(rows, size):
    seen = collections.Counter(b[k:k + size] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - size + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = {j for k in range(len(b) - size + 1) if seen[b[k:k + size]] > 1 for j in range(k, k + size)}
        spans = sum(1 for j in gone if j - 1 not in gone)
        out.append((i, len(b), spans, bytes(c for j, c in enumerate(b) if j not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowd", [200, 1])
def test_suffix_dedup_indexed_and_crowded(spark, crowd):
    rnd = random.Random(2)
    words = [f"w{k}é" for k in range(400)]
    passage = " ".join(rnd.choice(words) for _ in range(130))
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(10, 60))) + passage[rnd.randrange(0, 90):rnd.randrange(500, 600)]
             + " ".join(rnd.choice(words) for _ in range(20))) for i in range(30)]
    rows += [(30, "ab" * 700), (31, rows[0][1]), (0, rows[0][1]), (None, None), (None, passage), (33, ""), (34, "x" * 399), (35, "x" * 400)]
    out = suffix_dedup.remove_repeats(table(spark, rows), max_contexts=crowd).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in out), key=str)
    assert got == brute_spans(rows, 400)
    assert suffix_dedup.remove_repeats(table(spark, rows).limit(0)).count() == 0


def test_suffix_dedup_crowded_contexts_are_halved(spark):
    """A passage cut off at many places: its contexts are halved until few of them meet, never one row for a byte."""
    rnd = random.Random(9)
    fill = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    passage = fill(900)
    rows = [(i, fill(rnd.randrange(30, 200)) + passage[rnd.randrange(0, 200):rnd.randrange(560, 900)] + fill(rnd.randrange(0, 300))) for i in range(60)]
    rows += [(60, rows[3][1]), (61, passage), (62, passage[:400]), (63, passage[250:649]), (64, None)]
    want = brute_spans(rows, 400)
    for crowd in (1, 4):
        out = suffix_dedup.remove_repeats(table(spark, rows), max_contexts=crowd).collect()
        assert sorted(((r["doc_id"], r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in out), key=str) == want
    edge = [(i, 1, 7, 8, 1000, 1240, 240, 1, bytearray(rnd.randbytes(640))) for i in range(20)]
    part = spark.createDataFrame(edge, suffix_dedup.CELL)
    for size in (128, 64, 32, 16, 8, 4, 2, 1):
        before, part = part.count(), spark.createDataFrame(suffix_dedup.cells(part, size, 400).collect(), suffix_dedup.CELL)
        assert part.count() <= 2 * before
    assert part.count() == 20 * 241  # at the end every window, once
    assert {(r["id"], r["first"]) for r in part.collect()} == {(i, s) for i in range(20) for s in range(1000, 1241)}


def test_run_index_keeps_few_runs_and_right_statistics():
    base = bytes(random.Random(4).choices(b"abcd", k=300))
    strings = [base] * 6 + [base[:100] + b"z" + base[101:]]
    index = suffix_dedup.RunIndex(strings)
    assert index.runs < len(index.text) / 3
    found = index.matching_statistics()
    for k, s in enumerate(strings):
        for p in range(0, 300, 37):
            best = 0
            for j, t in enumerate(strings):
                for q in range(len(t)):
                    if (j, q) != (k, p):
                        n = 0
                        while p + n < len(s) and q + n < len(t) and s[p + n] == t[q + n]:
                            n += 1
                        best = max(best, n)
            assert found[index.starts[k] + p] == best


def brute_groups(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = label[a], label[b]
                label = [y if v == x else v for v in label]
    least = {}
    for (i, _), v in zip(rows, label, strict=True):
        if i is not None:
            least[v] = min(i, least.get(v, i))
    return sorted(((i, len(s), least.get(v)) for (i, _), s, v in zip(rows, sets, label, strict=True)), key=str)


def test_ngram_join_against_all_pairs(spark, monkeypatch):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows, base = [], [[rnd.choice(words) for _ in range(rnd.randrange(60, 140))] for _ in range(6)]
    for i in range(120):
        w = list(rnd.choice(base))
        for _ in range(rnd.randrange(0, 5)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((i, " ".join(w).upper() if i % 7 == 0 else "  ".join(w)))
    rows += [(200, "one two"), (201, "one  TWO"), (202, ""), (203, None), (204, " \n"), (5, rows[5][1]), (None, rows[9][1]), (None, "lone text"), (202, "")]
    got = sorted((tuple(r) for r in ngram_join.components_of(table(spark, rows)).collect()), key=str)
    assert got == brute_groups(rows)
    hot = ngram_join.components_of(table(spark, rows), hot_least=15)  # some shingles travel with their classes
    assert sorted((tuple(r) for r in hot.collect()), key=str) == got
    assert ngram_join.components_of(table(spark, rows).limit(0)).count() == 0


def test_ngram_join_hot_shingles_are_found():
    rnd = np.random.default_rng(8)
    sets = [np.unique(np.append(rnd.integers(8, 1 << 63, size=50, dtype=np.uint64), np.full(int(i % 3 == 0), 7, np.uint64))) for i in range(300)]
    seen = ngram_join.often_seen(sets)
    assert seen["often"][0].tolist() == [7] and seen["counts"][0].tolist() == [100]


def test_language_toxicity_and_quality(spark):
    rnd = random.Random(6)
    vocab = {"xx": "alo bela cori dama efo".split(), "yy": "struk grzyb wchod prszt kwik".split()}
    rows = [(i, " ".join(rnd.choice(vocab[("xx", "yy")[i % 2]]) for _ in range(30)), ("xx", "yy")[i % 2]) for i in range(120)]
    train = spark.createDataFrame([*rows, (500, None, "xx"), (501, "12 34", "yy"), (502, "text", None)], "doc_id long, text string, lang string")
    model = lang_id.fit(train, clusters=2, sample_per_lang=40)
    asked = table(spark, [(1, "bela cori alo dama"), (2, "wchod grzyb kwik"), (3, None), (4, ""), (5, "12 ..."), (6, "bela " * 50000), (None, "alo")])
    got = {r["doc_id"]: r for r in lang_id.identify(asked, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, None)] == ["xx", "yy", "und", "und", "und", "xx", "xx"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in lang_id.identify(asked, lang_id.fit(train.limit(0))).collect()} == {"und"}

    clean = "the of and to in is was for on that by this with from".split()
    texts = [(i, " ".join([*(rnd.choice(clean) + str(rnd.randrange(90)) for _ in range(40)), *(["nastyword grimslur"] * 3 if i % 4 == 0 else [])])) for i in range(400)]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i, _ in texts[:300]] + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    score = {r[0]: r[1] for r in docs.select("doc_id", toxicity.toxicity(spark, F.col("text"), model)).collect()}
    right = sum((score[i] >= 0.5) == (i % 4 == 0) for i in range(300, 400))
    assert right >= 95
    edge = table(spark, [(1, None), (2, ""), (3, "the of " * 100000)])
    assert all(0 <= r[0] < 0.5 for r in edge.select(toxicity.toxicity(spark, F.col("text"), model)).collect())
    assert {r[0] for r in edge.select(toxicity.toxicity(spark, F.col("text"), toxicity.fit(docs, labels.limit(0)))).collect()} == {0.0}

    weights = quality.fit(docs, labels, "quality")
    score = {r[0]: r[1] for r in quality.score(docs, weights).collect()}
    assert sum((score[i] >= 0.5) == (i % 4 != 0) for i in range(300, 400)) >= 95
    assert {r["score"] for r in quality.score(edge, quality.fit(docs, labels.limit(0), "quality")).collect()} == {0.5}


def test_quality_scores_do_not_depend_on_the_sample_bound(spark):
    rng = np.random.default_rng(3)
    texts, marks = [], []
    for i in range(3500):
        good = int(i % 7 != 0)  # six to one
        words = ["fine" if rng.random() < (0.6 if good else 0.4) else "poor" for _ in range(6)]
        texts.append((i, " ".join(words)))
        marks.append((i, good))
    docs, labels = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int")
    few = docs.where("doc_id < 400")
    below, above = ({r[0]: r[1] for r in quality.score(few, quality.fit(docs, labels, "quality", cap)).collect()} for cap in (6000, 400))
    odds = np.array([np.log(above[i] / (1 - above[i])) - np.log(below[i] / (1 - below[i])) for i in below])
    assert abs(odds.mean()) < 0.5  # log(6) = 1.8 when the bias keeps the shares of the sample


def test_texts_without_letters_have_no_language(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 8)]
    model = lang_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "²"), (2, "½ ①"), (3, "12 __ !"), (4, None), (5, "² a")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in lang_id.identify(odd, model).collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == ["und"] * 4 and got[5] != "und"


def test_other_labels_and_repeated_ids_do_not_train(spark):
    good, bad = "a careful and clear text about rivers", "buy now cheap cheap click"
    rows = [(i, good if i % 2 else bad) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    probe = spark.createDataFrame([(0, good), (1, bad)], "doc_id long, text string")

    def scores(rows, labels):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        w = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"), "quality")
        return [round(r["score"], 6) for r in quality.score(probe, w).orderBy("doc_id").collect()]

    plain = scores(rows, labels)
    assert plain[0] > 0.7 > plain[1]
    assert scores(rows + [(100 + i, good) for i in range(50)], labels + [(100 + i, -1) for i in range(50)]) == plain
    assert scores(rows + [(1, good)] * 40, labels) == plain
