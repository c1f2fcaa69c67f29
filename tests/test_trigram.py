import random

import pytest
from pyspark.sql import functions as F

from sparkdesk.functions.trigram import (
    best_extent_similarity,
    similarity,
    trigram_list,
    trigram_set,
    with_word_similarity,
    word_similarity,
)


def test_documented_values(spark):
    df = spark.createDataFrame([("word", "two words")], "a string, b string")
    row = df.select(F.size(trigram_set("b")).alias("n"), similarity(F.col("a"), F.col("b")).alias("s"),
                    word_similarity(F.col("a"), F.col("b")).alias("w")).first()
    assert row.n == 10
    assert row.s == pytest.approx(4 / 11)
    assert row.w == pytest.approx(0.8)


def test_trigram_rules(spark):
    df = spark.createDataFrame([("A-b", ), ("",), (None,)], "t string")
    rows = df.select(F.array_sort(trigram_set("t")).alias("s")).collect()
    assert rows[0].s == sorted(["  a", " a ", "  b", " b "])
    assert rows[1].s == [] and rows[2].s == []


def _py_trigrams(text):
    import regex
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    return [("  " + w + " ")[i:i + 3] for w in words for i in range(len(w) + 1)]


def test_run_search_native_equals_python(spark):
    rnd = random.Random(7)
    vocab = ["ab", "abc", "bcd", "word", "words", "two", "x", "wordy", "cab"]
    pairs = [(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 2))),
              " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 5)))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a string, b string")
    native = df.select("a", "b", word_similarity(F.col("a"), F.col("b")).alias("w")).collect()
    staged = {(r.a, r.b): r.ws for r in with_word_similarity(df, F.col("a"), F.col("b"), "ws").collect()}
    for r in native:
        brute = best_extent_similarity(set(_py_trigrams(r.a)), _py_trigrams(r.b))
        assert r.w == pytest.approx(brute), (r.a, r.b)
        assert staged[(r.a, r.b)] == pytest.approx(brute)


def test_extent_search_is_exhaustive():
    # brute force over every run
    rnd = random.Random(3)
    for _ in range(300):
        t = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 12))]
        a = set(rnd.sample("abcdefg", rnd.randint(1, 4)))
        best = 0.0
        for i in range(len(t)):
            for j in range(i, len(t)):
                r = set(t[i:j + 1])
                best = max(best, len(a & r) / len(a | r))
        assert best_extent_similarity(a, t) == pytest.approx(best)


def test_trigram_list_keeps_order(spark):
    df = spark.createDataFrame([("two words",)], "t string")
    assert df.select(trigram_list("t").alias("l")).first().l == [
        "  t", " tw", "two", "wo ", "  w", " wo", "wor", "ord", "rds", "ds "]


def test_codes_agree_between_jvm_and_python(spark):
    from sparkdesk.functions.trigram import py_trigram_codes, trigram_codes

    texts = ["two words", "Ünïcode straße É", "", None, "a-b c_d 12"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [sorted(r.c) if r.c is not None else None for r in df.select(trigram_codes("t").alias("c")).collect()]
    assert got == [sorted(py_trigram_codes(t)) for t in texts]


class _Rows:
    """Hands back the task function of a mapInPandas step."""

    def __init__(self, schema):
        from pyspark.sql.types import _parse_datatype_string

        self.schema = _parse_datatype_string(schema)

    def mapInPandas(self, run, schema):  # noqa: N802
        return run


def test_codes_of_long_texts_come_in_parts():
    import pandas as pd

    from sparkdesk.functions.trigram import PART_CHARS, py_trigram_code_list, py_trigram_codes, with_trigram_codes

    texts = [f"word{i} straße ÉTÉ " * (PART_CHARS // 60) for i in range(12)] + [None, "", "x"]
    pdf = pd.DataFrame({"id": range(len(texts)), "t": texts})
    run = with_trigram_codes(_Rows("id long, t string"), [("t", "b", False), ("t", "l", True)], fold_upper=True)
    parts = list(run(iter([pdf])))
    assert len(parts) > 3 and max(p["t"].str.len().sum() for p in parts) <= 2 * PART_CHARS
    out = pd.concat(parts)
    assert out["id"].tolist() == list(range(len(texts)))
    for t, b, codes in zip(texts, out["b"], out["l"], strict=True):
        assert sorted(b) == sorted(py_trigram_codes(t, True)) and list(codes) == py_trigram_code_list(t, True)
    assert [p.columns.tolist() for p in run(iter([pdf[:0]]))] in ([], [["id", "t", "b", "l"]])


def test_memo_of_scored_pairs_is_bounded():
    import tracemalloc

    import numpy as np
    import pandas as pd

    from sparkdesk.functions.trigram import add_run_similarity, best_extent_similarity

    def batches(n):
        for k in range(n):
            rows = [np.arange(k * 1000 + i, k * 1000 + i + 200) << 40 for i in range(200)]
            yield pd.DataFrame({"a": [np.arange(3)] * 200, "l": rows})

    run = add_run_similarity(_Rows("a array<bigint>, l array<bigint>"), [("a", "l", "w")])
    tracemalloc.start()
    for _ in run(batches(100)):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    a, text = np.array([1, 2, 3]), np.array([9, 1, 2, 9, 9, 3])
    pdf = pd.DataFrame({"a": [a, a, None], "l": [text, text, text]})
    assert next(iter(run(iter([pdf]))))["w"].tolist() == [best_extent_similarity(a, text)] * 2 + [0.0]


def test_word_points_are_made_in_little_memory():
    import tracemalloc

    from sparkdesk.functions.text_windows import word_points

    tracemalloc.start()
    try:
        table = word_points.__wrapped__()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert table[ord("é")] and table[ord("7")] and not table[ord("_")] and not table[0xD800]
    assert peak < 16 << 20
