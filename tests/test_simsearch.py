
import pytest
from pyspark.sql import functions as F

from sparkdesk.functions.text import score_text
from sparkdesk.functions.trigram import best_extent_similarity
from sparkdesk.operators.simsearch import (
    identifier_columns,
    items_from_json,
    parse_k,
    parse_min_pct,
    similarity_search,
)
from tests.conftest import SF001
from tests.test_trigram import _py_trigrams


def test_blank_items_keep_index(spark):
    df = spark.createDataFrame([('["", "   ", "c_order", "it\'s"]',)], "items string")
    rows = items_from_json(df).collect()
    assert [(r.item_index, r.term) for r in rows] == [(2, "c_order"), (3, "its")]


def test_defaults():
    assert parse_k(None) == 1 and parse_k("null") == 1 and parse_k("") == 1 and parse_k("5") == 5
    assert parse_min_pct("null") == 30.0 and parse_min_pct("1") == 1.0


def test_score_text(spark):
    df = spark.createDataFrame([(42.5,), (None,), (17.25,), (36.363636,)], "s double")
    assert [r.t for r in df.select(score_text("s").alias("t")).collect()] == [
        "42.5000%", "0.0000%", "17.2500%", "36.3636%"]


def test_identifier_columns(spark):
    df = spark.read.parquet(f"{SF001}/part.parquet")
    assert identifier_columns(df.schema, ["p_name", "p_size", "bad-name; drop table", "P_BRAND"]) == [
        "p_name", "p_brand"]


def _brute(terms, entity, cols, min_pct, k):
    out = {}
    for idx, term in terms:
        a = set(_py_trigrams(term.upper()))
        scored = []
        for rid, texts in entity:
            best = 0.0
            for t in texts:
                if t is None:
                    continue
                b = _py_trigrams(t.upper())
                sb = set(b)
                sim = len(a & sb) / len(a | sb) if a and sb else 0.0
                best = max(best, sim * 100.0, best_extent_similarity(a, b) * 100.0)
            if best > min_pct:
                scored.append((-best, rid))
        out[idx] = [rid for _, rid in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("min_pct,k", [(0.0, 2), (30.0, 3), (60.0, 1)])
def test_search_matches_brute_force(spark, min_pct, k):
    part = spark.read.parquet(f"{SF001}/part.parquet")
    terms = [(0, "blue gear"), (1, "Brand#1"), (2, "smal rng"), (3, "zzz"), (4, "red")]
    items = spark.createDataFrame(terms, "item_index int, term string")
    got = similarity_search(part, "p_partkey", ["p_name", "p_brand"], items, min_pct=min_pct, k=k).collect()
    by_item = {}
    for r in sorted(got, key=lambda r: (r.item_index, r["rank"])):
        by_item.setdefault(r.item_index, []).append(r.id)
    ent = [(r.p_partkey, (r.p_name, r.p_brand)) for r in part.collect()]
    want = _brute(terms, ent, 2, min_pct, k)
    for idx, _ in terms:
        assert by_item.get(idx, []) == want[idx], idx


def test_topk_plan_limits_before_shuffle(spark):
    part = spark.read.parquet(f"{SF001}/part.parquet")
    items = spark.createDataFrame([(0, "blue gear")], "item_index int, term string")
    df = similarity_search(part, "p_partkey", ["p_name"], items, k=2)
    df.collect()
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_search_request(spark):
    from sparkdesk.operators.simsearch import search_request

    part = spark.read.parquet(f"{SF001}/part.parquet")
    ents = {"Product": (part, "p_partkey", ["p_name", "p_brand"])}
    res = search_request(ents, "Product", '["", "   ", "blue gear"]', "null", "null").collect()
    assert {r.item for r in res} == {"item_2"} and len(res) == 1  # defaults: k = 1, 30 %
    st = search_request(ents, "Nope", '["x"]', spark=spark).first()
    assert st.status == "Entity not found"
    with pytest.raises(ValueError):
        search_request(ents, None, '["x"]')


@pytest.mark.parametrize("held", [True, False])
def test_passages_in_long_documents_by_both_measures(spark, tmp_path, monkeypatch, held):
    import random

    from sparkdesk.operators import simsearch

    if not held:  # terms read by the tasks, two at a time
        monkeypatch.setattr(simsearch, "TERM_ROWS", 1)
        monkeypatch.setattr(simsearch, "BLOCK_TERMS", 2)
        monkeypatch.setattr(simsearch, "CHUNK_PLACES", 3000)

    from sparkdesk.functions.trigram import best_extent_similarity, py_trigram_list, py_trigram_set
    from sparkdesk.plans.search_queries import BENCH_K, BENCH_MIN_PCT, simsearch_benchmark_docs_both

    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(80)]
    passages = [" ".join(rnd.choices(words, k=12)) for _ in range(4)]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randint(5, 150)))) for i in range(25)]
    docs += [(100 + i, " ".join(rnd.choices(words, k=300)) + " " + p + " " + " ".join(rnd.choices(words, k=300))) for i, p in enumerate(passages)]
    docs += [(200, docs[-1][1]), (201, None), (202, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = []
    for j, p in enumerate(passages):
        scores = sorted((-100.0 * best_extent_similarity(py_trigram_set(p), py_trigram_list(t)), i) for i, t in docs)
        want += [(j, i, r + 1, round(-s, 4)) for r, (s, i) in enumerate([x for x in scores if -x[0] > BENCH_MIN_PCT][:BENCH_K])]
    got = sorted((r.item_index, r["rank"], r.id, r.score) for r in simsearch_benchmark_docs_both(spark, str(tmp_path)).collect())
    assert got == sorted((j, r, i, s) for j, i, r, s in want)
    assert all((j, 1, 100 + j, 100.0) in got for j in range(4))


def test_window_scores_equal_the_plain_run_search():
    import random

    import numpy as np

    from sparkdesk.functions import text_windows as tw
    from sparkdesk.functions.trigram import best_extent_similarity, py_trigram_code_list, py_trigram_codes

    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    terms = [" ".join(rnd.choices(words, k=rnd.choice([1, 2, 5, 20]))) for _ in range(25)] + ["é ½", "a"]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([1, 5, 60, 300]))) for _ in range(25)]
    texts += ["same " * 200, "Ünï-cödé ½ " + terms[3] + " tail", terms[4] * 3, "a"]
    block = tw.TermBlock([np.unique(tw.trigram_places(t)) for t in terms])
    for text in texts:
        codes = tw.trigram_places(text)
        assert codes.tolist() == py_trigram_code_list(text)
        for floor in (1e-9, 0.3, 0.7, 1.0):
            got = tw.scores_of(tw.Text(codes), block, np.full(len(terms), floor))
            for j, term in enumerate(terms):
                want = best_extent_similarity(py_trigram_codes(term), codes.tolist())
                assert abs(got.get(j, 0.0) - (want if want >= floor else 0.0)) < 1e-9
    assert len(tw.trigram_places(None)) == len(tw.trigram_places(" -- ")) == 0


def test_small_inputs_are_spread_over_the_slots(spark):
    from sparkdesk.session import spread_small

    part = spark.read.parquet(f"{SF001}/part.parquet")
    assert spread_small(part).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_entity_sets_are_never_broadcast(spark):
    """The planned size of the entity's sets is that of a compressed table: no plan may send them through the driver."""
    entity = spark.range(300).select(F.col("id"), F.concat(F.lit("name of "), F.col("id").cast("string")).alias("name"))
    items = spark.createDataFrame([(0, "name of 7")], "item_index int, term string")
    found = similarity_search(entity, "id", ["name"], items, min_pct=30.0, k=2, use_word_similarity=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [id" in plan


def test_floors_keep_every_best_row(spark):
    """Rows whose bound is under an item's floor are dropped; ties and repeated ids are not."""
    names = ["blue ring", "blue ring", "old ring", "ring blue x", "lue rin", "green bolt", "a b c", "ring"]
    entity = spark.createDataFrame([(i % 6, n) for i, n in enumerate(names)], "id long, name string")
    items = [(0, "lue ring"), (1, "een bolt"), (2, "ring")]
    got = similarity_search(entity, "id", ["name"], spark.createDataFrame(items, "item_index int, term string"), min_pct=20.0, k=3).collect()
    from sparkdesk.functions.trigram import best_extent_similarity, py_trigram_list, py_trigram_set

    for item in (0, 1, 2):
        scores = []
        for _, term in (x for x in items if x[0] == item):
            a = set(py_trigram_set(term, True))
            for n in names:
                b = set(py_trigram_set(n, True))
                scores.append(max(len(a & b) / len(a | b), best_extent_similarity(a, py_trigram_list(n, True))))
        want = sorted((round(s * 100, 4) for s in scores if s * 100 > 20.0), reverse=True)[:3]
        assert [r.score for r in sorted(got, key=lambda r: r["rank"]) if r.item_index == item] == want


def test_coarse_windows_come_first_and_guesses_stay_below_scores():
    import random

    import numpy as np

    from sparkdesk.functions import text_windows as tw

    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 7))) for _ in range(200)]
    terms = [" ".join(rnd.choices(words, k=rnd.choice([3, 10, 30]))) for _ in range(20)]
    block = tw.TermBlock([np.unique(tw.trigram_places(t)) for t in terms])
    for text in ([" ".join(rnd.choices(words, k=n)) for n in (3, 40, 700)] + [terms[2] + " x " + terms[7]]):
        part = tw.Text(tw.trigram_places(text))
        for floor in (0.2, 0.5, 0.9):
            floors = np.full(len(terms), floor)
            exact, guess = tw.scores_of(part, block, floors), tw.guesses_of(part, block, floors)
            assert all(floor <= s <= exact[j] for j, s in guess.items())
            windows = block.windows(part, floors)
            if windows is not None:  # windows in the matrix products: a quarter of the blocks times the rungs
                assert sum(len(group) for group, *_ in windows.wide()) <= (len(part.starts) // 2 + 1) * (len(windows.ladder) // 2 + 1)
                # the single blocks counted are those that the coarse count left; none above a floor is missed
                assert set(exact) <= set(windows.terms[windows.bounds()[0]].tolist())


def _plain_scores(term, text):
    from sparkdesk.functions.trigram import py_trigram_set

    a, b = set(py_trigram_set(term)), set(py_trigram_set(text))
    return 100.0 * len(a & b) / len(a | b) if a and b else 0.0


def test_only_rows_that_can_be_returned_are_stored_for_the_joins(spark, monkeypatch):
    """The sets of rows that no term reaches, or that are not among a task's k best, are neither stored nor joined."""
    import random

    from sparkdesk.operators import simsearch

    rnd = random.Random(23)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(60)]
    terms = [(j, " ".join(rnd.choices(words, k=8))) for j in range(5)] + [(7, "!!"), (None, words[0])]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(1500)] + [t for _, t in terms[:2]] * 3 + [None, ""]
    rows = [(i if i % 40 else None, t) for i, t in enumerate(texts)] + [(5, texts[9])]
    stored = []
    cut = simsearch.cut_lineage
    monkeypatch.setattr(simsearch, "cut_lineage", lambda df: stored.append(df.count()) or cut(df))
    entity = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    items = spark.createDataFrame(terms, "item_index int, term string")
    found = similarity_search(entity, "id", ["text"], items, min_pct=30.0, k=3, use_word_similarity=False, fold_upper=False)
    got = sorted((r.item_index, r["rank"], r.id, r.score) for r in found.collect())
    want = []
    for j, term in terms[:-2]:
        best = sorted((-_plain_scores(term, t or ""), i) for i, t in rows if i is not None)
        want += [(j, r + 1, i, round(-s, 4)) for r, (s, i) in enumerate([x for x in best if -x[0] > 30.0][:3])]
    assert got == want and stored and stored[0] < len(rows) / 4


@pytest.mark.parametrize("dense", [True, False])
def test_counted_rows_hold_every_best_row(monkeypatch, dense):
    import random

    import numpy as np

    from sparkdesk.functions import trigram_counts as tc
    from sparkdesk.functions.trigram import py_trigram_codes

    if not dense:
        monkeypatch.setattr(tc, "DENSE", 0)
    monkeypatch.setattr(tc, "GROUP_CHARS", 2000)
    rnd = random.Random(29)
    words = ["".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 6))) for _ in range(150)]
    terms = [" ".join(rnd.choices(words, k=n)) for n in (1, 4, 9, 20, 20)]
    lists = tc.TermLists([np.array(py_trigram_codes(t)) for t in terms])

    def text(n):  # some texts are far longer than any term allows, some repeat few words over and over
        return rnd.choice([" ", "-", "  "]).join(rnd.choices(words if n < 900 else words[:6], k=n))

    firsts = [None, "", "--", terms[3], "x" * 5000, "ΑΣ ΑΣ", *(text(rnd.choice([2, 5, 30, 200, 900])) for _ in range(60)), " ".join(words * 40)]
    seconds = [rnd.choice([None, "", terms[2], text(6), text(300)]) for _ in firsts]
    reaching, seen, kept = tc.Reaching(lists, 20.0, 2), [], set()
    for a in range(0, len(firsts), 13):
        rows = reaching.rows([firsts[a:a + 13], seconds[a:a + 13]])
        assert rows.tolist() == sorted(set(rows.tolist()))
        kept |= {a + r for r in rows.tolist()}
        seen += range(a, min(a + 13, len(firsts)))
        for term in terms:
            score = {i: max(_plain_scores(term, firsts[i] or ""), _plain_scores(term, seconds[i] or "")) for i in seen}
            over = sorted((s for s in score.values() if s > 20.0), reverse=True)
            assert {i for i, s in score.items() if over and s >= over[min(2, len(over)) - 1]} <= kept
    for t in firsts:
        codes, owner = tc.distinct_codes([(t or "").lower()])
        assert sorted(py_trigram_codes(t)) == codes.tolist() and not owner.any()


def test_quoted_runs_score_no_more_than_the_text_and_find_quotes():
    import random

    import numpy as np

    from sparkdesk.functions.quoted_runs import Quotes
    from sparkdesk.functions.trigram import best_extent_similarity, py_trigram_code_list, py_trigram_codes

    rnd = random.Random(31)
    words = ["".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    terms = [" ".join(rnd.choices(words, k=n)) for n in (30, 30, 12, 2)] + ["", "same same " * 30]
    texts = [" ".join(rnd.choices(words, k=80)) for _ in range(6)] + ["", terms[1], "same " * 300]
    texts += [texts[0] + " " + terms[0] + " " + texts[1], " ".join(terms[0].split()[:20]) + " x", terms[2].upper().lower() + " tail", texts[2] + terms[1]]
    got = {(i, j): s for i, j, s in Quotes(terms).scores([t.lower() for t in texts])}
    for (i, j), s in got.items():
        assert 0 < s <= best_extent_similarity(py_trigram_codes(terms[j]), py_trigram_code_list(texts[i])) + 1e-12
    assert got[9, 0] == got[7, 1] == got[11, 2] == 1.0 and 0.5 < got[10, 0] < 1.0 and got[12, 1] > 0.9
    assert Quotes([]).scores(texts) == Quotes(["ab"]).scores(texts) == [] and np.isfinite(list(got.values())).all()


def test_floors_of_quoted_terms_leave_out_other_texts(spark, monkeypatch):
    """Texts that can't reach the k-th best of the texts that quote a term are not searched by windows, from the first one on."""
    import random

    from sparkdesk.operators import simsearch

    rnd = random.Random(37)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(60)]
    terms = [" ".join(rnd.choices(words, k=25)) for _ in range(3)]
    rows = [(i, " ".join(rnd.choices(words, k=60))) for i in range(200)]
    rows += [(1000 + i, "start " + terms[i % 3] + " end") for i in range(9)]
    floors = []
    held = simsearch._held_terms
    monkeypatch.setattr(simsearch, "_held_terms", lambda rows: floors.append([r[2] for r in rows]) or held(rows))
    entity = spark.createDataFrame(rows, "id long, text string")
    items = spark.createDataFrame(list(enumerate(terms)), "item_index int, term string")
    found = simsearch.search_long_texts(entity, "id", "text", items, min_pct=30.0, k=3).collect()
    assert sorted((r.item_index, r["rank"], r.id, r.score) for r in found) == [(j, r + 1, 1000 + j + 3 * r, 100.0) for j in range(3) for r in range(3)]
    assert len(floors) == 2 and all(f > 0.99 for some in floors for f in some)


def test_ends_of_windows_equal_a_plain_count():
    import random

    import numpy as np

    from sparkdesk.functions import text_windows as tw

    rnd = random.Random(41)
    for n in (1, 30, 400, 3000):
        codes = np.array([rnd.randrange(rnd.choice([5, 90])) for _ in range(n)])
        text, sizes = tw.Text(codes), np.array([3, 10, 60])
        for s, row in zip(text.starts.tolist(), text.window_ends(text.starts, sizes).tolist(), strict=True):
            for size, end in zip(sizes.tolist(), row, strict=True):
                assert len(set(codes[s:end].tolist())) <= size and (end == n or len(set(codes[s:end + 1].tolist())) == size + 1)
