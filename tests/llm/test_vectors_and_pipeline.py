"""Embedding near-duplicates, components, the registered queries and the pipeline."""

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sparkdesk.llm import embedding_dedup, queries
from sparkdesk.llm.components import components
from tests.conftest import SF001


def brute_vectors(rows):
    good = {k: np.array(v, np.float64) for k, (_, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label, links = list(range(len(rows))), [0] * len(rows)
    for a, u in good.items():
        for b, w in good.items():
            if a < b and len(u) == len(w) and u @ w >= 0.9 * np.linalg.norm(u) * np.linalg.norm(w) - 1e-12:
                links[a] += 1
                links[b] += 1
                x, y = label[b], label[a]
                label = [y if v == x else v for v in label]
    least = {}
    for (i, _), v in zip(rows, label, strict=True):
        if i is not None:
            least[v] = min(i, least.get(v, i))
    return sorted(((i, n, least.get(v), i == least.get(v)) for (i, _), n, v in zip(rows, links, label, strict=True)), key=str)


@pytest.mark.parametrize("block", [400, 5])
def test_near_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = []
    for c in range(12):
        center = rng.standard_normal(64)
        rows += [(100 * c + k, [float(np.float32(x)) for x in center + 0.1 * rng.standard_normal(64)]) for k in range(8)]
    rows += [(2000, rows[0][1]), (2001, rows[0][1]), (3, rows[3][1]), (None, rows[5][1]), (3000, None), (3001, []), (3002, [0.0] * 64),
             (3003, [None] + [1.0] * 63), (3004, [float("nan")] + [1.0] * 63), (3005, [1.0, 2.0]), (3006, [2.0, 4.0]), (3007, [float("inf")] * 64)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cid int, e1 int")
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(table).collect()), key=str)
    assert got == brute_vectors(rows)
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((200, 8)) * 2
    p = embedding_dedup.nearest_e8(x)
    doubled = np.rint(2 * p)
    assert (np.abs(doubled % 2 - doubled[:, :1] % 2) == 0).all() and (p.sum(axis=1) % 2 == 0).all()
    steps = embedding_dedup.shortest()
    assert len(steps) == 240
    assert all((((x - p) ** 2).sum(1) <= ((x - p - s) ** 2).sum(1) + 1e-9).all() for s in steps)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000), (None, 3), (1, 0)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 301)}, **{1000 + k: 1000 for k in range(1, 200)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_entry_lists_all_corpus_queries():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_pipeline_stages_on_whole_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    sizes = [docs.count()]
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, SF001).write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert sizes[0] >= sizes[1] == sizes[2] >= sizes[3] >= sizes[4] == sizes[5] > 0
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    from collections import Counter

    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    res = con.execute(queries.ORACLES[key])
    names = [d[0] for d in res.description]
    want = Counter(res.fetchall())
    assert Counter(tuple(r) for r in queries.QUERIES[key](spark, SF001).select(*names).collect()) == want


def test_suffix_dedup_query_on_planted_passages(spark, tmp_path):
    """Passages of over 50 words that two documents share: the contract's 400 bytes decide, not the words."""
    import hashlib

    rng = np.random.default_rng(7)

    def words(n, letters):
        return " ".join("".join(rng.choice(list(letters), k)) for k in rng.integers(4, 9, n))

    def passage(size):
        """Over 50 words in exactly ``size`` bytes."""
        text = words(55, "abcdefgh")
        return (text + "é" + "z" * size).encode()[:size].decode()

    rows, want = [], []
    for k, size in enumerate((394, 399, 400, 401, 700)):
        shared = passage(size)
        assert len(shared.encode()) == size and len(shared.split()) > 50
        for j in (0, 1):  # the neighbouring bytes differ, so that no match is longer than the passage
            head, tail = words(40, "mnopq") + ":;"[j], "<>"[j] + words(40, "mnopq")
            rows.append((10 * k + j, head + shared + tail))
            kept, n = (head + tail, size) if size >= 400 else (rows[-1][1], 0)
            want.append((10 * k + j, len(rows[-1][1].encode()), n, int(n > 0), hashlib.sha256(kept.encode()).hexdigest()))
    rows += [(100 + k, words(150, "rstuv")) for k in range(10)]
    want += [(i, len(t), 0, 0, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows[-10:]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op7_suffix_dedup"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def brute_survivors(rows):
    """One row of every group of linked texts: the smallest non-null doc_id's."""
    rows = sorted(set(rows), key=repr)
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = label[a], label[b]
                label = [y if v == x else v for v in label]
    groups = {}
    for r, v in zip(rows, label, strict=True):
        groups.setdefault(v, []).append(r)
    least = {v: min((r[0] is None, r[0] or 0) for r in g) for v, g in groups.items()}
    return [(None if least[v][0] else least[v][1], {r[1] for r in g if (r[0] is None, r[0] or 0) == least[v]}) for v, g in groups.items()]


def near_rows():
    """Groups with null ids only, a repeated id within one group and over two groups, equal texts of two sources, lone and empty rows."""
    rng = np.random.default_rng(4)

    def text():
        return " ".join(f"w{x}" for x in rng.integers(0, 10**6, 60))

    def near(t, k):
        return t + f" tail{k}"

    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [(None, a, "en", "web"), (None, near(a, 1), "en", "web"), (None, near(a, 2), "en", "books"),
            (None, b, "en", "web"), (5, near(b, 1), "en", "web"), (6, near(b, 2), "en", "web"),
            (7, c, "en", "web"), (7, near(c, 1), "en", "web"), (7, c, "en", "books"),
            (8, d, "en", "web"), (9, near(d, 1), "en", "web"), (8, e, "en", "web"), (2, near(e, 1), "en", "web"),
            (None, f, "en", "web"), (None, "", "en", "web"), (11, "", "en", "web"), (12, None, "en", "web"), (13, text(), "en", "web")]
    return [(*r, len(r[1] or "")) for r in rows]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def same_survivors(got, want):
    """got: (doc_id, text) rows; want: (doc_id, the texts of which one stays)."""
    left = list(want)
    for i, t in got:
        at = next((k for k, (j, texts) in enumerate(left) if i == j and t in texts), None)
        if at is None:
            return False
        left.pop(at)
    return not left


def test_one_row_stays_of_every_group(spark):
    rows = near_rows()
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, DOCS), SF001).collect()]
    assert same_survivors(got, brute_survivors(rows))


def test_pipeline_run_against_brute_force(spark, tmp_path):
    from collections import Counter

    import public_tokenizers
    import tokenizers

    rows = near_rows()
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF001}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))  # every score 0
    spark.read.parquet(f"{SF001}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))  # no passage of it in the rows
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path(queries.ENCODE_MODEL))
    want = brute_survivors(rows)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {t: len(tok.encode(t or "", add_special_tokens=False).ids) for _, texts in want for t in texts}
    sizes = [(r.doc_id, r.n_tokens) for r in out]
    assert Counter(i for i, _ in sizes) == Counter(i for i, _ in want)
    assert same_survivors(sizes, [(i, {ids[t] for t in texts}) for i, texts in want])


def test_unit_rows_of_very_large_and_small_vectors():
    import numpy as np

    from sparkdesk.llm.embedding_dedup import unit_rows

    v = np.array([1.0, 2.0, -3.0])
    assert np.allclose(unit_rows([v, v * 1e200, v * 1e-200]), [v / np.linalg.norm(v)] * 3)
