import random

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import memory

LOG = [  # seq, op, assistant, user, id, content
    (1, "add", "a1", "u1", "m1", "likes tea"),
    (2, "search", "a1", "u1", None, "tea"),
    (3, "update", "a1", "u2", "m1", "hijack"),   # another user: not found
    (4, "update", "a1", "u1", "m1", "likes green tea"),
    (5, "delete", "a1", "u1", "m1", None),
    (6, "update", "a1", "u1", "m1", "too late"),
    (7, "add", "a1", "u1", "m2", "x"),
    (8, "add", "a1", "u2", "m2", "dup"),          # id already taken
    (9, "frobnicate", "a1", "u1", "m2", "x"),
    (10, "add", "a1", None, "m3", "x"),
]
SCHEMA = "seq long, op string, assistant_id string, user_id string, memory_id string, content string"


def test_status_and_state(spark):
    log = spark.createDataFrame(LOG, SCHEMA)
    status = {r.seq: r.status for r in memory.fold_status(log).collect()}
    assert status == {1: "added", 2: "search", 3: "not found", 4: "updated", 5: "deleted", 6: "not found",
                      7: "added", 8: "duplicate", 9: "invalid", 10: "invalid"}
    state = memory.fold_state(memory.fold_status(log)).collect()
    assert [(r.memory_id, r.user_id, r.content) for r in state] == [("m2", "u1", "x")]


def test_order_of_input_does_not_matter(spark):
    rows = LOG[:]
    random.Random(1).shuffle(rows)
    a = sorted(repr(tuple(r)) for r in memory.fold_status(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect())
    b = sorted(repr(tuple(r)) for r in memory.fold_status(spark.createDataFrame(LOG, SCHEMA)).collect())
    assert a == b


def test_knn_blocks_agree_with_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    mem = spark.createDataFrame([(f"u{i % 3}", i, [rnd.random() for _ in range(8)]) for i in range(120)],
                                "user string, id long, vec array<double>")
    q = spark.createDataFrame([(1000 + i, f"u{i % 3}", [rnd.random() for _ in range(8)], None) for i in range(6)],
                              "query_id long, user string, vec array<double>, source_id long")
    block = sorted((r.query_id, r.id, r["rank"]) for r in memory.knn(mem, q, k=4).collect())
    monkeypatch.setattr(memory, "QUERY_BLOCK_ROWS", 2)
    monkeypatch.setattr(memory, "QUERY_CHUNK", 1)
    blocked = sorted((r.query_id, r.id, r["rank"]) for r in memory.knn(mem, q, k=4).collect())
    assert block == blocked and len(block) == 24
    # brute force
    ms = [(r.user, r.id, r.vec) for r in mem.collect()]
    want = []
    for r in q.collect():
        d = sorted((sum((a - b) ** 2 for a, b in zip(r.vec, v)) ** 0.5, i) for u, i, v in ms if u == r.user)
        want += [(r.query_id, i, n + 1) for n, (_, i) in enumerate(d[:4])]
    assert block == sorted(want)


def test_result_lines(spark):
    ranked = spark.createDataFrame([("u1", 2, 7), ("u1", 1, 9)], "user string, rank int, id long")
    r = memory.result_lines(ranked, F.concat(F.lit("t"), F.col("id").cast("string")), ["user"]).first()
    assert r.result == "- t9 (memory_id: 9)\n- t7 (memory_id: 7)"


def test_state_per_assistant(spark, tmp_path):
    log = spark.createDataFrame(LOG + [(11, "add", "a2", "u9", "m1", "other assistant")], SCHEMA)
    memory.write_state(memory.fold_state(memory.fold_status(log)), str(tmp_path / "state"))
    assert sorted(p.name for p in (tmp_path / "state").iterdir() if p.name.startswith("assistant_id=")) == [
        "assistant_id=a1", "assistant_id=a2"]
    back = spark.read.parquet(str(tmp_path / "state")).filter(F.col("assistant_id") == "a2").collect()
    assert [(r.memory_id, r.content) for r in back] == [("m1", "other assistant")]


def test_adds_without_an_id_get_one(spark):
    log = spark.createDataFrame([(1, "add", "a1", "u1", None, "first"), (2, "add", "a1", "u1", " ", "second"), (3, "add", "a2", "u1", None, "third"),
                                 (4, "search", "a1", "u1", None, "x"), (5, "update", "a1", "u1", "mem-a1-2", "changed")], SCHEMA)
    status = memory.fold_status(log)
    assert {r.seq: r.status for r in status.collect()} == {1: "added", 2: "added", 3: "added", 4: "search", 5: "updated"}
    assert sorted(r.content for r in memory.fold_state(status).collect()) == ["changed", "first", "third"]


def test_templates_beyond_the_shipped_bound(spark, monkeypatch):
    rnd = random.Random(8)
    rows = spark.createDataFrame([(i, f"u{i % 3}", [rnd.random() for _ in range(4)]) for i in range(40)], "id long, user string, vec array<double>")
    templates = spark.createDataFrame([(100 + i, f"u{i % 2}", [rnd.random() for _ in range(4)]) for i in range(9)],
                                      "template_id long, user string, vec array<double>")
    shipped = sorted((r.id, r.template_id, round(r.distance, 9) if r.template_id else None) for r in memory.best_template(rows, templates, 0.5).collect())
    monkeypatch.setattr(memory, "QUERY_BLOCK_ROWS", 3)
    joined = sorted((r.id, r.template_id, round(r.distance, 9) if r.template_id else None) for r in memory.best_template(rows, templates, 0.5).collect())
    assert shipped == joined


def test_many_queries_and_the_none_found_line(spark, monkeypatch, tmp_path):
    from sparkdesk.plans import memory_queries

    rnd = random.Random(9)
    rows = [(i, [rnd.random() for _ in range(4)], i % 2) for i in range(100)] + [(200, [0.5] * 4, 7)]  # label 7 has one memory
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    for bound in (20_000, 2):  # shipped at once; hash blocks and the join
        monkeypatch.setattr(memory, "QUERY_BLOCK_ROWS", bound)
        got = {r.query_id: r for r in memory_queries.memory_search_many(spark, str(tmp_path)).collect()}
        assert sorted(got) == [0, 20, 40, 60, 80, 200] and all(len(got[i].ids) == 3 for i in (0, 20, 40, 60, 80))
        assert got[200].ids == [] and got[200].result == "No memories found for user_id 7 with query: embedding 200"
        matched = memory_queries.template_match_many(spark, str(tmp_path)).collect()
        assert len(matched) == len(rows) and {r.template_id for r in matched} <= {None, 0, 20, 40, 60, 80, 200}
        assert all(r.template_id == r.vec_id for r in matched if r.vec_id % 20 == 0)


def _random_points(spark, n, users, dims=6, seed=3):
    rnd = random.Random(seed)
    rows = [(f"u{min(i % 10, users - 1)}", i, [rnd.gauss(0, 1) + (i % 4) * 3 for _ in range(dims)]) for i in range(n)]
    rows += [("u0", n, rows[0][2]), ("u0", n + 1, [0.0] * dims), (None, n + 2, rows[1][2]), ("u1", n + 3, None)]
    return rows, spark.createDataFrame(rows, "user string, id long, vec array<double>")


@pytest.mark.parametrize(("metric", "limit"), [("l2", None), ("l2", 2.0), ("cosine", None), ("cosine", 0.05)])
def test_pivot_join_equals_brute_force(spark, monkeypatch, metric, limit):
    import numpy as np

    from sparkdesk.operators import metric_join

    monkeypatch.setattr(metric_join, "BLOCK_POINTS", 16)  # several blocks and shares for the hot user
    monkeypatch.setattr(metric_join, "SHARE_QUERIES", 8)
    rows, mem = _random_points(spark, 300, 3)
    queries = [(r[1], r[0], r[2], r[1]) for r in rows if r[1] % 7 == 0 or r[1] >= 300] + [(9000, "nobody", [1.0] * 6, None)]
    got = metric_join.nearest(mem, spark.createDataFrame(queries, "query_id long, user string, vec array<double>, source_id long"), 3, metric,
                              exclude_self=True, max_distance=limit, n_pivots=8)

    def dist(a, b):
        a, b = np.array(a), np.array(b)
        if metric == "l2":
            return float(np.linalg.norm(a - b))
        return 1.0 - float(a @ b) / max(float(np.linalg.norm(a) * np.linalg.norm(b)), 1e-300)

    want = []
    for qid, user, vec, source in queries:
        if user and vec:
            near = sorted((round(dist(vec, v), 6), i) for u, i, v in rows if u == user and v and i != source and (limit is None or dist(vec, v) < limit))
            want += [(qid, i, d, n + 1) for n, (d, i) in enumerate(near[:3])]
    found = sorted((r.query_id, r["rank"], r.distance) for r in got.collect())
    want = sorted((q, n, d) for q, _, d, n in want)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in found], [x[2] for x in want], atol=2e-6)


def test_pivots_leave_out_far_cells():
    import numpy as np

    from sparkdesk.operators.metric_join import distances, needed_cells

    rnd = np.random.default_rng(1)
    pivots = rnd.normal(size=(20, 4)) * 5
    points = pivots[rnd.integers(0, 20, 2000)] + rnd.normal(size=(2000, 4)) * 0.3
    d = distances(points, pivots, "l2")
    cell = d.argmin(axis=1)
    radius = d[np.arange(2000), cell]
    ids = np.unique(cell)
    n, low, high = (np.array([f(radius[cell == c]) for c in ids]) for f in (len, np.min, np.max))
    gap = distances(pivots, pivots, "l2")
    used = 0
    for q in points[:200]:
        need = needed_cells(distances(q[None], pivots, "l2")[0], gap, ids, n, low, high, 3, np.inf)
        near = np.argsort(np.linalg.norm(points - q, axis=1), kind="stable")[:3]
        assert set(cell[near]) <= set(ids[need])
        used += need.sum()
    assert used < 0.3 * 200 * len(ids)


def test_many_templates_of_one_agent(spark):
    """50,000 templates of one agent: the threshold's cells only, no product of rows and templates."""
    import numpy as np

    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(40, 4)) * 20
    t = centres[rnd.integers(0, 40, 50_000)] + rnd.normal(size=(50_000, 4))
    q = centres[rnd.integers(0, 40, 300)] + rnd.normal(size=(300, 4))
    templates = spark.createDataFrame([(i, "a", v) for i, v in enumerate(t.tolist())], "template_id long, user string, vec array<double>")
    rows = spark.createDataFrame([(i, "a", v) for i, v in enumerate(q.tolist())] + [(999, "b", [0.0] * 4)], "id long, user string, vec array<double>")
    got = {r.id: (r.template_id, r.distance) for r in memory.best_template(rows, templates, 0.5).collect()}
    assert got.pop(999) == (None, None) and len(got) == 300
    for i, (tid, d) in got.items():
        all_d = np.linalg.norm(t - q[i], axis=1)
        assert (tid is None and all_d.min() >= 0.5 - 1e-9) or (abs(all_d[tid] - all_d.min()) < 1e-6 and abs(d - all_d.min()) < 1e-6)


def test_read_collections_prunes_assistants(spark, tmp_path):
    state = spark.createDataFrame([(f"a{i}", f"m{j}", "u", "c", j) for i in range(20) for j in range(3)],
                                  "assistant_id string, memory_id string, user_id string, content string, last_seq long")
    memory.write_state(state, str(tmp_path / "state"))
    asked = spark.createDataFrame([("a3", 1), ("a3", 2), ("a7", 1), ("gone", 1), ("a9", 0), (None, 1)], "assistant_id string, n int").where("n > 0")
    got = memory.read_collections(spark, str(tmp_path / "state"), asked)
    assert sorted((r["assistant_id"], r["memory_id"]) for r in got.collect()) == [(a, f"m{j}") for a in ("a3", "a7") for j in range(3)]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()


def test_ties_of_copies_stay_within_k(spark, monkeypatch):
    """Copies of one point: a block hands on k rows a query, not every tie, and the lowest ids win."""
    from sparkdesk.operators import metric_join

    monkeypatch.setattr(metric_join, "SLICE_QUERIES", 7)
    mem = spark.createDataFrame([(f"u{i % 2}", i, [1.0, float(i % 2)]) for i in range(400)], "user string, id long, vec array<double>")
    asked = mem.selectExpr("id as query_id", "user", "vec", "id as source_id")
    made = []
    grouped = type(mem.groupBy("id").cogroup(mem.groupBy("id")))
    plain = grouped.applyInPandas

    def counted(self, func, schema):
        def run(key, left, right):
            import pandas as pd

            out = func(key, left, right)
            return out if len(out) <= 3 * len(right) else pd.DataFrame({"query_id": [-1], "user": ["ties"], "id": [-1], "distance": [0.0]})
        made.append(schema)
        return plain(self, run, schema)

    monkeypatch.setattr(grouped, "applyInPandas", counted)
    got = metric_join.nearest(mem, asked, 3, exclude_self=True).collect()
    assert made and not [r for r in got if r.user == "ties"]
    rows = {q: [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in range(400)}
    assert rows == {q: [i for i in range(q % 2, 400, 2) if i != q][:3] for q in range(400)}
