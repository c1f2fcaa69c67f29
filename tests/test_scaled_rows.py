"""Global row numbers, interval labels of trees, quoted CSV in blocks: against plain recomputation."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import hierarchy, rules
from sparkdesk.operators.ranking import row_numbers
from sparkdesk.sources import csv_blocks


def test_row_numbers_global_ties_nulls_and_copies(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([None, 1, 1, 1, 2, 5]), rnd.choice(["a", "b", None])) for _ in range(500)] + [(7, "x")] * 200
    df = spark.createDataFrame(data, "v int, s string").repartition(5)
    got = row_numbers(df, [F.col("v").desc_nulls_last()], partitions=7).collect()
    assert sorted(r["rn"] for r in got) == list(range(1, len(data) + 1))
    by_rank = [r["v"] for r in sorted(got, key=lambda r: r["rn"])]
    assert by_rank == sorted((d[0] for d in data), key=lambda v: (v is None, -(v or 0)))
    assert sorted(map(str, ((r["v"], r["s"]) for r in got))) == sorted(map(str, data))


def test_row_numbers_in_groups_with_a_hot_and_a_null_key(spark):
    data = [(None, i) for i in range(20)] + [("hot", i) for i in range(300)] + [("one", 1)]
    df = spark.createDataFrame(data, "k string, v int").repartition(4)
    got = row_numbers(df, [F.col("v").desc()], keys=("k",), partitions=6).collect()
    sizes = {None: 20, "hot": 300, "one": 1}
    assert len(got) == len(data)
    for r in got:
        want = 1 if r["k"] == "one" else sizes[r["k"]] - r["v"]
        assert r["rn"] == want, r


def test_row_numbers_empty_and_existing_column(spark):
    empty = spark.createDataFrame([], "v int, rn int")
    out = row_numbers(empty, [F.col("v")])
    assert out.count() == 0 and dict(out.dtypes)["rn"] == "bigint"
    assert [r["rn"] for r in row_numbers(spark.createDataFrame([(4, 99)], "v int, rn int"), [F.col("v")]).collect()] == [1]


def test_row_numbers_has_no_window_in_one_task(spark):
    out = row_numbers(spark.range(100).toDF("v"), [F.col("v")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def brute_levels(edges):
    parent = {n: p for n, p in edges if n is not None}
    out = {}
    for n in parent:
        at, level, seen = n, 1, set()
        while at is not None and at in parent and at not in seen:
            out[n, at] = level
            seen.add(at)
            at, level = parent[at], level + 1
    return out


def test_interval_labels_against_brute_force(spark):
    rnd = random.Random(11)
    edges = [("r0", None), ("r1", "absent")] + [(f"n{i}", rnd.choice(["r0", "r1"] + [f"n{j}" for j in range(i)])) for i in range(60)]
    edges += [(f"hot{i}", "n3") for i in range(40)] + [(f"deep{i}", f"deep{i - 1}" if i else "n5") for i in range(33)]
    tree = spark.createDataFrame(edges + edges[:5] + [(None, "r0")], "node string, parent string")
    labels = hierarchy.interval_labels(tree).cache()
    assert labels.count() == len(edges) and labels.where("cyclic").count() == 0
    for t in ("r0", "r1"):  # the steps of one walk, each once
        rows = labels.where(F.col("tree") == t).collect()
        assert sorted(x for r in rows for x in (r["enter"], r["leave"])) == list(range(1, 2 * len(rows) + 1))
    nodes = [e[0] for e in edges] + ["nowhere", None]
    pairs = spark.createDataFrame([(a, b, 5) for a in nodes for b in nodes], "child string, parent string, level int")
    want = brute_levels([(n, None if p == "absent" else p) for n, p in edges])
    got = hierarchy.included(pairs, labels).collect()
    assert len(got) == len(nodes) ** 2
    for r in got:
        assert r["level"] == want.get((r["child"], r["parent"]), -1), r
    closure = {(r["descendant"], r["ancestor"]): r["level"] for r in rules.org_closure(spark, tree).collect()}
    assert closure == want


def test_interval_labels_cycles_two_parents_and_empty(spark):
    tree = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "b"), ("s", "s"), ("r", None), ("k", "r")], "node string, parent string")
    labels = hierarchy.interval_labels(tree)
    assert {r["node"]: r["cyclic"] for r in labels.collect()} == {"a": True, "b": True, "c": True, "s": True, "r": False, "k": False}
    pairs = spark.createDataFrame([("a", "a"), ("c", "b"), ("k", "r"), ("r", "k")], "child string, parent string")
    assert {(r["child"], r["parent"]): r["level"] for r in hierarchy.included(pairs, labels).collect()} == {
        ("a", "a"): 1, ("c", "b"): -1, ("k", "r"): 2, ("r", "k"): -1}
    with pytest.raises(hierarchy.HierarchyError):
        hierarchy.interval_labels(spark.createDataFrame([("a", "b"), ("a", "c")], "node string, parent string"))
    empty = hierarchy.interval_labels(spark.createDataFrame([], "node string, parent string"))
    assert empty.count() == 0


def as_csv(rows, eol="\r\n"):
    buf = io.StringIO()
    csv.writer(buf, lineterminator=eol).writerows(rows)
    return buf.getvalue()


def cells(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block", [7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_quoted_csv_any_block_size(spark, tmp_path, block, eol):
    rnd = random.Random(block)
    bits = ["a", "é漢", '"', '""', "\n", "\r\n", ",", " ", "", "x" * 30, "\n\n\n"]
    rows = [["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 5))) for _ in range(3)] for _ in range(60)]
    rows.append(["k", "\n" * 150, '"' * 41])  # one cell over many blocks
    path = tmp_path / "t.csv"
    path.write_bytes(as_csv([["one", "two", "three"], *rows], eol).encode())
    got = csv_blocks.read_quoted_csv(spark, str(path), block_bytes=block)
    assert got.columns == ["one", "two", "three"]
    assert cells(got) == sorted(tuple(r) for r in rows)


def test_quoted_csv_headers_short_rows_bom_and_stray_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfid,name,id,\n1,x,2,3\n4\n\n5,y,6,7,8\n")
    (tmp_path / "b.csv").write_bytes(b'name,extra,id\r\n"5"" pipe\r\nlong",e,9\r\n')
    (tmp_path / "c.csv").write_bytes(b"")
    (tmp_path / "d.csv").write_bytes(b'id,name\n10,3" odd\n11,\xff\n')  # quotes that don't pair: one task
    (tmp_path / "_hidden.csv").write_bytes(b"no,no\n1,2\n")
    got = csv_blocks.read_quoted_csv(spark, str(tmp_path), block_bytes=8)
    assert got.columns == ["id", "name", "id_2", "_c3", "extra"]
    assert cells(got) == sorted([("1", "x", "2", "3", ""), ("4", "", "", "", ""), ("5", "y", "6", "7", ""),
                                 ("9", '5" pipe\r\nlong', "", "", "e"), ("10", '3" odd', "", "", ""), ("11", "�", "", "", "")])
    heads = {(r["path"].rsplit("/", 1)[1], r["position"]): r["column"] for r in csv_blocks.headers_of(spark, str(tmp_path)).collect()}
    assert heads["b.csv", 1] == "extra" and heads["a.csv", 2] == "id" and ("c.csv", 0) not in heads


def test_quoted_csv_one_file_many_tasks(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text(as_csv([["n", "t"], *[[i, 'line\nbreak "q"'] for i in range(20_000)]], "\n"))
    got = csv_blocks.read_quoted_csv(spark, str(path), block_bytes=1 << 15)
    assert got.rdd.getNumPartitions() > 8
    per_task = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 5 and max(r["count"] for r in per_task) < 10_000
    assert got.agg(F.count_distinct("n"), F.count_distinct("t")).first()[:] == (20_000, 1)


def test_quoted_csv_without_header_or_file(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(b"")
    with pytest.raises(csv_blocks.CsvError):
        csv_blocks.read_quoted_csv(spark, str(tmp_path / "e.csv"))
    with pytest.raises(csv_blocks.CsvError):
        csv_blocks.read_quoted_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "h.csv").write_bytes(b"a,b")
    assert csv_blocks.read_quoted_csv(spark, str(tmp_path / "h.csv")).count() == 0


def test_planned_size_of_interval_labels_stays_small(spark):
    """Rounds of joins start from tables: the planned size, a product over the joins of a checkpoint's plan, does not multiply."""
    n = 300
    tree = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(n)], "node string, parent string")
    labels = hierarchy.interval_labels(tree)
    size = int(str(labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size < 1 << 24
    assert sorted((int(r.node), r.enter, r.leave, r.depth) for r in labels.collect()) == [(i, i + 1, 2 * n - i, i + 1) for i in range(n)]
