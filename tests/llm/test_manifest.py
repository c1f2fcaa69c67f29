"""Merkle manifest against a plain recomputation."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sparkdesk.llm.manifest import manifest
from sparkdesk.llm.positions import positions

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos string, path string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(hashes, fanout):
    """(root, path of every leaf as a list of (before, after))."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[k:k + fanout] for k in range(0, len(level), fanout)]
        for i in range(len(paths)):
            run, k = runs[at[i] // fanout], at[i] % fanout
            paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            at[i] //= fanout
        level = [sha(*run) for run in runs]
    return level[0], paths


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, leaf(r[0], r[3], r[2], r[4], r[1])))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        subs[g] = tree([h for _, h in groups[g]], fanout)
    root, tops = tree([subs[g][0] for g in names], fanout)
    out = []
    for g, top in zip(names, tops, strict=True):
        for (r, h), low in zip(groups[g], subs[g][1], strict=True):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            now = leaf(r[0], r[3], r[2], r[4] + 1, r[1]) if bad else h
            folded = now
            for before, after in low + top:
                folded = sha(before, folded, after)
            out.append((r[0], h, subs[g][0], root, sha(*[x + y for x, y in low + top]), folded))
    return sorted(out, key=str)


def rows_of(n):
    rows = [(i, "é" * (i % 5) if i % 4 else None, [None, "en", "en", "en", "Z", "É", "a"][i % 7] if i < 60 else "en", "s" if i % 3 else None,
             i if i % 5 else None, "g", "p", "q") for i in range(n)]
    return [*rows, rows[3], rows[3], (None, "x", "en", None, None, "g", "p", "q"), (None, "x", "en", None, None, "g", "p", "q"), (-5, "", "", "", 0, "", "", ""),
            (7, "long " * 50_000, "en", "s", 1, "", "", ""), (9999, None, None, None, None, None, None, None), (5, "solo", "zz", "s", 4, "", "", "")]


@pytest.mark.parametrize(("fanout", "levels"), [(2, 3), (2, 1), (3, 2), (5, 1)])
def test_manifest_equals_brute_force(spark, fanout, levels):
    rows = rows_of(150)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    bad = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = manifest(docs, check={"n_chars": bad}, fanout=fanout, levels=levels).collect()
    mine = sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], sha(*[s["before"] + s["after"] for s in r["path"]]), r["folded"]) for r in got), key=str)
    want = brute(rows, fanout)
    assert mine == want and len({r[3] for r in want}) == 1
    assert {r[0] for r in mine if r[5] != r[3]} >= {i for i in range(150) if zlib.crc32(str(i).encode()) % 7 == 0 and i % 5}


def test_manifest_of_one_row_and_of_none(spark):
    one = [(1, "t", None, "s", 1, "", "", "")]
    r = manifest(spark.createDataFrame(one, SCHEMA)).first()
    assert r["root"] == r["subroot"] == r["leaf"] == r["folded"] == leaf(1, "s", None, 1, "t") and r["path"] == []
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_positions_of_a_hot_group(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), (F.col("id") * 7919 % 3001).alias("k"))
    got = positions(rows, "g", ["k"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["k"], r["pos"], r["n"]))
    for found in by.values():
        assert [p for _, p, _ in sorted(found)] == list(range(len(found))) and {n for *_, n in found} == {len(found)}
