"""Prefix trie against a plain recomputation, with shards of a few rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sparkdesk.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, ids string, words string"


def brute(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            said = (role or "", text or "")
            convs.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(said[0].encode())}:{said[0]}{said[1]}".encode()).hexdigest(), said))
    own = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    count = {k: (len(v) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0 for k, v in nodes.items()}
    parents = {k[:-1] for k in nodes if k}
    out = []
    for k, v in nodes.items():
        sub = [x for x in nodes if x[:len(k)] == k]
        ends = ",".join(str(c) for c in sorted(v) if len(built[c]) == len(k))
        out.append((min(v), len(k), min(nodes[k[:-1]]) if k else None, len(v), sum(1 for x in sub if len(x) == len(k) + 1), sum(1 for x in sub if x not in parents),
                    sum(count[x] for x in sub), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed, n=140):
    rnd, rows = random.Random(seed), []
    for c in range(n):
        for turn in range(rnd.choice([1, 1, 2, 3, 5, 9])):
            hot = rnd.random() < 0.8
            rows.append((c, turn if rnd.random() < 0.9 else None, "user" if turn % 2 else None, "hello there" if hot and turn < 3 else rnd.choice([None, "", "a b", "x  y\tz", "é " * 50, "q"]), "k", "i", "w"))
    rows += [(200, t, "user", f"turn {t % 7}", "", "", "") for t in range(60)] + [(201, t, "user", f"turn {t % 7}", "", "", "") for t in range(60)]
    return rows + [(None, 0, "user", "lost", "", "", ""), (3, 0, "user", "again", "", "", ""), (3, 0, "user", "again", "", "", ""), (1000, 0, "u", "long " * 40_000, "", "", "")]


def run(docs):
    lists = prefix_trie.turn_lists(docs)
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    out = prefix_trie.prefix_trie(prefix_trie.with_shared_heads(lists, F.col("conv_id") - F.col("conv_id") % 20, head, 3))
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = rows_of(seed)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_shards_of_a_few_cells_agree(monkeypatch):
    """One sorted partition cut into many shards gives the same sums once the edge nodes are recombined."""
    import pandas as pd

    rnd = random.Random(5)
    seqs = sorted((b"".join(rnd.choice([b"a", b"a", b"b"]) * 16 for _ in range(rnd.randrange(0, 6))), c) for c in range(80))
    rows = pd.DataFrame({"conv_id": [c for _, c in seqs], "ids": [s for s, _ in seqs], "words": [[2] * (len(s) // 16) for s, _ in seqs]})

    def all_nodes(cells, piece):
        monkeypatch.setattr(prefix_trie, "CELLS", cells)
        monkeypatch.setattr(prefix_trie, "PIECE", piece)
        frames = list(prefix_trie.shard_nodes(iter([rows])))
        got, p = (pd.concat([f for f in frames if f["ends"].notna().all() == whole]) for whole in (False, True))
        e = got[got["edge"].eq(True)].groupby("key", as_index=False).agg({"parent_key": "first", "conv_id": "min", "depth": "first", "n_convs": "sum", "n_children": "sum", "n_leaves": "sum",
                                                                        "saved_tokens": "sum", "words": "max"})
        e["parent_conv_id"] = None
        e = prefix_trie.recombine(e)
        ends = pd.concat(prefix_trie.hashed_ends(iter([p.sort_values(["key", "first"])])))
        e = e.merge(ends, on="key", how="left")
        e["ends_sha256"] = e["ends_sha256"].fillna(prefix_trie.NO_ENDS)
        cols = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        inner = got[got["edge"].eq(False) & got["conv_id"].notna()]
        return len(e), sorted(map(tuple, pd.concat([e[cols], inner[cols]]).astype({c: "int64" for c in cols[:-1]}).to_numpy().tolist()))

    few, want = all_nodes(10 ** 6, 10 ** 4)
    many, got = all_nodes(20, 3)
    assert got == want and many > few


def test_trie_of_no_rows_and_of_turnless_conversations(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    bare = next(c for c in range(1, 40) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(bare, 0, "user", "one", "", "", ""), (bare, 1, "user", "two", "", "", "")]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == [(bare, 0, None, 1, 0, 1, 0, hashlib.sha256(str(bare).encode()).hexdigest())]
