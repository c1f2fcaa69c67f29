"""Merkle manifest of a dataset by slot pivots.

Rows become leaf digests; inside a group every ``fanout`` consecutive nodes become their parent until one
is left (the subroot); the subroots, in group order, become the root in the same way.

One round handles a *block* of ``levels`` tree levels: conditional aggregates spread the fanout ** levels
nodes under one ancestor into slot columns. Concatenating slot columns and hashing them gives the next
level's columns; leaving a node's own column out gives its siblings. A round therefore shuffles each node
once, and the number of nodes falls by fanout ** levels from round to round. On the way back every block hands its path
to the nodes below it by a join on (group, block). Positions come from a range-partitioned sort (see
`positions`), so a group that holds most rows is spread over many tasks; texts are hashed in the scan and
never travel.

Defined results: null values hash as ``-``; null groups are a group of their own, before all others. Leaves with the
same id order by leaf digest; equal rows are leaves of their own. A group of one leaf has that leaf as subroot. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .positions import positions

PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated strings."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def left_over(fanout: int, level: int) -> str:
    """Nodes left of n after so many levels."""
    return f"cast(ceil(n / {fanout ** level}) as long)"


def climb(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Blocks of every round, leaves first. ``nodes``: grp, pos, n, hash, item (any struct carried by the leaves).

    A block row: grp, block, n, s0..s{m-1} (struct of hash and item, null past the group's end), h{level}_{j} (the nodes of
    every level inside the block), top (the hash that is left). A group with one node left passes it on unchanged."""
    m, rounds = fanout ** levels, []
    while True:
        spread = [F.expr(f"max(if(pos % {m} = {j}, struct(hash, item), null)) as s{j}") for j in range(m)]
        rows = nodes.groupBy("grp", F.expr(f"pos div {m} as block")).agg(F.max("n").alias("n"), *spread)
        rows = rows.selectExpr("*", *[f"s{j}.hash as h0_{j}" for j in range(m)])
        for level in range(levels):
            up = []
            for j in range(m // fanout ** (level + 1)):
                run = [f"h{level}_{fanout * j + k}" for k in range(fanout)]
                joined = ", ".join(f"coalesce({h}, '')" for h in run)
                up.append(f"if({left_over(fanout, level)} > 1, if({run[0]} is null, null, sha2(cast(concat({joined}) as binary), 256)), h{level}_{j}) as h{level + 1}_{j}")
            rows = rows.selectExpr("*", *up)
        rounds.append(written(rows.withColumnRenamed(f"h{levels}_0", "top"), "manifest-block"))
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= m:
            return rounds
        nodes = rounds[-1].selectExpr("grp", "block as pos", f"{left_over(fanout, levels)} as n", "top as hash", "cast(null as int) as item")


def steps(fanout: int, levels: int, j: int) -> str:
    """The path of slot j up to its block's top: per level its siblings to the left and to the right (null where no level is left)."""
    out = []
    for level in range(levels):
        at = j // fanout ** level
        first = at - at % fanout
        left, right = (", ".join(["''"] + [f"coalesce(h{level}_{k}, '')" for k in side]) for side in (range(first, at), range(at + 1, first + fanout)))
        out.append(f"if({left_over(fanout, level)} > 1, struct(concat({left}) as before, concat({right}) as after), null)")
    return f"array({', '.join(out)})"


def descend(rounds: list[DataFrame], above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row per leaf: grp, pos, hash, item, path and the columns of ``above`` (grp, path: one row per group,
    what lies over its top), from the highest round down."""
    m = fanout ** levels
    carried = [c for c in above.columns if c not in ("grp", "path")]
    paths = above.withColumn("block", F.lit(0).cast("long"))
    slots = ", ".join(f"struct({j} as j, s{j} as node, {steps(fanout, levels, j)} as part)" for j in range(m))
    for blocks in reversed(rounds):
        rows = blocks.join(paths.withColumnRenamed("path", "upper"), ["grp", "block"])
        rows = rows.select("grp", "block", "upper", *carried, F.expr(f"explode(filter(array({slots}), s -> s.node is not null)) as s"))
        own = ["s.node.hash", "s.node.item"] if blocks is rounds[0] else []
        paths = rows.selectExpr("grp", f"block * {m} + s.j as block", f"cast(concat(filter(s.part, p -> p is not null), upper) as {PATH}) as path", *own, *carried)
    return paths.withColumnRenamed("block", "pos")


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             check: dict[str, Column] | None = None, fanout: int = 2, levels: int = 3) -> DataFrame:
    """key, leaf, checked, subroot, root, path (siblings from the leaf to the root), folded for every row.

    ``check`` gives other values for some fields: ``checked`` is the leaf of the row with these values in place and
    ``folded`` the root it leads to along the untouched siblings; equal to ``root`` only if the row is unchanged.
    """
    check = check or {}
    was = digest(*[field(F.col(c)) for c in fields])
    now = digest(*[field(check.get(c, F.col(c))) for c in fields]) if check else was
    changed = functools.reduce(operator.or_, [~v.eqNullSafe(F.col(c)) for c, v in check.items()], F.lit(False))
    # group names keep their byte order, and no group sorts before all named ones
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(name.alias("grp"), F.col(key).alias("key"), was.alias("hash"), F.when(changed, now).alias("other"))
    leaves = positions(written(rows, "manifest-leaves"), "grp", ["key", "hash"])
    leaves = leaves.select("grp", "pos", "n", "hash", F.struct("key", "other").alias("item"))
    low = climb(leaves, fanout, levels)
    subroots = low[-1].select(F.lit("").alias("grp"), F.struct("grp", "top").alias("item"), F.col("top").alias("hash"), F.col("grp").alias("name"))
    high = climb(positions(subroots, "grp", ["name"]).select("grp", "pos", "n", "hash", "item"), fanout, levels)
    root = high[-1].select("grp", F.col("top").alias("root"), F.array().cast(PATH).alias("path"))
    above = descend(high, root, fanout, levels)
    above = above.select(F.col("item.grp").alias("grp"), "path", "root", F.col("item.top").alias("subroot"))
    out = descend(low, above, fanout, levels)
    checked = F.coalesce("item.other", "hash")
    return out.select(F.col("item.key").alias(key), F.col("hash").alias("leaf"), checked.alias("checked"), "subroot", "root", "path",
                      fold(checked, F.col("path")).alias("folded"))
