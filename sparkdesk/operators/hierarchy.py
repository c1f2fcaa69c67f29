"""Interval labels of a tree (A13): inclusion by two comparisons, without the closure.

Walk round a tree: each node is entered once and left once. ``child`` lies under ``parent`` exactly when it
is entered after and left before it. The walk is a linked list of 2n steps whose order is found by pointer
doubling: each round joins every step to the step its pointer names and doubles the pointer's reach, so
about log2(2n) equi-joins on unique keys label the whole tree, however deep it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .ranking import row_numbers


class HierarchyError(ValueError):
    pass


def _walk(nodes: DataFrame) -> DataFrame:
    """The steps (step, next): ``d<node>`` enters a node and ``u<node>`` leaves it; next is null after a root."""
    # children numbered below their parent, without a window over a parent that has most nodes
    placed = stored(row_numbers(nodes, [F.col("node")], "pos", keys=("parent",)), "tree-placed")
    first = placed.where("pos = 1 and parent is not null").select(F.col("parent").alias("node"), F.col("node").alias("first"))
    sibling = placed.where("parent is not null").select("parent", (F.col("pos") - 1).alias("pos"), F.col("node").alias("sibling"))
    enter = (placed.select("node").join(first, "node", "left")
             .select(F.concat(F.lit("d"), "node").alias("step"),
                     F.coalesce(F.concat(F.lit("d"), "first"), F.concat(F.lit("u"), "node")).alias("next")))
    leave = (placed.join(sibling, ["parent", "pos"], "left")
             .select(F.concat(F.lit("u"), "node").alias("step"),
                     F.coalesce(F.concat(F.lit("d"), "sibling"), F.concat(F.lit("u"), "parent")).alias("next")))
    return enter.unionByName(leave)


def interval_labels(tree: DataFrame) -> DataFrame:
    """``tree(node, parent)`` to (node, tree, enter, leave, depth, cyclic), one row a node.

    ``tree`` is the root above the node, depth 1 is the root, enter and leave are steps of the walk (from 1).
    A parent that is no node itself counts as none, rows without a node are left out and repeated rows count
    once. Nodes on a cycle, or below one, have no root: cyclic is true and their labels are null. A node with
    two parents is an error, as it has no single interval (``rules.org_closure`` takes such graphs).
    """
    own = (tree.select(F.col("node").cast("string").alias("node"), F.col("parent").cast("string").alias("parent"))
           .where("node is not null").groupBy("node")
           .agg(F.min("parent").alias("parent"), F.max("parent").alias("other")))
    own = stored(own, "tree-nodes")
    twice = own.where("parent != other").limit(1).collect()
    if twice:
        raise HierarchyError(f"Node {twice[0]['node']} has more than one parent.")
    known = own.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    nodes = own.select("node", "parent").join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("parent"))

    down = F.col("step").startswith("d")
    # over the steps from here to where the pointer leads: their number, and entries less exits
    steps = stored(_walk(nodes).select("step", "next", F.lit(1).cast("long").alias("hops"),
                                       F.when(down, 1).otherwise(-1).cast("long").alias("climb"),
                                       F.when(F.col("next").isNull(), F.col("step")).alias("last")), "tree-steps")
    reach, total = 1, steps.count()
    while reach < total:
        ahead = steps.select(F.col("step").alias("next"), F.col("next").alias("n_next"), F.col("hops").alias("n_hops"),
                             F.col("climb").alias("n_climb"), F.col("last").alias("n_last"))
        # finished steps stay as they are; the rest meet the one step that their pointer names
        moved = (steps.where("next is not null").join(ahead.hint("merge"), "next")
                 .select("step", F.col("n_next").alias("next"), (F.col("hops") + F.col("n_hops")).alias("hops"),
                         (F.col("climb") + F.col("n_climb")).alias("climb"), F.col("n_last").alias("last")))
        steps = stored(steps.where("next is null").unionByName(moved), "tree-steps")
        reach *= 2
        if steps.where("next is not null").isEmpty():
            break
    ended = F.col("next").isNull()
    ends = steps.select(F.substring("step", 2, 1 << 30).alias("node"), down.alias("down"), ended.alias("ended"),
                        F.when(ended, F.substring("last", 2, 1 << 30)).alias("tree"), "hops", "climb")
    both = ends.groupBy("node").agg(
        F.min("tree").alias("tree"), F.max(F.when(F.col("down"), F.col("hops"))).alias("from_enter"),
        F.max(F.when(~F.col("down"), F.col("hops"))).alias("from_leave"),
        F.max(F.when(F.col("down"), 1 - F.col("climb"))).alias("depth"), F.bool_and("ended").alias("ended"))
    # hops count from a step to the end of its walk, which the root's entry sees whole
    whole = both.where("ended and node = tree").select("tree", F.col("from_enter").alias("length"))
    labels = both.join(whole, "tree", "left").select("node", "tree", *[F.when(F.col("ended"), c).alias(n) for n, c in (
        ("enter", F.col("length") - F.col("from_enter") + 1), ("leave", F.col("length") - F.col("from_leave") + 1),
        ("depth", F.col("depth")))], (~F.col("ended")).alias("cyclic"))
    return stored(labels, "tree-labels")


def included(pairs: DataFrame, labels: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """``isorgincluded(child, parent)`` for a table of pairs: level of ``child`` under ``parent`` (1 = itself),
    else -1, also for null or unknown nodes. A cyclic node is included in itself only. A column ``level`` is replaced."""
    def side(prefix: str, on: str) -> DataFrame:
        return labels.select(F.col("node").alias(f"__{prefix}"), *[F.col(c).alias(f"__{prefix}_{c}") for c in ("tree", "enter", "leave", "depth")])

    out = pairs.drop("level")
    for prefix, on in (("c", child), ("p", parent)):
        out = out.join(side(prefix, on).hint("merge"), F.col(f"`{on}`").cast("string") == F.col(f"__{prefix}"), "left")
    under = (F.col("__c_tree") == F.col("__p_tree")) & (F.col("__p_enter") <= F.col("__c_enter")) & (F.col("__c_leave") <= F.col("__p_leave"))
    level = (F.when(F.col("__c") == F.col("__p"), F.lit(1).cast("long")).when(under, F.col("__c_depth") - F.col("__p_depth") + 1)
             .otherwise(F.lit(-1).cast("long")).alias("level"))
    return out.select(*[F.col(f"`{c}`") for c in pairs.columns if c != "level"], level)
