"""Query rules the SQL assistant applies (A10-A14) and the current-record lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, fits, spread_small

# Document status codes and their names.
DOCSTATUS_NAMES = {"DR": "Drafted", "CO": "Completed", "CL": "Closed", "VO": "Voided", "RE": "Reversed"}

# Terms batches up to this size are broadcast to the pattern join; beyond it the join shuffles
# (AQE splits a skewed n-gram key).
TERM_BROADCAST_ROWS = 100_000


def active_only(df: DataFrame, col: str = "isactive", include_inactive: bool = False) -> DataFrame:
    """A10: keep isactive = 'Y' unless inactive rows are asked for (no-op if the column is absent)."""
    if include_inactive or col not in df.columns:
        return df
    return df.filter(F.col(col) == "Y")


def docstatus_filter(df: DataFrame, col: str = "docstatus", statuses: tuple | None = ("CO",)) -> DataFrame:
    """Default to completed documents when the table has a status column."""
    if col not in df.columns or statuses is None:
        return df
    return df.filter(F.col(col).isin(list(statuses)))


def docstatus_name(code: Column) -> Column:
    """Status code → name (unknown → null)."""
    m = F.create_map(*[F.lit(x) for kv in DOCSTATUS_NAMES.items() for x in kv])
    return m[code]


def sales_split(df: DataFrame, sales: bool | None, col: str = "issotrx") -> DataFrame:
    """A12: 'Y' = sales, 'N' = purchase; without the column the table serves both."""
    if sales is None or col not in df.columns:
        return df
    return df.filter(F.col(col) == ("Y" if sales else "N"))


def org_closure(spark: SparkSession, tree: DataFrame) -> DataFrame:
    """(ancestor, descendant, level) with level 1 for the node itself and the fewest steps otherwise.

    ``tree(node, parent)``. Level by level: the frontier is joined to its children, pairs already
    known are taken off, and what is left is written out as the next frontier. Every pair appears
    once, so cycles end the loop and no depth is cut.
    """
    edges = cut_lineage(tree.select(F.col("node").cast("string").alias("node"), F.col("parent").cast("string").alias("parent"))
                        .where("node is not null").distinct())
    known = frontier = cut_lineage(edges.select(F.col("node").alias("ancestor"), F.col("node").alias("descendant"), F.lit(1).alias("level"))
                                   .distinct())
    while True:
        step = (frontier.join(edges, frontier["descendant"] == edges["parent"])
                .select("ancestor", F.col("node").alias("descendant"), (F.col("level") + 1).alias("level")).distinct())
        frontier = cut_lineage(step.join(known.select("ancestor", "descendant"), ["ancestor", "descendant"], "left_anti"))
        if frontier.isEmpty():
            return known
        known = cut_lineage(known.unionByName(frontier))


def org_included(pairs: DataFrame, closure: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """A13 ``isorgincluded(child, parent)`` for a table of pairs: the level of ``child`` under
    ``parent`` (1 = itself), or -1 when it is not included. An equi-join on both keys."""
    c = closure.select(F.col("descendant").alias(child), F.col("ancestor").alias(parent), "level")
    return pairs.join(c, [child, parent], "left").withColumn("level", F.coalesce(F.col("level"), F.lit(-1)))


def rollup_by_org(facts: DataFrame, org_col: str, closure: DataFrame, measures: list) -> DataFrame:
    """A13 applied: every fact counts toward its org and all ancestors. Aggregated per
    (ancestor, level-independent) after an equi-join on the descendant."""
    j = facts.join(closure, facts[org_col] == closure["descendant"])
    return j.groupBy("ancestor").agg(*measures)


def _ngrams(s: Column, q: int) -> Column:
    """All substrings of length q (distinct)."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - q + 1, F.lit(1))),
                                        lambda i: F.substring(s, i, q)))


def _pattern_key(p: Column) -> Column:
    return F.substring(p, 1, 3)


def relaxed_search(entity: DataFrame, id_col: str, name_col: str, terms: DataFrame) -> DataFrame:
    """ILIKE '%term%'; for a term with no hit, ILIKE ANY over its words. One pass.

    ``terms(term_id, term)``. Returns (term_id, term, <id_col>, <name_col>, stage).
    Candidates come from an equi-join on a 1..3-character key of each pattern against every
    substring of that length in the name (exact: a contained pattern contains its key), then
    the containment test confirms. Which stage applies is decided per term from an aggregate,
    never from a window over a possibly hot term.
    """
    t = terms.select("term_id", "term").filter(F.col("term").isNotNull())
    full = t.select("term_id", "term", F.lit(1).alias("stage"), F.lower(F.trim("term")).alias("pattern"))
    words = (t.select("term_id", "term", F.lit(2).alias("stage"),
                      F.explode(F.split(F.lower(F.trim("term")), r"\s+")).alias("pattern")))
    pats = full.unionByName(words).filter(F.length("pattern") > 0).dropDuplicates(["term_id", "stage", "pattern"])
    pats = pats.withColumn("q", F.least(F.length("pattern"), F.lit(3))).withColumn("key", _pattern_key("pattern"))

    low = F.lower(F.col(name_col))
    ent = spread_small(entity.select(F.col(id_col), F.col(name_col)))
    small = fits(pats, TERM_BROADCAST_ROWS)
    # key lengths the batch actually uses (at most three values): names emit only those n-grams
    if small:
        lengths = sorted(r["q"] for r in pats.select("q").distinct().collect())
    else:
        lengths = [1, 2, 3]
    if not lengths:
        lengths = [3]
    grams = ent.select(id_col, name_col, F.explode(F.array_distinct(F.flatten(F.array(
        *[_ngrams(low, q) for q in lengths])))).alias("key"))
    pj = F.broadcast(pats) if small else pats
    hits = (grams.join(pj, "key")
            .filter(F.instr(F.lower(F.col(name_col)), F.col("pattern")) > 0)
            .select("term_id", "term", "stage", id_col, name_col))
    # one row per (term, record, stage): several words of a term may hit the same record
    hits = hits.dropDuplicates(["term_id", "stage", id_col])
    stage1 = hits.filter(F.col("stage") == 1).groupBy("term_id").agg(F.lit(True).alias("has_exact"))
    out = hits.join(F.broadcast(stage1) if small else stage1, "term_id", "left")
    return (out.filter(F.when(F.col("has_exact"), F.col("stage") == 1).otherwise(F.col("stage") == 2))
            .select("term_id", "term", id_col, name_col, "stage"))


def current_record(df: DataFrame, keys: list, order_cols: list, as_of: Column | None = None,
                   ts_col: str | None = None) -> DataFrame:
    """A24 re-aimed: the latest record per key (by ``order_cols``) among rows valid at ``as_of``.

    A partial aggregate (max of a struct), so a hot key is combined map-side before the shuffle.
    """
    if as_of is not None and ts_col is not None:
        df = df.filter(F.col(ts_col) <= as_of)
    others = [c for c in df.columns if c not in keys]
    ordered = order_cols + [c for c in others if c not in order_cols]
    latest = F.max(F.struct(*[F.col(c) for c in ordered])).alias("__latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in ordered])


def valid_record(df: DataFrame, until_col: str, now: Column, provider_col: str, pattern: str, order: list) -> DataFrame:
    """One row that is valid until ``now`` or later and whose provider is like ``pattern``, case ignored
    (the first by ``order``; no row if there is none). A per-partition top 1, merged."""
    valid = df.filter((F.col(until_col) >= now) & F.col(provider_col).ilike(pattern))
    return valid.orderBy(*order).limit(1)


def top_per_key(df: DataFrame, keys: list, order: list, k: int) -> DataFrame:
    """row_number() <= k per key; Spark adds a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
