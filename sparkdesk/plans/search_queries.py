"""Registered queries for trigram similarity and similarity search (family B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.trigram import similarity, trigram_set, with_word_similarity
from ..operators.simsearch import search_long_texts, search_request, similarity_search
from ..session import table
from .registry import query

# DuckDB spellings of the trigram rules, for the oracles.
TL = ("flatten(list_transform(list_filter(string_split(regexp_replace(lower({t}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'),"
      " ' '), lambda w: length(w) > 0), lambda w: list_transform(range(1, length(w) + 2),"
      " lambda i: substring('  ' || w || ' ', i, 3))))")


def TS(t: str) -> str:  # noqa: N802
    return f"list_distinct({TL.format(t=t)})"


def SIM(a: str, b: str) -> str:  # noqa: N802
    """similarity of two trigram sets given as list expressions."""
    return (f"(CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b})) / "
            f"(len({a}) + len({b}) - len(list_intersect({a}, {b}))) ELSE 0.0 END)")


def WSIM(a: str, lst: str) -> str:  # noqa: N802
    """best similarity of set a against any contiguous run of list lst (every run enumerated)."""
    run = f"list_distinct({lst}[i:j])"
    return (f"coalesce(list_max(list_transform(range(1, len({lst}) + 1), lambda i: list_max(list_transform("
            f"range(i, len({lst}) + 1), lambda j: len(list_intersect({a}, {run})) / "
            f"(len({a}) + len({run}) - len(list_intersect({a}, {run}))))))), 0.0)")


# Pairs compared row by row: a part name against its type followed by the name without its
# first two characters (a mix of near and far matches).
_OTHER = "concat(p_type, ' ', substr(p_name, 3))"


@query("trigram_pairs", f"""
SELECT p_partkey, CAST(len({TS('p_name')}) AS INTEGER) AS n_trigrams,
       list_sort({TS('p_name')}) AS trigrams,
       round({SIM(TS('p_name'), TS(_OTHER))}, 6) AS similarity
FROM part
""")
def trigram_pairs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    other = F.concat(F.col("p_type"), F.lit(" "), F.substring("p_name", 3, 1 << 30))
    return p.select("p_partkey", F.size(trigram_set("p_name")).alias("n_trigrams"),
                    F.array_sort(trigram_set("p_name")).alias("trigrams"),
                    F.round(similarity(F.col("p_name"), other), 6).alias("similarity"))


# word_similarity(term, text): the noun of the name against type + name.
_TERM = "split_part(p_name, ' ', 2)"
_TEXT = "concat(p_type, ' ', p_name)"


@query("word_similarity_pairs", f"""
SELECT p_partkey, round({WSIM(TS(_TERM), TL.format(t=_TEXT))}, 6) AS word_similarity,
       round({SIM(TS(_TERM), TS(_TEXT))}, 6) AS similarity
FROM part
""")
def word_similarity_pairs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    term = F.split("p_name", " ").getItem(1)
    text = F.concat(F.col("p_type"), F.lit(" "), F.col("p_name"))
    pairs = p.select("p_partkey", term.alias("term"), text.alias("text"))
    return with_word_similarity(pairs, F.col("term"), F.col("text"), "ws").select(
        "p_partkey", F.round("ws", 6).alias("word_similarity"),
        F.round(similarity(F.col("term"), F.col("text")), 6).alias("similarity"))


def _topk_oracle(items_sql: str, ent_sql: str, cols: list, min_pct: float, k: int, word: bool,
                 fold: str = "upper") -> str:
    """Oracle for a top-k search: items(item_index, term), ent(id, name, t0..tn)."""
    f = (lambda x: f"{fold}({x})") if fold else (lambda x: x)
    ent_cols = ", ".join(f"{TS(f(f't{i}'))} AS b{i}, {TL.format(t=f(f't{i}'))} AS l{i}" for i in range(len(cols)))
    cond = " OR ".join(f"len(list_intersect(it.a, e.b{i})) > 0" for i in range(len(cols)))
    per_col = []
    for i in range(len(cols)):
        sim = SIM("a", f"b{i}")
        if word:
            per_col.append(f"greatest({sim}, {WSIM('a', f'l{i}')}) * 100.0")
        else:
            per_col.append(f"{sim} * 100.0")
    score = per_col[0] if len(per_col) == 1 else f"greatest({', '.join(per_col)})"
    return f"""
WITH items AS ({items_sql}),
it AS (SELECT item_index, replace(term, '''', '') AS term, {TS(f("replace(term, '''', '')"))} AS a
       FROM items WHERE term IS NOT NULL AND trim(replace(term, '''', '')) <> ''),
ent AS (SELECT *, {ent_cols} FROM ({ent_sql})),
pairs AS (SELECT it.item_index, it.term, it.a, e.* FROM it JOIN ent e ON {cond}),
scored AS (SELECT item_index, term, id, name, {score} AS raw_score FROM pairs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_index ORDER BY raw_score DESC, id) AS rank
           FROM scored WHERE raw_score > {min_pct})
SELECT item_index, 'item_' || CAST(item_index AS VARCHAR) AS item, term, id, coalesce(name, '') AS name,
       round(raw_score, 4) AS score, CAST(CAST(raw_score AS DECIMAL(10, 4)) AS VARCHAR) || '%' AS similarity_percent,
       CAST(rank AS INTEGER) AS rank
FROM ranked WHERE rank <= {k}
"""


# Items: every distinct part name without its first character (a typo), indexed by the
# lowest part key carrying it.
@query("simsearch_topk", _topk_oracle(
    "SELECT min(p_partkey) AS item_index, substr(p_name, 2) AS term FROM part GROUP BY substr(p_name, 2)",
    "SELECT p_partkey AS id, concat_ws(' - ', p_name, p_brand) AS name, p_name AS t0, p_brand AS t1 FROM part",
    ["p_name", "p_brand"], 30.0, 3, True))
def simsearch_topk(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    items = (part.groupBy(F.substring("p_name", 2, 1 << 30).alias("term"))
             .agg(F.min("p_partkey").alias("item_index")))
    return similarity_search(part, "p_partkey", ["p_name", "p_brand"], items, min_pct=30.0, k=3)


# No text identifier column: the record label is scored (whole-label fallback).
_LABEL_SQL = "concat_ws(' - ', s_name, CAST(s_nationkey AS VARCHAR))"


@query("simsearch_label", _topk_oracle(
    "SELECT n_nationkey AS item_index, 'Supplier#' || lpad(CAST(n_nationkey * 4 AS VARCHAR), 9, '0') AS term "
    "FROM nation",
    f"SELECT s_suppkey AS id, {_LABEL_SQL} AS name, {_LABEL_SQL} AS t0 FROM supplier",
    ["label"], 30.0, 2, True))
def simsearch_label(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    items = nation.select(F.col("n_nationkey").alias("item_index"),
                          F.concat(F.lit("Supplier#"), F.lpad((F.col("n_nationkey") * 4).cast("string"), 9, "0"))
                          .alias("term"))
    label = F.concat_ws(" - ", F.col("s_name"), F.col("s_nationkey").cast("string"))
    return similarity_search(sup, "s_suppkey", [], items, min_pct=30.0, k=2, label=label)


BENCH_MIN_PCT = 30.0  # the search default
BENCH_K = 3


@query("simsearch_benchmark_docs", _topk_oracle(
    "SELECT item_id AS item_index, text AS term FROM benchmark",
    "SELECT doc_id AS id, CAST(doc_id AS VARCHAR) AS name, text AS t0 FROM documents",
    ["text"], BENCH_MIN_PCT, BENCH_K, False, fold=""))
def simsearch_benchmark_docs(spark, sf_dir):
    """Benchmark passages searched in whole documents (similarity only): the at-scale form."""
    docs = table(spark, sf_dir, "documents")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item_index"),
                                                     F.col("text").alias("term"))
    return similarity_search(docs, "doc_id", ["text"], items, min_pct=BENCH_MIN_PCT, k=BENCH_K,
                             use_word_similarity=False, label=F.col("doc_id").cast("string"), fold_upper=False)


@query("simsearch_benchmark_docs_both")
def simsearch_benchmark_docs_both(spark, sf_dir):
    """Benchmark passages searched in whole documents by the greater of both measures (rows only: the SQL of
    every run is too slow; tested by brute force)."""
    docs = table(spark, sf_dir, "documents")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item_index"), F.col("text").alias("term"))
    return search_long_texts(docs, "doc_id", "text", items, min_pct=BENCH_MIN_PCT, k=BENCH_K)


# Entity with a tenant: customers visible to the demo context (client = segment, org = nation);
# identifier columns picked from the schema (text columns with a safe name, in the configured order).
@query("simsearch_tenant", _topk_oracle(
    "SELECT n_nationkey AS item_index, 'Customer#' || lpad(CAST(n_nationkey * 7 AS VARCHAR), 9, '0') AS term "
    "FROM nation",
    "SELECT c_custkey AS id, c_name AS name, c_name AS t0 FROM customer "
    "WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', '1-URGENT', '2-HIGH', '3-MEDIUM') "
    "AND c_nationkey IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)",
    ["c_name"], 30.0, 3, True))
def simsearch_tenant(spark, sf_dir):
    """B9 + B10: the tenant filter applies to the entity before the search; identifier columns
    come from the schema (c_acctbal is not text, the unsafe name is skipped)."""
    from ..operators.governed import tenant_filter
    from ..operators.simsearch import identifier_columns
    from .tables import DEMO_CONTEXT, TENANTS

    cust = tenant_filter(table(spark, sf_dir, "customer"), TENANTS["customer"], DEMO_CONTEXT)
    cols = identifier_columns(cust.schema, ["c_name", "c_acctbal", "c_name; drop table"])
    nation = table(spark, sf_dir, "nation")
    items = nation.select(F.col("n_nationkey").alias("item_index"),
                          F.concat(F.lit("Customer#"), F.lpad((F.col("n_nationkey") * 7).cast("string"), 9, "0"))
                          .alias("term"))
    return similarity_search(cust, "c_custkey", cols, items, min_pct=30.0, k=3)


# A request as a caller sends it: blank and missing items keep their place, quotes are stripped, 'null' is a default.
REQUEST_ITEMS = """["", "  ", "Suplier#000000007", null, "'Supplier'#00000001", "no such thing at all"]"""
_REQUEST_SQL = """SELECT * FROM (VALUES (0, ''), (1, '  '), (2, 'Suplier#000000007'), (4, '''Supplier''#00000001'),
                                        (5, 'no such thing at all')) r(item_index, term)"""


@query("simsearch_request", f"""
SELECT 'Supplier' AS entity, 'found' AS status, item, id, name, score, similarity_percent FROM ({_topk_oracle(
    _REQUEST_SQL, "SELECT s_suppkey AS id, s_name AS name, s_name AS t0 FROM supplier", ["s_name"], 30.0, 1, True)})
UNION ALL SELECT 'Nobody', 'Entity not found', NULL, NULL, NULL, NULL, NULL
""")
def simsearch_request(spark, sf_dir):
    """B8 + B14: items as JSON, parameters 'null' and '', and a request for an entity that isn't there."""
    entities = {"Supplier": (table(spark, sf_dir, "supplier"), "s_suppkey", ["S_NAME", "s_acctbal", "s name"])}
    found = search_request(entities, "Supplier", REQUEST_ITEMS, "null", "")
    other = search_request(entities, "Nobody", REQUEST_ITEMS, "5", "10", spark=spark)
    return (found.select(F.lit("Supplier").alias("entity"), F.lit("found").alias("status"), "item", "id", "name", "score", "similarity_percent")
            .unionByName(other, allowMissingColumns=True))
