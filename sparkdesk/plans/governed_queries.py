"""Registered queries for governed SQL, catalog, rules and audit (family A)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import catalog, hierarchy, rules
from ..operators.audit import audit_queries
from ..operators.governed import AccessContext, TenantColumns, run_select, tenant_filter, text_result
from ..operators.ranking import row_numbers
from ..session import fresh_shared_path, table
from ..sources.export import export_csv
from .registry import query
from .tables import DEMO_CLIENTS_SQL as CL
from .tables import DEMO_CONTEXT, TABLES, demo_session
from .tables import DEMO_ORGS_SQL as ORG

# The tenant views of the demo context written out for the oracle.
O_VIEW = f"(SELECT * FROM orders WHERE o_orderpriority IN {CL} AND o_custkey % 25 IN {ORG})"
C_VIEW = f"(SELECT * FROM customer WHERE c_mktsegment IN {CL} AND c_nationkey IN {ORG})"
S_VIEW = f"(SELECT * FROM supplier WHERE s_nationkey IN {ORG})"

GOVERNED_JOIN_SQL = """
SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice > 100000
"""

GOVERNED_JOIN_ORACLE = f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS o_orderkey, CAST(o.o_orderdate AS VARCHAR) AS o_orderdate,
       CAST(o.o_totalprice AS VARCHAR) AS o_totalprice, c.c_name, c.c_mktsegment
FROM {O_VIEW} o JOIN {C_VIEW} c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice > 100000
"""


def governed_join_df(spark, sf_dir):
    s = demo_session(spark, sf_dir)
    return text_result(run_select(s, GOVERNED_JOIN_SQL, DEMO_CONTEXT))


query("governed_join", GOVERNED_JOIN_ORACLE)(governed_join_df)


@query("governed_derived_rownum", f"""
SELECT z.o_orderkey, z.o_totalprice, z.rn FROM (
  SELECT o.o_orderkey, o.o_totalprice,
         CAST(ROW_NUMBER() OVER (ORDER BY o.o_totalprice DESC, o.o_orderkey) AS BIGINT) AS rn
  FROM {O_VIEW} o) z
WHERE z.rn <= 10 ORDER BY z.rn
""")
def governed_derived_rownum(spark, sf_dir):
    s = demo_session(spark, sf_dir)
    return run_select(s, """
SELECT z.o_orderkey, z.o_totalprice, z.rn FROM (
  SELECT o.o_orderkey, o.o_totalprice,
         CAST(ROW_NUMBER() OVER (ORDER BY o.o_totalprice DESC, o.o_orderkey) AS BIGINT) AS rn
  FROM orders o) z
WHERE z.rn <= 10 ORDER BY z.rn""", DEMO_CONTEXT)


@query("governed_outer_join", f"""
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM {C_VIEW} c LEFT JOIN {O_VIEW} o ON o.o_custkey = c.c_custkey
""")
def governed_outer_join(spark, sf_dir):
    s = demo_session(spark, sf_dir)
    return run_select(s, """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey""", DEMO_CONTEXT)


@query("governed_subquery", f"""
WITH big AS (SELECT o.o_custkey AS k FROM {O_VIEW} o WHERE o.o_totalprice > 300000)
SELECT c.c_custkey AS id, c.c_name AS name FROM {C_VIEW} c WHERE c.c_custkey IN (SELECT b.k FROM big b)
UNION
SELECT s.s_suppkey, s.s_name FROM {S_VIEW} s WHERE s.s_acctbal > 9000
""")
def governed_subquery(spark, sf_dir):
    s = demo_session(spark, sf_dir)
    return run_select(s, """
WITH big AS (SELECT o.o_custkey AS k FROM orders o WHERE o.o_totalprice > 300000)
SELECT c.c_custkey AS id, c.c_name AS name FROM customer c WHERE c.c_custkey IN (SELECT b.k FROM big b)
UNION
SELECT s.s_suppkey, s.s_name FROM supplier s WHERE s.s_acctbal > 9000""", DEMO_CONTEXT)


# A client list long enough to take the broadcast semi-join path.
SEMI_CLIENTS = ("BUILDING", "FURNITURE") + tuple(f"SEG_{i:05d}" for i in range(1500))


@query("tenant_filter_semi", """
SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer
WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND c_nationkey BETWEEN 5 AND 19
""")
def tenant_filter_semi(spark, sf_dir):
    ctx = AccessContext(clients=SEMI_CLIENTS, orgs=tuple(range(5, 20)), tables=frozenset({"customer"}))
    df = tenant_filter(table(spark, sf_dir, "customer"), TenantColumns("c_mktsegment", "c_nationkey"), ctx)
    return df.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


@query("text_result", f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS c_custkey, c.c_name AS name, n.n_name AS name_2,
       CAST(c.c_acctbal AS VARCHAR) AS c_acctbal
FROM {C_VIEW} c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def text_result_q(spark, sf_dir):
    s = demo_session(spark, sf_dir)
    df = run_select(s, """
SELECT c.c_custkey, c.c_name AS name, n.n_name AS name, c.c_acctbal
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""", DEMO_CONTEXT)
    return text_result(df)


@query("select_count_distinct", f"""
SELECT c.c_mktsegment, COUNT(*) AS n, COUNT(DISTINCT c.c_nationkey) AS n_nations
FROM {C_VIEW} c WHERE c.c_acctbal > 0
GROUP BY c.c_mktsegment ORDER BY n DESC, c.c_mktsegment LIMIT 2
""")
def select_count_distinct(spark, sf_dir):
    s = demo_session(spark, sf_dir)
    return run_select(s, """
SELECT c.c_mktsegment, COUNT(*) AS n, COUNT(DISTINCT c.c_nationkey) AS n_nations
FROM customer c WHERE c.c_acctbal > 0
GROUP BY c.c_mktsegment ORDER BY n DESC, c.c_mktsegment LIMIT 2""", DEMO_CONTEXT)


@query("csv_export", GOVERNED_JOIN_ORACLE)
def csv_export(spark, sf_dir):
    """The governed result written as CSV by the executors, then read back as text."""
    df = governed_join_df(spark, sf_dir)
    path = fresh_shared_path(spark, "export")
    res = export_csv(df, path, include_headers=True)
    schema = StructType([StructField(c, StringType()) for c in df.columns])
    back = (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).csv(res.path))
    return back


# --- catalog ---------------------------------------------------------------------------

READABLE = sorted(DEMO_CONTEXT.tables)
DERIVED_READABLE = ["lineitem", "nation"]


def _dictionaries(spark, sf_dir, described=None):
    schemas = {t: table(spark, sf_dir, t).schema for t in TABLES}
    return catalog.dictionary_from_schemas(spark, schemas, described)


def _ids(spark, tables, names):
    return tables.filter(F.col("db_name").isin(names)).select("table_id")


_CAT_NAMES = sorted(set(READABLE) | set(DERIVED_READABLE))


@query("catalog_tables", "SELECT name AS TABLENAME, upper(substr(name, 1, 1)) || substr(name, 2) AS NAME, "
       "'Table ' || name AS DESCRIPTION FROM (VALUES " + ", ".join(f"('{n}')" for n in _CAT_NAMES) + ") t(name)")
def catalog_tables(spark, sf_dir):
    tables, _ = _dictionaries(spark, sf_dir)
    ids = catalog.accessible_table_ids(_ids(spark, tables, READABLE), _ids(spark, tables, DERIVED_READABLE))
    return catalog.list_tables(tables, ids)


# orders columns that have a dictionary entry; o_orderpriority exists only physically.
_DESCRIBED_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_ORDERS_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                 "o_totalprice": "double", "o_orderdate": "timestamp_ntz"}


@query("catalog_columns", """
SELECT p.column_name AS COLUMNNAME, d.name AS NAME, d.dbtype AS DBTYPE, d.description AS DESCRIPTION
FROM (SELECT column_name FROM information_schema.columns WHERE table_name = 'orders') p
LEFT JOIN (VALUES """ + ", ".join(
    f"('{c}', '{c.replace('_', ' ').title()}', '{_ORDERS_TYPES[c]}', 'Column {c} of orders')"
    for c in _DESCRIBED_ORDERS) + """) d(db_column, name, dbtype, description)
ON lower(p.column_name) = lower(d.db_column)
""")
def catalog_columns(spark, sf_dir):
    tables, columns = _dictionaries(spark, sf_dir, {t: None for t in TABLES} | {"orders": set(_DESCRIBED_ORDERS)})
    physical = {t: table(spark, sf_dir, t).schema for t in ("orders",)}
    return catalog.list_columns(spark, tables, columns, "ORDERS", physical_by_table=physical)


# --- audit -----------------------------------------------------------------------------

# Statement openings put in front of conversation texts to make a query log.
AUDIT_PREFIXES = ["SELECT", "  select", "SELECT created,", "DELETE FROM", "DROP TABLE", "WITH x AS",
                  "EXPLAIN SELECT", "select sp_help"]
_PREFIX_SQL = "[" + ", ".join(f"'{p}'" for p in AUDIT_PREFIXES) + "]"


def _kw_case(low: str, word: bool) -> str:
    from ..functions.text import GUARD_KEYWORDS
    parts = []
    for kw in GUARD_KEYWORDS:
        if word:
            end = "" if kw.endswith("_") else "($|[^a-z0-9_])"
            parts.append(f"WHEN regexp_matches({low}, '(^|[^a-z0-9_]){kw}{end}') THEN '{kw}'")
        else:
            parts.append(f"WHEN instr({low}, '{kw}') > 0 THEN '{kw}'")
    return "CASE " + " ".join(parts) + " END"


_LOW = "lower(regexp_replace(q, '^\\s+|\\s+$', '', 'g'))"


@query("query_audit", f"""
WITH log AS (
  SELECT conv_id, turn, {_PREFIX_SQL}[CAST((conv_id + turn) % {len(AUDIT_PREFIXES)} AS INTEGER) + 1] || ' ' || text AS q
  FROM conversations)
SELECT conv_id, turn,
       regexp_extract({_LOW}, '^([a-z]+)', 1) AS kind,
       {_kw_case(_LOW, False)} AS keyword,
       ({_kw_case(_LOW, False)}) IS NULL AND starts_with({_LOW}, 'select') AS allowed,
       {_kw_case(_LOW, True)} AS word_keyword,
       ({_kw_case(_LOW, True)}) IS NULL AND starts_with({_LOW}, 'select') AS allowed_whole_word
FROM log
""")
def query_audit(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    prefixes = F.array(*[F.lit(p) for p in AUDIT_PREFIXES])
    log = conv.select("conv_id", "turn", F.concat(
        F.element_at(prefixes, ((F.col("conv_id") + F.col("turn")) % len(AUDIT_PREFIXES) + 1).cast("int")),
        F.lit(" "), F.col("text")).alias("q"))
    return audit_queries(log, "q").drop("q")


# --- rules -----------------------------------------------------------------------------

_DOCSTATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'CO' WHEN 'O' THEN 'DR' WHEN 'P' THEN 'CL' END"


@query("active_docstatus", f"""
SELECT o_orderkey, o_custkey, docstatus,
       CASE docstatus WHEN 'DR' THEN 'Drafted' WHEN 'CO' THEN 'Completed' WHEN 'CL' THEN 'Closed'
                      WHEN 'VO' THEN 'Voided' WHEN 'RE' THEN 'Reversed' END AS docstatus_name,
       o_totalprice
FROM (SELECT *, {_DOCSTATUS_SQL} AS docstatus FROM orders) WHERE docstatus = 'CO'
""")
def active_docstatus(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("docstatus", F.expr(_DOCSTATUS_SQL))
    o = rules.active_only(o)               # no isactive column: every row counts
    o = rules.sales_split(o, sales=True)   # no issotrx column: both sales and purchases
    o = rules.docstatus_filter(o)          # default: completed only
    return o.select("o_orderkey", "o_custkey", "docstatus", rules.docstatus_name(F.col("docstatus"))
                    .alias("docstatus_name"), "o_totalprice")


@query("org_rollup", """
WITH RECURSIVE tree(node, parent) AS (
  SELECT '0', NULL
  UNION ALL SELECT 'R' || CAST(r_regionkey AS VARCHAR), '0' FROM region
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR) FROM nation),
cl(ancestor, descendant, level) AS (
  SELECT node, node, 1 FROM tree
  UNION ALL
  SELECT cl.ancestor, t.node, cl.level + 1 FROM cl JOIN tree t ON t.parent = cl.descendant WHERE cl.level < 32)
SELECT cl.ancestor AS org, COUNT(*) AS n_customers, ROUND(SUM(c.c_acctbal), 2) AS total_acctbal,
       MAX(cl.level) AS max_level
FROM customer c JOIN cl ON 'N' || CAST(c.c_nationkey AS VARCHAR) = cl.descendant
GROUP BY cl.ancestor
""")
def org_rollup(spark, sf_dir):
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    root = spark.range(1).select(F.lit("0").alias("node"), F.lit(None).cast("string").alias("parent"))
    tree = (root
            .unionByName(region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("node"),
                                       F.lit("0").alias("parent")))
            .unionByName(nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("node"),
                                       F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"))))
    closure = rules.org_closure(spark, tree)
    cust = table(spark, sf_dir, "customer").withColumn(
        "org", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
    out = rules.rollup_by_org(cust, "org", closure, [
        F.count(F.lit(1)).alias("n_customers"), F.round(F.sum("c_acctbal"), 2).alias("total_acctbal"),
        F.max("level").alias("max_level")])
    return out.withColumnRenamed("ancestor", "org")


_REVERSED = r"regexp_replace(p_name, '^(\S+) (\S+)$', '\2 \1')"


@query("relaxed_search", f"""
WITH terms AS (SELECT DISTINCT p_name AS term FROM part UNION SELECT DISTINCT {_REVERSED} FROM part),
s1 AS (SELECT t.term, p.p_partkey, p.p_name FROM terms t JOIN part p
       ON contains(lower(p.p_name), lower(trim(t.term)))),
words AS (SELECT DISTINCT term, unnest(string_split_regex(lower(trim(term)), '\\s+')) AS w FROM terms),
s2 AS (SELECT DISTINCT w.term, p.p_partkey, p.p_name FROM words w JOIN part p
       ON contains(lower(p.p_name), w.w) WHERE length(w.w) > 0)
SELECT term AS term_id, term, p_partkey, p_name, 1 AS stage FROM s1
UNION ALL
SELECT term, term, p_partkey, p_name, 2 FROM s2 WHERE term NOT IN (SELECT term FROM s1)
""")
def relaxed_search(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select(F.col("p_name").alias("term"))
    rev = part.select(F.regexp_replace("p_name", r"^(\S+) (\S+)$", "$2 $1").alias("term"))
    terms = names.union(rev).distinct().select(F.col("term").alias("term_id"), "term")
    return rules.relaxed_search(part, "p_partkey", "p_name", terms)


AS_OF = "2024-01-20 00:00:00"


@query("current_record", f"""
SELECT user_id, event_type, ts, event_id, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '{AS_OF}') WHERE rn = 1
""")
def current_record(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return rules.current_record(ev, ["user_id", "event_type"], ["ts", "event_id"],
                                as_of=F.expr(f"TIMESTAMP_NTZ '{AS_OF}'"), ts_col="ts")


@query("valid_record", f"""
SELECT event_id, user_id, event_type, ts FROM events
WHERE ts >= TIMESTAMP '{AS_OF}' AND event_type ILIKE '%CLICK%' ORDER BY ts, event_id LIMIT 1
""")
def valid_record(spark, sf_dir):
    """The one record that is still valid and whose provider matches."""
    ev = table(spark, sf_dir, "events")
    one = rules.valid_record(ev, "ts", F.expr(f"TIMESTAMP_NTZ '{AS_OF}'"), "event_type", "%CLICK%", ["ts", "event_id"])
    return one.select("event_id", "user_id", "event_type", "ts")


_FLAGS_SQL = ("CASE c_custkey % 5 WHEN 0 THEN 'N' WHEN 1 THEN NULL ELSE 'Y' END AS isactive, "
              "CASE c_custkey % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' END AS issotrx")


@query("active_sales", f"""
SELECT c_custkey, isactive, issotrx FROM (SELECT *, {_FLAGS_SQL} FROM customer)
WHERE isactive = 'Y' AND issotrx = 'Y'
""")
def active_sales(spark, sf_dir):
    """A10 and A12 on a table that has both columns, with nulls in them."""
    cust = table(spark, sf_dir, "customer").selectExpr("*", *_FLAGS_SQL.split(", ", 1))
    return rules.sales_split(rules.active_only(cust), sales=True).select("c_custkey", "isactive", "issotrx")


# --- rows numbered over the whole result, inclusion in a tree ---------------------------------


@query("governed_rownum_all", f"""
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, row_number() OVER (ORDER BY o.o_totalprice DESC NULLS LAST, o.o_orderkey) AS rn
FROM {O_VIEW} o
""")
def governed_rownum_all(spark, sf_dir):
    """A19 without an outer limit: every row of a governed result numbered, with no window in one task."""
    df = run_select(demo_session(spark, sf_dir), "SELECT o.o_orderkey, o.o_custkey, o.o_totalprice FROM orders o", DEMO_CONTEXT)
    return row_numbers(df, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")])


@query("governed_rownum_groups", f"""
SELECT o.o_orderstatus, o.o_orderkey, row_number() OVER (PARTITION BY o.o_orderstatus ORDER BY o.o_orderdate, o.o_orderkey) AS rn
FROM {O_VIEW} o
""")
def governed_rownum_groups(spark, sf_dir):
    """A19 with three keys over all rows: a key's rows spread over many partitions."""
    df = run_select(demo_session(spark, sf_dir), "SELECT o.o_orderstatus, o.o_orderkey, o.o_orderdate FROM orders o", DEMO_CONTEXT)
    return row_numbers(df, [F.col("o_orderdate"), F.col("o_orderkey")], keys=("o_orderstatus",)).select("o_orderstatus", "o_orderkey", "rn")


# Organisations: all, regions, nations, customers. Every order asks whether its customer, or the customer's
# nation, lies under some nation, region, customer or the whole.
_ORG_TREE = """
tree(node, parent) AS (
  SELECT '0', NULL
  UNION ALL SELECT 'R' || CAST(r_regionkey AS VARCHAR), '0' FROM region
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR) FROM customer)"""
_PAIR_PARENT = ("CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN concat('R', CAST(o_orderkey % 7 AS {text})) "
                "WHEN 2 THEN concat('N', CAST(o_orderkey % 25 AS {text})) WHEN 3 THEN concat('C', CAST(o_custkey AS {text})) END")


@query("org_included", f"""
WITH RECURSIVE {_ORG_TREE.strip()},
up(node, ancestor, level) AS (
  SELECT node, node, 1 FROM tree UNION ALL
  SELECT up.node, t.parent, up.level + 1 FROM up JOIN tree t ON up.ancestor = t.node WHERE t.parent IS NOT NULL),
pairs AS (SELECT o_orderkey, 'C' || CAST(o_custkey AS VARCHAR) AS child, {_PAIR_PARENT.format(text="VARCHAR")} AS parent FROM orders)
SELECT p.o_orderkey, p.child, p.parent, CAST(coalesce(up.level, -1) AS BIGINT) AS level
FROM pairs p LEFT JOIN up ON p.child = up.node AND p.parent = up.ancestor
""")
def org_included(spark, sf_dir):
    """A13 ``isorgincluded`` for a pair of every order, by interval labels (unknown and null nodes among the pairs)."""
    text = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    tree = (spark.range(1).select(F.lit("0").alias("node"), F.lit(None).cast("string").alias("parent"))
            .unionByName(region.select(text("R", "r_regionkey").alias("node"), F.lit("0").alias("parent")))
            .unionByName(nation.select(text("N", "n_nationkey").alias("node"), text("R", "n_regionkey").alias("parent")))
            .unionByName(customer.select(text("C", "c_custkey").alias("node"), text("N", "c_nationkey").alias("parent"))))
    pairs = table(spark, sf_dir, "orders").select("o_orderkey", text("C", "o_custkey").alias("child"),
                                                  F.expr(_PAIR_PARENT.format(text="STRING")).alias("parent"))
    return hierarchy.included(pairs, hierarchy.interval_labels(tree))
