"""Registered queries for tabular work items and task tables (family C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import workitems
from ..session import fresh_shared_path, table
from ..sources.csv_blocks import column_types, headers_of, read_quoted_csv, typed
from ..sources.export import write_header_only
from ..sources.tabular import read_text_csv, read_workbooks, sheet_range
from . import staging
from .registry import query

_CUST_JSON = ("{'c_custkey': CAST(c_custkey AS VARCHAR), 'c_name': c_name, 'c_nationkey': CAST(c_nationkey AS VARCHAR),"
              " 'c_acctbal': CAST(c_acctbal AS VARCHAR), 'c_mktsegment': c_mktsegment}")


@query("row_items", f"SELECT to_json({_CUST_JSON}) AS item FROM customer")
def row_items(spark, sf_dir):
    """C3 + C5: customer written as CSV, read back with every cell as text, one item per row."""
    df = read_quoted_csv(spark, staging.customer_csv(spark, sf_dir))
    return workitems.row_items(df)


@query("group_items", f"""
SELECT c_mktsegment, count(*) AS n_rows,
       min(c_custkey) AS first_row, to_json(list({_CUST_JSON} ORDER BY c_custkey)) AS item
FROM customer GROUP BY ALL
""")
def group_items(spark, sf_dir):
    """Rows grouped by segment, cells as text, whole rows in key order, one item per group."""
    cust = table(spark, sf_dir, "customer")
    keys = workitems.normalise_group_keys(" c_mktsegment , ")
    return workitems.group_items(cust.withColumn("row_no", F.col("c_custkey")), keys, "row_no")


# The segment of every third customer and the nation of every fifth one are missing.
_GAPS_SEGMENT = "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END"
_GAPS_NATION = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END"


@query("group_items_null_keys", f"""
WITH c AS (SELECT c_custkey, coalesce(CAST({_GAPS_NATION} AS VARCHAR), '') AS nation, coalesce({_GAPS_SEGMENT}, '') AS segment FROM customer)
SELECT segment, nation, count(*) AS n_rows, min(c_custkey) AS first_row,
       to_json(list({{'c_custkey': CAST(c_custkey AS VARCHAR), 'nation': nation, 'segment': segment}} ORDER BY c_custkey)) AS item
FROM c GROUP BY segment, nation
""")
def group_items_null_keys(spark, sf_dir):
    """Null keys form groups of their own, as the empty text, in one key and in several."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_GAPS_NATION).alias("nation"), F.expr(_GAPS_SEGMENT).alias("segment"),
                                                   F.col("c_custkey").alias("row_no"))
    return workitems.group_items(cust, workitems.normalise_group_keys(["segment", " nation "]), "row_no")


QUESTION = "Review this customer record"
AGENT = "AGENT0001"
CONVERSATION = "CONV0001"


@query("task_table", f"""
SELECT c_custkey AS item_no, '{workitems.TASK_TYPE_DEFAULT}' AS taskType, '{workitems.TASK_STATUS_DEFAULT}' AS status,
       '{QUESTION}:' || to_json({_CUST_JSON}) AS question, '{AGENT}' AS agent,
       '{CONVERSATION}' AS group_id
FROM customer
""")
def task_table(spark, sf_dir):
    """C11 + C13: one task per CSV row with default type/status and the conversation as group;
    written by the bulk sink and read back."""
    items = workitems.row_items(read_quoted_csv(spark, staging.customer_csv(spark, sf_dir))
                                .withColumn("item_no", F.col("c_custkey").cast("bigint")), ordinal="item_no")
    tasks = workitems.task_table(items, QUESTION, AGENT, task_type="", status=None, group_id="",
                                 conversation_id=CONVERSATION, ordinal="item_no")
    path = fresh_shared_path(spark, "tasks")
    workitems.write_tasks(tasks, path, "customer.csv")
    back = spark.read.parquet(path)
    return back.select("item_no", "taskType", "status", "question", "agent", "group_id")


_DIM = [("TT-001", "view"), ("TT-002", "click")]


@query("get_or_create", """
WITH dim(id, name) AS (VALUES """ + ", ".join(f"('{i}', '{n}')" for i, n in _DIM) + """),
names AS (SELECT DISTINCT event_type AS name FROM events)
SELECT n.name, coalesce(d.id, 'NEW-' || upper(md5(n.name))) AS id, d.id IS NULL AS created
FROM names n LEFT JOIN (SELECT name, min(id) AS id FROM dim GROUP BY name) d ON n.name = d.name
""")
def get_or_create(spark, sf_dir):
    """Event types looked up in a two-row type dimension; the others get new ids."""
    dim = spark.createDataFrame(_DIM, "id string, name string")
    return workitems.get_or_create(table(spark, sf_dir, "events"), dim, name_col="event_type")


@query("page_of_list", """
SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 10 OFFSET 5
""")
def page_of_list(spark, sf_dir):
    """C14: rows 5..14 of the customers named by a filter, in key order."""
    return workitems.page_of_list(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING", 5, 15, "c_custkey")


SHEET_RANGE = "A1:D400"


@query("sheet_range", f"""
WITH t AS (
  SELECT c_mktsegment AS seg, CAST(floor(c_custkey / {staging.WORKBOOK_ROWS}) AS BIGINT) AS block,
         row_number() OVER (PARTITION BY c_mktsegment, floor(c_custkey / {staging.WORKBOOK_ROWS})
                            ORDER BY c_custkey) + 1 AS row_no,
         concat_ws(', ', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
                   CAST(c_acctbal AS VARCHAR)) AS line
  FROM customer),
h AS (SELECT DISTINCT seg, block, CAST(1 AS BIGINT) AS row_no, 'c_custkey, c_name, c_nationkey, c_acctbal' AS line
      FROM t)
SELECT seg || '_' || CAST(block AS VARCHAR) || '.xlsx' AS book, seg AS sheet, row_no, line
FROM (SELECT seg, block, row_no, line FROM t UNION ALL SELECT seg, block, row_no, line FROM h)
WHERE row_no <= 400
""")
def sheet_range_q(spark, sf_dir):
    """C4 + C15: workbooks written from customer, read back sheet by sheet, range A1:D400."""
    rows = read_workbooks(spark, staging.customer_workbooks(spark, sf_dir))
    rng = sheet_range(rows, SHEET_RANGE)
    return rng.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("book"), "sheet",
                      F.col("row_no").cast("bigint").alias("row_no"), "line")


# Bytes of a block of the staged files: small, so that files of this size are read by several tasks too.
STAGED_BLOCK = 1 << 20


@query("quoted_csv", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
       coalesce(text || chr(10) || '"' || coalesce(lang, '') || '"' || chr(13) || chr(10) || doc_id, '') AS text
FROM documents
""")
def quoted_csv(spark, sf_dir):
    """Whole documents, with line ends and quotes in their cells, from CSV files cut into blocks."""
    return read_quoted_csv(spark, staging.documents_csv(spark, sf_dir), block_bytes=STAGED_BLOCK)


@query("typed_csv", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       'c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string' AS types FROM customer
""")
def typed_csv(spark, sf_dir):
    """Customer written as CSV and read back with the types that its cells allow."""
    text = read_quoted_csv(spark, staging.customer_csv(spark, sf_dir), block_bytes=STAGED_BLOCK)
    types = column_types(text)
    return typed(text, types).withColumn("types", F.lit(", ".join(f"{c} {types[c]}" for c in text.columns)))


@query("headers_table", """
SELECT seg AS file, CAST(position - 1 AS INTEGER) AS position, names[position] AS "column" FROM (
  SELECT seg, names, unnest(range(1, len(names) + 1)) AS position FROM (
    SELECT c_mktsegment AS seg, ['key of ' || c_mktsegment, 'name, quoted', 'line' || chr(10) || 'end'] AS names
    FROM customer GROUP BY c_mktsegment))
""")
def headers_table(spark, sf_dir):
    """C2 over a folder: the header cells of one CSV a segment (commas and line ends among them), in their places."""
    heads = headers_of(spark, staging.segment_csv(spark, sf_dir))
    return heads.select(F.regexp_extract("path", r"([^/]+)[.]csv$", 1).alias("file"), "position", "column")


@query("header_only", """
SELECT CAST(i - 1 AS INTEGER) AS position, ['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'][i] AS "column", CAST(0 AS BIGINT) AS n_rows
FROM range(1, 6) t(i)
""")
def header_only(spark, sf_dir):
    """A table made of the header of customer alone, read back: its columns and no row."""
    path = fresh_shared_path(spark, "header-only")
    write_header_only(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), path)
    rows = read_text_csv(spark, path).count()
    return headers_of(spark, path).select("position", "column", F.lit(rows).cast("long").alias("n_rows"))


@query("get_or_create_insert", """
WITH dim AS (SELECT 'S-' || lpad(CAST(min(c_custkey) AS VARCHAR), 9, '0') AS id, c_mktsegment AS name FROM customer GROUP BY c_mktsegment),
names AS (SELECT DISTINCT CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority WHEN o_orderkey % 4 = 1 THEN 'BUILDING'
                               WHEN o_orderkey % 4 = 2 THEN o_orderpriority || ' ' || o_orderstatus END AS name FROM orders)
SELECT id, name FROM dim
UNION ALL SELECT 'NEW-' || upper(md5(name)), name FROM names WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM dim)
""")
def get_or_create_insert(spark, sf_dir):
    """C12, both halves: names looked up in a dimension of segments, those not found inserted with the ids that they get."""
    dim = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("name")).agg(
        F.concat(F.lit("S-"), F.lpad(F.min("c_custkey").cast("string"), 9, "0")).alias("id"))
    names = table(spark, sf_dir, "orders").select(F.expr(
        "CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority WHEN o_orderkey % 4 = 1 THEN 'BUILDING' "
        "WHEN o_orderkey % 4 = 2 THEN concat(o_orderpriority, ' ', o_orderstatus) END").alias("name"))
    return workitems.with_created(dim, workitems.get_or_create(names, dim))
