"""Registered queries for file-set jobs and message assembly (family E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import safe_name as safe_name_col
from ..functions.text import url_file_name as url_file_name_col
from ..operators import files as fileops
from ..operators import messages
from ..operators.messages import assemble_messages
from ..session import fresh_shared_path, table
from ..sources import files as filesrc
from ..sources.export import write_table
from . import staging
from .registry import query

_KIND = "doc_id % 6"  # how the staged folder names each document's file (see staging.document_files)


@query("file_manifest", f"""
SELECT source || '/doc_' || CAST(doc_id AS VARCHAR) || ext AS rel_path, 'doc_' || CAST(doc_id AS VARCHAR) || ext AS name,
       CAST(octet_length(encode(text)) + extra AS BIGINT) AS length
FROM (SELECT *, CASE {_KIND} WHEN 0 THEN '.txt' ELSE '.pdf' END AS ext,
             CASE {_KIND} WHEN 0 THEN 0 ELSE 9 END AS extra
      FROM documents WHERE {_KIND} IN (0, 4))
""")
def file_manifest(spark, sf_dir):
    """Recursive listing of the staged folder, .txt and .pdf only, hidden files and the
    'skipme' folders left out."""
    root = staging.document_files(spark, sf_dir)
    m = filesrc.directory_manifest(spark, root, recursive=True, extensions=" .TXT, .pdf", ignore=["skipme"])
    return m.select("rel_path", "name", "length")


@query("archive_expand", f"""
WITH d AS (SELECT doc_id, source, encode(text) AS b FROM documents)
SELECT source || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt.gz' AS archive, 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS member,
       CAST(octet_length(b) AS BIGINT) AS size, md5(b) AS md5 FROM d WHERE {_KIND} = 1
UNION ALL
SELECT source || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt.bz2', 'doc_' || CAST(doc_id AS VARCHAR) || '.txt',
       CAST(octet_length(b) AS BIGINT), md5(b) FROM d WHERE {_KIND} = 2
UNION ALL
SELECT source || '/archive_' || CAST(doc_id // {staging.ZIP_DOCS} AS VARCHAR) || '.zip',
       'docs/doc_' || CAST(doc_id AS VARCHAR) || '.txt', CAST(octet_length(b) AS BIGINT), md5(b) FROM d
""")
def archive_expand(spark, sf_dir):
    """Every zip / gz / bz2 of the staged folder expanded to its members."""
    root = staging.document_files(spark, sf_dir)
    members = filesrc.read_archives(spark, root)
    rel = F.regexp_replace("archive", r"^.*/files/", "")
    return members.select(rel.alias("archive"), "member", F.length("content").cast("bigint").alias("size"),
                          F.md5("content").alias("md5"))


@query("type_routing", f"""
WITH f AS (
  SELECT CASE {_KIND} WHEN 1 THEN 'application/gzip' WHEN 2 THEN 'application/x-bzip2' WHEN 3 THEN 'image/png'
                      WHEN 4 THEN 'application/pdf' WHEN 5 THEN 'image/jpeg' END AS mime FROM documents
  UNION ALL SELECT NULL FROM documents WHERE doc_id % {staging.ZIP_DOCS} = 0
  UNION ALL SELECT DISTINCT 'application/zip|' || source || '|' || CAST(doc_id // {staging.ZIP_DOCS} AS VARCHAR)
            FROM documents)
SELECT mime, count(*) AS n_files,
       count(*) FILTER (WHERE mime IN ('image/jpeg', 'image/png', 'image/webp', 'image/gif', 'application/pdf'))
         AS n_accepted
FROM (SELECT CASE WHEN starts_with(mime, 'application/zip|') THEN 'application/zip' ELSE mime END AS mime FROM f)
GROUP BY mime
""")
def type_routing(spark, sf_dir):
    """Every staged file's type from its first bytes, the only ones read; accepted / total per type."""
    root = staging.document_files(spark, sf_dir)
    allfiles = filesrc.directory_manifest(spark, root, recursive=True, ignore=["_DONE"], with_content=True, head=fileops.SNIFF_BYTES)
    return fileops.routing_summary(fileops.route_by_type(allfiles))


@query("preview")
def preview(spark, sf_dir):
    """Preview of the staged CSV parts, workbooks and zip archives (rows only:
    the CSV part files are named by Spark)."""
    paths = [staging.customer_csv(spark, sf_dir), staging.customer_workbooks(spark, sf_dir),
             staging.document_files(spark, sf_dir)]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.{csv,xlsx,zip}").load(paths))
    return filesrc.preview(files)


@query("dispatch_items")
def dispatch_items(spark, sf_dir):
    """Items by extension over the staged CSV parts, workbooks and zip archives (rows only)."""
    paths = [staging.customer_csv(spark, sf_dir), staging.customer_workbooks(spark, sf_dir),
             staging.document_files(spark, sf_dir)]
    return filesrc.read_items(spark, paths, (".csv", ".xlsx", ".zip"))


@query("base64_roundtrip", """
SELECT doc_id, CAST(length(to_base64(encode(text))) AS BIGINT) AS b64_len, md5(to_base64(encode(text))) AS b64_md5,
       decode(from_base64(to_base64(encode(text)))) = text AS roundtrip_ok,
       TRY(from_base64(to_base64(encode(text)) || '!!')) IS NULL AS invalid_is_null
FROM documents
""")
def base64_roundtrip(spark, sf_dir):
    """E5: every document to base64 and back; a corrupted copy decodes to null, not an error."""
    d = table(spark, sf_dir, "documents")
    b64 = fileops.to_base64(F.encode("text", "UTF-8"))
    return d.select("doc_id", F.length(b64).cast("bigint").alias("b64_len"), F.md5(b64).alias("b64_md5"),
                    (fileops.from_base64(b64).cast("string") == F.col("text")).alias("roundtrip_ok"),
                    fileops.from_base64(F.concat(b64, F.lit("!!"))).isNull().alias("invalid_is_null"))


_PATH_SQL = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_IS_TEXT_SQL = "contains(lower(html), '<html')"


@query("url_file_name", f"""
WITH p AS (SELECT page_id, url, {_IS_TEXT_SQL} AS is_text,
                  regexp_extract({_PATH_SQL}, '([^/]*)$', 1) AS base FROM pages),
n AS (SELECT *, CASE WHEN base = '' THEN 'downloaded_file' ELSE base END AS name0 FROM p)
SELECT page_id, CASE WHEN is_text AND NOT regexp_matches(name0, '^\\.*[^.].*\\.[^.]*$') THEN name0 || '.txt'
                     ELSE name0 END AS file_name
FROM n
""")
def url_file_name(spark, sf_dir):
    """The download name of every page URL (pages are text, so names without an extension
    get .txt)."""
    p = table(spark, sf_dir, "pages")
    is_text = F.lower("html").contains("<html")
    return p.select("page_id", url_file_name_col("url", is_text).alias("file_name"))


@query("safe_name", """
SELECT page_id, regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '[^\\p{L}\\p{N}_-]', '_', 'g')
       AS safe_name
FROM pages
""")
def safe_name(spark, sf_dir):
    """Each page title made safe as a file name."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", safe_name_col(F.regexp_extract("html", r"<title>(.*?)</title>", 1)).alias("safe_name"))


# Which locations exist, read off each page: secure pages are deployed under /app, blog pages
# one folder up, pages with a query string at the bare path.
_EXISTS_SQL = f"""
SELECT '/app' || {_PATH_SQL} AS path FROM pages WHERE starts_with(url, 'https')
UNION SELECT '..' || {_PATH_SQL} FROM pages WHERE contains(url, '://blog.')
UNION SELECT {_PATH_SQL} FROM pages WHERE contains(url, '?')"""


@query("first_location", f"""
WITH m AS ({_EXISTS_SQL}),
r AS (SELECT DISTINCT {_PATH_SQL} AS request FROM pages),
c AS (SELECT request, unnest([0, 1, 2]) AS rank, unnest(['/app' || request, '..' || request, request]) AS candidate
      FROM r),
h AS (SELECT request, min(rank) AS rank FROM c JOIN m ON c.candidate = m.path GROUP BY request)
SELECT r.request, CASE h.rank WHEN 0 THEN '/app' || r.request WHEN 1 THEN '..' || r.request
                              WHEN 2 THEN r.request END AS found, CAST(h.rank AS INTEGER) AS rank
FROM r LEFT JOIN h ON r.request = h.request
""")
def first_location(spark, sf_dir):
    """For every page path, the first of /app+p, ..+p, p that exists."""
    p = table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    manifest = (p.filter(F.col("url").startswith("https")).select(F.concat(F.lit("/app"), path).alias("path"))
                .union(p.filter(F.col("url").contains("://blog.")).select(F.concat(F.lit(".."), path).alias("path")))
                .union(p.filter(F.col("url").contains("?")).select(path.alias("path"))))
    return fileops.first_existing(p.select(path.alias("request")), manifest)


@query("list_by_type", f"""
SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS name, source || '/doc_' || CAST(doc_id AS VARCHAR) || '.pdf'
       AS rel_path, 'application/pdf' AS mime
FROM documents WHERE {_KIND} = 4 ORDER BY name LIMIT 100
""")
def list_by_type(spark, sf_dir):
    """The first 100 PDF files of the staged folder, by name (type from the first bytes)."""
    root = staging.document_files(spark, sf_dir)
    m = filesrc.directory_manifest(spark, root, recursive=True, with_content=True, head=fileops.SNIFF_BYTES)
    typed = m.select("name", "rel_path", "path", fileops.sniff_mime("content").alias("mime"))
    return fileops.list_by_type(typed, "PDF").select("name", "rel_path", "mime")


NOW = "2024-01-30 12:00:00"


@query("idle_sweep", f"""
SELECT user_id, max(ts) AS last_ts, max(ts) IS NULL OR max(ts) < TIMESTAMP '{NOW}' - INTERVAL 1 HOUR AS expired
FROM events GROUP BY user_id
""")
def idle_sweep(spark, sf_dir):
    """Users idle for more than an hour at a given instant."""
    return fileops.idle_records(table(spark, sf_dir, "events"), "user_id", "ts", F.expr(f"TIMESTAMP_NTZ '{NOW}'"))


@query("message_assembly", """
SELECT conv_id, count(*) AS n_messages,
       to_json(list({'role': role, 'content': text} ORDER BY role <> 'system', turn)) AS messages
FROM conversations GROUP BY ALL
""")
def message_assembly(spark, sf_dir):
    """Each conversation's messages, system first, then in turn order."""
    return assemble_messages(table(spark, sf_dir, "conversations"))


PAGE_SYSTEM, PAGE_EXTRA = "Read the pages and answer.", "Answer briefly."
REFERENCE_INTRO, REFERENCE_REPLY = "This is a reference; use it as a template only.", "Understood. Send the real pages."


@query("page_messages", f"""
WITH q AS (SELECT conv_id, text AS question FROM conversations WHERE turn = 0),
p AS (SELECT conv_id, list({{'role': 'user', 'content': text}} ORDER BY turn) AS ps FROM conversations WHERE turn > 0 GROUP BY 1),
m AS (SELECT conv_id, list_concat(
  [{{'role': 'system', 'content': '{PAGE_SYSTEM}' || CASE WHEN conv_id % 2 = 0 THEN chr(10) || '{PAGE_EXTRA}' ELSE '' END}}],
  CASE WHEN conv_id % 3 = 0 THEN [{{'role': 'user', 'content': '{REFERENCE_INTRO}'}},
    {{'role': 'user', 'content': 'reference ' || conv_id}}, {{'role': 'assistant', 'content': '{REFERENCE_REPLY}'}}] ELSE [] END,
  [{{'role': 'user', 'content': question}}], coalesce(ps, [])) AS ms FROM q LEFT JOIN p USING (conv_id))
SELECT conv_id, len(ms)::BIGINT AS n_messages, to_json(ms) AS messages FROM m
""")
def page_messages(spark, sf_dir):
    """System with extra text, the reference triple, the question, then one message per page."""
    turns = table(spark, sf_dir, "conversations")
    even, third = F.col("conv_id") % 2 == 0, F.col("conv_id") % 3 == 0
    questions = turns.where("turn = 0").select(
        "conv_id", F.col("text").alias("question"), F.when(even, F.lit(PAGE_EXTRA)).alias("extra_system"),
        F.when(third, F.concat(F.lit("reference "), F.col("conv_id").cast("string"))).alias("reference"))
    return messages.page_messages(questions, turns.where("turn > 0"), "conv_id", "turn", "text", PAGE_SYSTEM,
                                  REFERENCE_INTRO, REFERENCE_REPLY)


@query("whole_text", f"""
SELECT source || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS rel_path, coalesce(text, '') AS text,
       CAST(greatest((octet_length(encode(coalesce(text, ''))) + 4095) // 4096, 1) AS BIGINT) AS n_pieces
FROM documents WHERE {_KIND} = 0
""")
def whole_text(spark, sf_dir):
    """The text files of the staged folder as one value each, read in ranges of 4 KB and put together."""
    root = staging.document_files(spark, sf_dir)
    pieces = filesrc.text_pieces(spark, root, piece_bytes=4096, recursive=True, extensions=".txt", ignore=["skipme"])
    return filesrc.joined_text(pieces).select(F.regexp_replace("path", r"^.*/files/", "").alias("rel_path"), "text", "n_pieces")


@query("overwrite_append", """
SELECT c_custkey, c_name, c_acctbal, n FROM customer, (VALUES (1), (2)) copies(n) WHERE n = 1 OR c_custkey % 3 = 0
""")
def overwrite_append(spark, sf_dir):
    """A third of the customers written, all written over them, then a third appended; the table read back."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = fresh_shared_path(spark, "sink")
    third = cust.where("c_custkey % 3 = 0")
    write_table(third.withColumn("n", F.lit(0)), path)
    write_table(cust.withColumn("n", F.lit(1)), path)
    write_table(third.withColumn("n", F.lit(2)), path, override=False)
    return spark.read.parquet(path)
