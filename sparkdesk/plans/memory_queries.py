"""Registered queries for the memory log and vector search (family D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import memory
from ..operators.rules import top_per_key
from ..session import cut_lineage, fresh_shared_path, table
from .registry import query

# events as an operation log: signup = add, click = update, error = delete, view = search,
# purchase = a mode the tool does not know. Ids come from the event's k; the assistant from
# the user; events with value <= 1 carry no text.
_OP_SQL = ("CASE event_type WHEN 'signup' THEN 'add' WHEN 'click' THEN 'update' WHEN 'error' THEN 'delete' "
           "WHEN 'view' THEN 'search' ELSE event_type END")


def _log(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"), F.expr(_OP_SQL).alias("op"),
        F.concat(F.lit("asst_"), (F.col("user_id") % 3).cast("string")).alias("assistant_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(~((F.col("event_type") == "signup") & (F.col("event_id") % 7 == 0)), F.get_json_object("props", "$.k"))
        .alias("memory_id"),  # every seventh add comes without an id
        F.when(F.col("value") > 1, F.concat(F.lit("note "), F.col("event_id").cast("string"), F.lit(" "),
                                            F.col("props"))).alias("content"))


_LOG_SQL = f"""
log AS (SELECT event_id AS seq, {_OP_SQL} AS op, 'asst_' || CAST(user_id % 3 AS VARCHAR) AS assistant_id,
               CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_type = 'signup' AND event_id % 7 = 0
                    THEN 'mem-asst_' || CAST(user_id % 3 AS VARCHAR) || '-' || CAST(event_id AS VARCHAR)
                    ELSE json_extract_string(props, '$.k') END AS memory_id,
               CASE WHEN value > 1 THEN 'note ' || CAST(event_id AS VARCHAR) || ' ' || props END AS content
        FROM events),
v AS (SELECT *, CASE
        WHEN op IS NULL OR op NOT IN ('add', 'update', 'delete', 'search') THEN 'invalid mode'
        WHEN coalesce(trim(assistant_id), '') = '' OR coalesce(trim(user_id), '') = ''
          THEN 'assistant and user are required'
        WHEN op = 'add' AND coalesce(trim(content), '') = '' THEN 'content is required'
        WHEN op = 'update' AND (coalesce(trim(memory_id), '') = '' OR coalesce(trim(content), '') = '')
          THEN 'memory_id and content are required'
        WHEN op = 'delete' AND coalesce(trim(memory_id), '') = '' THEN 'memory_id is required'
        WHEN op = 'search' AND coalesce(trim(content), '') = '' THEN 'query is required' END AS error
      FROM log),
adds AS (SELECT assistant_id, memory_id, min(seq) AS add_seq, arg_min(user_id, seq) AS owner
         FROM v WHERE error IS NULL AND op = 'add' GROUP BY ALL),
wa AS (SELECT v.*, a.add_seq, a.owner FROM v LEFT JOIN adds a
       ON v.assistant_id = a.assistant_id AND v.memory_id = a.memory_id),
dels AS (SELECT assistant_id, memory_id, min(seq) AS del_seq FROM wa
         WHERE error IS NULL AND owner IS NOT NULL AND user_id = owner AND seq > add_seq AND op = 'delete'
         GROUP BY ALL),
f AS (SELECT wa.*, d.del_seq FROM wa LEFT JOIN dels d
      ON wa.assistant_id = d.assistant_id AND wa.memory_id = d.memory_id),
st AS (SELECT *, CASE
        WHEN error IS NOT NULL THEN 'invalid'
        WHEN op = 'search' THEN 'search'
        WHEN op = 'add' THEN CASE WHEN seq = add_seq THEN 'added' ELSE 'duplicate' END
        WHEN op = 'update' AND owner IS NOT NULL AND user_id = owner AND seq > add_seq
             AND (del_seq IS NULL OR seq < del_seq) THEN 'updated'
        WHEN op = 'delete' AND owner IS NOT NULL AND user_id = owner AND seq > add_seq AND seq = del_seq
             THEN 'deleted'
        ELSE 'not found' END AS status
      FROM f)"""


@query("memory_status", f"""
WITH {_LOG_SQL}
SELECT seq, op, assistant_id, user_id, memory_id, content, error, status FROM st
""")
def memory_status(spark, sf_dir):
    """D-1..D-3, D-6: the status of every operation of the log."""
    return memory.fold_status(_log(spark, sf_dir)).select(
        "seq", "op", "assistant_id", "user_id", "memory_id", "content", "error", "status")


@query("memory_state", f"""
WITH {_LOG_SQL},
g AS (SELECT assistant_id, memory_id, max(CASE WHEN status = 'deleted' THEN 1 END) AS gone,
             arg_max(content, seq) FILTER (WHERE status IN ('added', 'updated')) AS content,
             max(seq) FILTER (WHERE status IN ('added', 'updated')) AS last_seq,
             max(user_id) FILTER (WHERE status = 'added') AS user_id
      FROM st GROUP BY ALL)
SELECT assistant_id, memory_id, user_id, content, last_seq FROM g WHERE gone IS NULL AND last_seq IS NOT NULL
""")
def memory_state(spark, sf_dir):
    """D-1..D-3: live memories after the whole log."""
    return memory.fold_state(memory.fold_status(_log(spark, sf_dir)))


def _memories(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("label").cast("string").alias("user"), F.col("vec_id").alias("id"),
                    F.col("embedding").alias("vec"))


SEARCH_K = 3


@query("memory_search", f"""
WITH m AS (SELECT CAST(label AS VARCHAR) AS usr, vec_id AS id, embedding FROM embeddings),
q AS (SELECT usr, max(id) AS qid, arg_max(embedding, id) AS qvec FROM m GROUP BY usr),
d AS (SELECT q.usr, m.id,
             list_distance(CAST(m.embedding AS DOUBLE[]), CAST(q.qvec AS DOUBLE[])) AS dist
      FROM q JOIN m ON m.usr = q.usr AND m.id <> q.qid),
r AS (SELECT *, row_number() OVER (PARTITION BY usr ORDER BY dist, id) AS rank FROM d)
SELECT usr AS user_id, list(id ORDER BY rank) AS ids,
       string_agg('- embedding ' || CAST(id AS VARCHAR) || ' (memory_id: ' || CAST(id AS VARCHAR) || ')',
                  chr(10) ORDER BY rank) AS result
FROM r WHERE rank <= {SEARCH_K} GROUP BY usr
""")
def memory_search(spark, sf_dir):
    """D-4, D-5, D-7: per user, the memories nearest to the user's latest one (itself excluded),
    as the tool's text lines."""
    mem = _memories(spark, sf_dir)
    latest = mem.groupBy("user").agg(F.max_by(F.struct("id", "vec"), "id").alias("q"))
    queries = latest.select(F.col("q.id").alias("query_id"), "user", F.col("q.vec").alias("vec"),
                            F.col("q.id").alias("source_id"))
    ranked = memory.knn(mem, queries, k=SEARCH_K, exclude_self=True)
    content = F.concat(F.lit("embedding "), F.col("id").cast("string"))
    return memory.result_lines(ranked, content, ["user"]).withColumnRenamed("user", "user_id")


TEMPLATES_PER_AGENT = 3
TEMPLATE_MAX_DISTANCE = 1.3


@query("template_match", f"""
WITH e AS (SELECT vec_id, CAST(label AS VARCHAR) AS usr, embedding FROM embeddings),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY usr ORDER BY vec_id) AS rn FROM e)
      WHERE rn <= {TEMPLATES_PER_AGENT}),
d AS (SELECT e.vec_id, t.vec_id AS template_id,
             list_distance(CAST(e.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])) AS dist
      FROM e JOIN t ON e.usr = t.usr),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, template_id) AS rn FROM d)
      WHERE rn = 1 AND dist < {TEMPLATE_MAX_DISTANCE})
SELECT e.vec_id, e.usr AS agent, b.template_id, round(b.dist, 4) AS distance
FROM e LEFT JOIN b ON e.vec_id = b.vec_id
""")
def template_match(spark, sf_dir):
    """D-8: every vector matched to the nearest of its agent's first three vectors, under a
    distance threshold; unmatched rows kept with nulls."""
    mem = _memories(spark, sf_dir)
    templates = top_per_key(mem, ["user"], [F.col("id").asc()], TEMPLATES_PER_AGENT).select(
        F.col("id").alias("template_id"), "user", "vec")
    best = memory.best_template(mem, templates, TEMPLATE_MAX_DISTANCE)
    return best.select(F.col("id").alias("vec_id"), F.col("user").alias("agent"), "template_id",
                       F.round("distance", 4).alias("distance"))


EVERY = 20  # every vec_id divisible by this is a search query and a template


@query("memory_search_many", f"""
WITH m AS (SELECT CAST(label AS VARCHAR) AS usr, vec_id AS id, embedding FROM embeddings),
q AS (SELECT usr, id AS qid, embedding AS qvec FROM m WHERE id % {EVERY} = 0),
d AS (SELECT q.qid, m.id, list_distance(CAST(m.embedding AS DOUBLE[]), CAST(q.qvec AS DOUBLE[])) AS dist
      FROM q JOIN m ON m.usr = q.usr AND m.id <> q.qid),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM d),
g AS (SELECT qid, list(id ORDER BY rank) AS ids,
             string_agg('- embedding ' || CAST(id AS VARCHAR) || ' (memory_id: ' || CAST(id AS VARCHAR) || ')',
                        chr(10) ORDER BY rank) AS result
      FROM r WHERE rank <= {SEARCH_K} GROUP BY qid)
SELECT q.qid AS query_id, q.usr AS user_id, coalesce(g.ids, []) AS ids,
       coalesce(g.result, 'No memories found for user_id ' || q.usr || ' with query: embedding ' || CAST(q.qid AS VARCHAR))
         AS result
FROM q LEFT JOIN g ON q.qid = g.qid
""")
def memory_search_many(spark, sf_dir):
    """D-4, D-5, D-7 over a query set that grows with the table; a query without hits gives the 'none found' line."""
    mem = _memories(spark, sf_dir)
    queries = mem.where(F.col("id") % EVERY == 0).select(F.col("id").alias("query_id"), "user", "vec",
                                                         F.col("id").alias("source_id"))
    ranked = memory.knn(mem, queries, k=SEARCH_K, exclude_self=True, ship=False)
    lines = memory.result_lines(ranked, F.concat(F.lit("embedding "), F.col("id").cast("string")), ["query_id"])
    text = F.concat(F.lit("embedding "), F.col("query_id").cast("string"))
    return memory.none_found(lines, queries, text, ["query_id"]).withColumnRenamed("user", "user_id")


@query("template_match_many", f"""
WITH e AS (SELECT vec_id, CAST(label AS VARCHAR) AS usr, embedding FROM embeddings),
t AS (SELECT * FROM e WHERE vec_id % {EVERY} = 0),
d AS (SELECT e.vec_id, t.vec_id AS template_id,
             list_distance(CAST(e.embedding AS DOUBLE[]), CAST(t.embedding AS DOUBLE[])) AS dist
      FROM e JOIN t ON e.usr = t.usr),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, template_id) AS rn FROM d)
      WHERE rn = 1 AND dist < {TEMPLATE_MAX_DISTANCE})
SELECT e.vec_id, e.usr AS agent, b.template_id, round(b.dist, 4) AS distance
FROM e LEFT JOIN b ON e.vec_id = b.vec_id
""")
def template_match_many(spark, sf_dir):
    """D-8 with templates that grow with the table."""
    mem = _memories(spark, sf_dir)
    templates = mem.where(F.col("id") % EVERY == 0).select(F.col("id").alias("template_id"), "user", "vec")
    best = memory.best_template(mem, templates, TEMPLATE_MAX_DISTANCE, ship=False)
    return best.select(F.col("id").alias("vec_id"), F.col("user").alias("agent"), "template_id",
                       F.round("distance", 4).alias("distance"))


COLLECTION = "asst_1"


@query("memory_collection", f"""
WITH {_LOG_SQL},
n AS (SELECT count(*) AS n FROM embeddings),
g AS (SELECT assistant_id, memory_id, max(CASE WHEN status = 'deleted' THEN 1 END) AS gone,
             arg_max(content, seq) FILTER (WHERE status IN ('added', 'updated')) AS content,
             max(seq) FILTER (WHERE status IN ('added', 'updated')) AS last_seq,
             max(user_id) FILTER (WHERE status = 'added') AS user_id
      FROM st WHERE assistant_id = '{COLLECTION}' GROUP BY ALL),
m AS (SELECT g.memory_id, g.user_id, g.content, g.last_seq, e.embedding FROM g, n, embeddings e
      WHERE g.gone IS NULL AND g.last_seq IS NOT NULL AND e.vec_id = g.last_seq % n.n),
q AS (SELECT st.seq, st.user_id, st.content, e.embedding FROM st, n, embeddings e
      WHERE st.status = 'search' AND st.assistant_id = '{COLLECTION}' AND e.vec_id = st.seq % n.n),
d AS (SELECT q.seq, m.memory_id, m.content, m.last_seq,
             list_distance(CAST(m.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS dist FROM q JOIN m ON q.user_id = m.user_id),
r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY dist, last_seq) AS rank FROM d),
t AS (SELECT seq, string_agg('- ' || content || ' (memory_id: ' || memory_id || ')', chr(10) ORDER BY rank) AS result
      FROM r WHERE rank <= {SEARCH_K} GROUP BY seq)
SELECT q.seq, q.user_id, coalesce(t.result, 'No memories found for user_id ' || q.user_id || ' with query: ' || q.content) AS result
FROM q LEFT JOIN t ON q.seq = t.seq
""")
def memory_collection(spark, sf_dir):
    """D-5: the folded state of the log, with a vector for each text, written by assistant; every search of one
    assistant's users over that assistant's collection (an event's vector is the one at its id modulo their number)."""
    vectors = table(spark, sf_dir, "embeddings")
    n = vectors.count()
    vec = vectors.select(F.col("vec_id").alias("at"), "embedding")
    log = _log(spark, sf_dir).withColumn("at", F.col("seq") % n).join(vec, "at", "left").drop("at")
    status = cut_lineage(memory.fold_status(log))
    path = fresh_shared_path(spark, "collections")
    memory.write_state(memory.fold_state(status), path)
    asked = status.where((F.col("status") == "search") & (F.col("assistant_id") == COLLECTION) & F.col("embedding").isNotNull())
    mine = memory.read_collections(spark, path, asked)
    queries = asked.select(F.col("seq").alias("query_id"), F.col("user_id").alias("user"), F.col("embedding").alias("vec"),
                           F.lit(None).cast("long").alias("source_id"))
    points = mine.where("embedding is not null").select(F.col("user_id").alias("user"), F.col("last_seq").alias("id"), F.col("embedding").alias("vec"))
    ranked = memory.knn(points, queries, k=SEARCH_K, ship=False)
    named = ranked.join(mine.select(F.col("last_seq").alias("id"), "memory_id", "content"), "id").drop("id").withColumnRenamed("memory_id", "id")
    lines = memory.result_lines(named, F.col("content"), ["query_id"]).select("query_id", "result")
    none = F.concat(F.lit("No memories found for user_id "), F.col("user_id"), F.lit(" with query: "), F.col("content"))
    return (asked.select(F.col("seq").alias("query_id"), "user_id", "content").join(lines, "query_id", "left")
            .select(F.col("query_id").alias("seq"), "user_id", F.coalesce("result", none).alias("result")))
