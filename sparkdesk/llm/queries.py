"""The registered queries of the corpus operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, table
from . import decontaminate, embedding_dedup, encoding, lang_id, line_dedup, manifest, ngram_join, packing, prefix_trie, quality, suffix_dedup, token_counts, toxicity
from .common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # Python workers import the package's functions
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return run

    return deco


COUNT_MODEL, ENCODE_MODEL = "byte_bpe_50k.json", "word_bpe_49k.json"


def held_out(docs: DataFrame, m: int, rest: int) -> DataFrame:
    return docs.withColumn("held_out", F.coalesce(crc_mod(F.col("doc_id"), m) == rest, F.lit(False)))


def training(rows: DataFrame, m: int, rest: int) -> DataFrame:
    return rows.where(crc_mod(F.col("doc_id"), m) != rest)


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_id.fit(training(docs, 4, 2))
    out = held_out(lang_id.identify(docs, model), 4, 2)
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_MODEL))


@query("op3_bpe_encoding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encoding_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(ENCODE_MODEL))


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP4_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
h AS (SELECT DISTINCT doc_id, item_id, dw.n, i FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op4_decontamination", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      "contaminated")


OP5_SQL = """
WITH l AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
f AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, f.k IS NOT NULL AND f.keeper <> l.doc_id AS gone FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op6_embedding_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(node, label) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT node AS doc_id, min(label) AS component_id FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)
"""


@query("op8_ngram_join", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components_of(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, training(labels, 5, 0))
    out = docs.select("doc_id", toxicity.toxicity(spark, F.col("text"), model).alias("score"))
    return held_out(out, 5, 0).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.fit(docs, training(labels, 4, 2), "quality")
    return held_out(quality.score(docs, weights), 4, 2).select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# unsigned crc32 of a value's decimal text, bit by bit
CRC_SQL = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda v, i: xor(v // 2, 3988292384::BIGINT * (v % 2)))))"""


def part_sql(x: str) -> str:
    return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"


def leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(part_sql(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


OP11_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf_sql("n_chars")} AS leaf,
                            CASE WHEN {CRC_SQL.format(x="doc_id")} % 7 = 0 THEN {leaf_sql("(n_chars + 1)")} ELSE {leaf_sql("n_chars")} END AS other FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
t(g, lvl, pos, n, h) AS (SELECT g, 0, pos, n, leaf FROM l
    UNION ALL SELECT g, any_value(lvl) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY g, pos // 2),
r AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, pos, n, h) AS (SELECT 0, pos, n, subroot FROM r
    UNION ALL SELECT any_value(lvl) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY pos // 2),
low AS (SELECT l.g, l.pos, t.lvl, t.pos AS at, t.h FROM l JOIN t ON t.g = l.g AND t.n > 1 AND t.pos = xor(l.pos // (1::BIGINT << t.lvl), 1)),
high AS (SELECT r.g, u.lvl, u.pos AS at, u.h FROM r JOIN u ON u.n > 1 AND u.pos = xor(r.pos // (1::BIGINT << u.lvl), 1)),
deep AS (SELECT g, max(lvl) AS top FROM t GROUP BY g),
proof AS (SELECT g, pos, string_agg(h, '' ORDER BY part, lvl) AS p FROM (
    SELECT g, pos, 0 AS part, lvl, h FROM low UNION ALL SELECT l.g, l.pos, 1, high.lvl, high.h FROM l JOIN high USING (g)) GROUP BY g, pos),
f(g, pos, lvl, h) AS (SELECT g, pos, 0, other FROM l
    UNION ALL SELECT f.g, f.pos, f.lvl + 1, CASE WHEN s.h IS NULL THEN sha256(f.h) WHEN s.at % 2 = 1 THEN sha256(f.h || s.h) ELSE sha256(s.h || f.h) END
              FROM f JOIN deep ON deep.g = f.g AND f.lvl < deep.top LEFT JOIN low s ON s.g = f.g AND s.pos = f.pos AND s.lvl = f.lvl),
f2(g, pos, lvl, h) AS (SELECT f.g, f.pos, 0, f.h FROM f JOIN deep ON deep.g = f.g AND deep.top = f.lvl
    UNION ALL SELECT f2.g, f2.pos, f2.lvl + 1, CASE WHEN s.h IS NULL THEN sha256(f2.h) WHEN s.at % 2 = 1 THEN sha256(f2.h || s.h) ELSE sha256(s.h || f2.h) END
              FROM f2 JOIN (SELECT max(lvl) AS top FROM u) m ON f2.lvl < m.top LEFT JOIN high s ON s.g = f2.g AND s.lvl = f2.lvl)
SELECT l.doc_id, l.leaf, r.subroot, x.h AS root, sha256(coalesce(p, '')) AS proof_sha256, f2.h AS folded_root, f2.h = x.h AS verified
FROM l JOIN r USING (g) CROSS JOIN (SELECT h FROM u WHERE n = 1) x LEFT JOIN proof ON proof.g = l.g AND proof.pos = l.pos
JOIN f2 ON f2.g = l.g AND f2.pos = l.pos AND f2.lvl = (SELECT max(lvl) FROM u)
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    out = manifest.manifest(table(spark, sf_dir, "documents"), check={"n_chars": tampered})
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                      F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


OP12_SQL = rf"""
WITH t AS (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({{'id': id, 'words': words}} ORDER BY turn NULLS FIRST, id) AS turns, {CRC_SQL.format(x="conv_id")} % 4 AS h FROM t GROUP BY conv_id),
b AS (SELECT x.conv_id, list_concat(coalesce(y.turns, [])[1:x.h], x.turns[x.h + 1:]) AS turns FROM l x LEFT JOIN l y ON y.conv_id = x.conv_id - x.conv_id % 20),
p AS (SELECT conv_id, len(turns) AS n, d, list_transform(turns[1:d], lambda s: s.id)::VARCHAR[] AS k, coalesce(turns[d].words, 0) AS words
      FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM b)),
g AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE n = d) AS ends
      FROM p GROUP BY d, k),
c AS (SELECT g.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM g v WHERE v.d = g.d + 1 AND v.k[1:g.d] = g.k) AS n_children
      FROM g LEFT JOIN g u ON u.d = g.d - 1 AND u.k = g.k[1:g.d - 1])
SELECT c.conv_id, c.d AS depth, c.parent_conv_id, c.n_convs, c.n_children, count(*) FILTER (WHERE s.n_children = 0) AS n_leaves,
       sum((s.n_convs - 1) * s.words)::BIGINT AS saved_tokens, sha256(coalesce(c.ends, '')) AS ends_sha256
FROM c JOIN c s ON s.d >= c.d AND s.k[1:c.d] = c.k GROUP BY c.k, c.conv_id, c.d, c.parent_conv_id, c.n_convs, c.n_children, c.ends
"""


@query("op12_conversation_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(lists, F.col("conv_id") - F.col("conv_id") % 20, head, 3))


@query("op13_retrieval_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(ENCODE_MODEL), end_id=1)
