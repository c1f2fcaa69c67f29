"""The corpus pipeline: toxicity, line dedup, near-duplicate join, decontamination, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. `run` writes every stage as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.llm import decontaminate, encoding, line_dedup, ngram_join, toxicity
from sparkdesk.llm.common import written
from sparkdesk.llm.queries import ENCODE_MODEL, training
from sparkdesk.session import ship_package, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents scored 0.5 or more go. Learns from the labels outside the held-out fifth."""
    ship_package(spark)
    model = toxicity.fit(docs, training(table(spark, sf_dir, "labels"), 5, 0))
    return docs.select(*COLUMNS).where(toxicity.toxicity(spark, F.col("text"), model) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines that many documents hold stay in one; texts and n_chars follow."""
    ship_package(spark)
    out = line_dedup.dedup_lines(docs, carry=("text", "lang", "source", "n_chars"))
    kept = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))
    chars = F.when(F.col("n_dropped") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", kept.alias("text"), "lang", "source", chars.alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of every group of linked documents one row stays, that of the smallest doc_id (null ids last).

    Groups are joined by a key of the row, so null and repeated ids stand for no other row."""
    ship_package(spark)
    rows = written(docs.select(*COLUMNS).dropDuplicates(list(COLUMNS)).withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")
    groups = ngram_join.components_of(rows, key="_row").select("_row", "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", F.xxhash64("text").alias("text_hash"),
                    F.xxhash64("lang", "source", "n_chars").alias("rest_hash"), "_row")
    ranked = rows.select("_row", rank.alias("rank")).join(groups, "_row")
    keep = ranked.groupBy("component_id").agg(F.min("rank").alias("least")).select(F.col("least._row").alias("_row"))
    return rows.join(keep, "_row", "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a window of a benchmark item go."""
    ship_package(spark)
    hit = decontaminate.contaminated_texts(docs, table(spark, sf_dir, "benchmark"))
    d = docs.select(*COLUMNS)
    return d.join(hit, d["doc_id"].eqNullSafe(hit["_id"]) & F.xxhash64(d["text"]).eqNullSafe(hit["_hash"]), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: ids and decoded text of what is left, as digests."""
    ship_package(spark)
    return encoding.encoding_digest(docs, public_tokenizers.path(ENCODE_MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

# The compression-distance classifier and the tokenizer are beyond SQL: tested by brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
