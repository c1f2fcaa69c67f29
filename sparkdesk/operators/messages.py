"""Ordered message assembly (E12): per conversation, system messages first, then the rest in
turn order, as one JSON array of {role, content}."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assemble_messages(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text") -> DataFrame:
    """conv, n_messages, messages: one row for each conversation, as long as the conversation is."""
    msg = F.struct((F.col(role) != "system").alias("o1"), F.col(turn).alias("o2"),
                   F.struct(F.col(role).alias("role"), F.col(text).alias("content")).alias("m"))
    grouped = turns.groupBy(conv).agg(F.count(F.lit(1)).alias("n_messages"), F.array_sort(F.collect_list(msg)).alias("ms"))
    return grouped.select(conv, "n_messages", F.to_json(F.transform("ms", lambda x: x["m"])).alias("messages"))


def page_messages(questions: DataFrame, pages: DataFrame, key: str, page: str, content: str, system: str,
                  reference_intro: str, reference_reply: str) -> DataFrame:
    """key, n_messages, messages: per document the system text (with ``extra_system`` on a line of its own, if
    there is one), the reference triple (if there is a ``reference``), the question, then one message per page.

    ``questions`` has one row per document: key, question, extra_system, reference (the last two may be null).
    A document without pages keeps its opening messages; pages without a question row are left out.
    """
    def message(role: str, text) -> Column:
        return F.struct(F.lit(role).alias("role"), text.alias("content"))

    per = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("o"), F.col(content).alias("c")))).alias("ps"))
    q = questions.select(key, "question", "extra_system", "reference").join(per, key, "left")
    opening = F.array(message("system", F.concat_ws("\n", F.lit(system), F.expr("nullif(extra_system, '')"))))
    triple = F.array(message("user", F.lit(reference_intro)), message("user", F.col("reference")),
                     message("assistant", F.lit(reference_reply)))
    triple = F.when(F.length("reference") > 0, triple).otherwise(F.slice(triple, 1, 0))
    asked = F.array(message("user", F.col("question")))
    shown = F.coalesce(F.transform("ps", lambda x: message("user", x["c"])), F.slice(asked, 1, 0))
    out = q.select(key, F.concat(opening, triple, asked, shown).alias("ms"))
    return out.select(key, F.size("ms").cast("long").alias("n_messages"), F.to_json("ms").alias("messages"))
