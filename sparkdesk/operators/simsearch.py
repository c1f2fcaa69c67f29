"""Similarity search (B4-B14): a batch of terms matched to entity rows by trigram similarity.

One job for the whole batch (the reference runs one query per item):

1. items → distinct trigrams of each term (``n_a``);
2. entity identifier columns → distinct trigrams per (row, column) (``n_b``);
3. candidates by an exact prefix filter: a pair passes only if it shares more than
   min_pct % of the term's trigrams, hence at least one of the term's
   n_a - floor(min_pct * n_a / 100) rarest trigrams; only those join the entity trigrams
   (the item side is a request batch, broadcast after a size check, else a shuffle join
   with AQE splitting skewed keys), so hot trigrams never fan out;
4. candidates are recounted exactly per column from the two trigram sets;
5. lossless bound: both measures are <= shared / n_a, so pairs with
   100 * shared <= min_pct * n_a can never pass the threshold and are dropped before the
   word-similarity run search (mapInPandas, survivors only); so are pairs whose shared / n_a
   is under the k-th best plain similarity of their item;
6. score = greatest over columns of greatest(similarity, word_similarity) * 100,
   threshold (strictly greater), top-k per item with a (score desc, id) order. Spark plans
   a partial ``WindowGroupLimit`` before the shuffle, so a hot item sends at most k rows
   per task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.quoted_runs import Quotes
from ..functions.text import score_text
from ..functions.text_windows import Text, TermBlock, guesses_of, scores_of, trigram_places
from ..functions.trigram import add_run_similarity, similarity_from_counts, trigram_codes, with_trigram_codes
from ..functions.trigram_counts import GROUP_CHARS
from ..session import cut_lineage, fits, fresh_shared_path, spread_small, stored, task_slots

# Defaults of a request.
DEFAULT_K = 1
DEFAULT_MIN_PCT = 30.0
SAFE_NAME = re.compile(r"^[a-z_][a-z0-9_]*$")

# Item batches up to this many trigram rows are broadcast; beyond, the join shuffles.
ITEM_BROADCAST_ROWS = 200_000


def parse_k(value, default: int = DEFAULT_K) -> int:
    """Missing, empty or the text 'null' → default."""
    if value is None or (isinstance(value, str) and value.strip().lower() in ("", "null")):
        return default
    return int(value)


def parse_min_pct(value, default: float = DEFAULT_MIN_PCT) -> float:
    if value is None or (isinstance(value, str) and value.strip().lower() in ("", "null")):
        return default
    return float(value)


def identifier_columns(schema: StructType, configured: list) -> list:
    """Configured identifier columns that are text and have a safe name, in order."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    out = []
    for c in configured:
        name = c.lower()
        if SAFE_NAME.match(name) and isinstance(types.get(name), StringType):
            out.append(name)
    return out


def items_from_json(df: DataFrame, col: str = "items") -> DataFrame:
    """JSON array of strings → (item_index, term); quotes stripped, blanks skipped, index kept."""
    arr = F.from_json(F.col(col), "array<string>")
    others = [c for c in df.columns if c != col]
    out = df.select(*others, F.posexplode(arr).alias("item_index", "term"))
    return normalise_items(out)


def normalise_items(items: DataFrame) -> DataFrame:
    return (items.withColumn("term", F.regexp_replace("term", "'", ""))
            .filter(F.col("term").isNotNull() & (F.trim("term") != "")))


def similarity_search(entity: DataFrame, id_col: str, columns: list, items: DataFrame,
                      min_pct: float = DEFAULT_MIN_PCT, k: int = DEFAULT_K,
                      use_word_similarity: bool = True, label: Column | None = None,
                      fold_upper: bool = True, checkpoint_sets: bool = True) -> DataFrame:
    """Top-k entity rows per item. ``columns`` are identifier column names or Columns; when it
    is empty, ``label`` is scored instead (B12). ``items(item_index, term)``.

    Output: item_index, item, term, id, name, score (4 decimals), similarity_percent, rank.
    ``fold_upper`` upper-cases both sides first, as the entity search does.
    """
    if not columns:
        if label is None:
            raise ValueError("no identifier column and no label")
        columns = [label]
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    n_cols = len(cols)
    name_expr = label if label is not None else F.concat_ws(" - ", *cols)

    it_terms = normalise_items(items.select("item_index", "term"))
    # the batch side is small: its codes come from column expressions (no Python pass)
    it_sets = it_terms.select("item_index", "term", trigram_codes(
        F.upper("term") if fold_upper else F.col("term")).alias("a_set"))
    it_trg = it_sets.select("item_index", F.size("a_set").alias("n_a"), F.explode("a_set").alias("trg"))
    small = fits(it_trg, ITEM_BROADCAST_ROWS)
    bc = F.broadcast if small else (lambda d: d)

    ent = entity.select(F.col(id_col).alias("id"), *[c.alias(f"t{i}") for i, c in enumerate(cols)],
                        name_expr.alias("name"))
    # The trigram sets are the Python-heavy step: an input with fewer partitions than task slots
    # (one small file) is spread first; a large input keeps its scan partitions.
    ent = spread_small(ent, "id")
    slots = task_slots(ent.sparkSession)
    t_frac = float(max(min_pct, 0.0)) / 100.0
    if small and not use_word_similarity and t_frac > 0:
        ent = _reaching_rows(ent, n_cols, it_sets, float(min_pct), int(k), fold_upper)
    # each row's trigram sets, computed once per row (never per candidate pair); the Python pass
    # costs far more than writing its result, and three steps below read it, so it is written
    # once to the shared checkpoint folder (a reliable checkpoint: lost executors re-read it)
    ent_sets = with_trigram_codes(ent, [(f"t{i}", f"b{i}", False) for i in range(n_cols)], fold_upper=fold_upper)
    if checkpoint_sets:
        ent_sets = cut_lineage(ent_sets)
    if not use_word_similarity and t_frac > 0:
        # Length bound (exact for plain similarity): s / (n_a + n_b - s) >= t with s <= n_a needs
        # n_b * t <= n_a. Rows too long for every term of the batch are dropped before exploding.
        max_n_a = it_trg.agg(F.max("n_a")).first()[0] or 0  # one number
        ent_sets = ent_sets.filter(F.least(*[F.size(f"b{i}") for i in range(n_cols)]) * t_frac
                                   <= F.lit(max_n_a + 1e-9)) \
            if n_cols > 1 else ent_sets.filter(F.size("b0") * t_frac <= F.lit(max_n_a + 1e-9))
        per_col = F.explode(F.array(*[F.struct(F.size(f"b{i}").alias("n_b"), F.col(f"b{i}").alias("b"))
                                      for i in range(n_cols)])).alias("pc")
        ent_trg = (ent_sets.select("id", per_col)
                   .select("id", F.col("pc.n_b").alias("n_b"), F.explode("pc.b").alias("trg")))
    else:
        ent_trg = ent_sets.select("id", F.lit(0).alias("n_b"), F.explode(F.array_distinct(F.flatten(F.array(
            *[F.col(f"b{i}") for i in range(n_cols)])))).alias("trg"))

    # Prefix filter (exact): a pair can pass only if it shares at least min_pct % of the term's
    # n_a trigrams, so it shares at least one of ANY n_a - floor(min_pct * n_a / 100) + 1 of
    # them. Which ones is free to choose; each term keeps its rarest, by the number of entity
    # rows holding the trigram (counted only for the batch's trigrams and combined map-side),
    # so hot trigrams never enter the candidate join.
    freq = (ent_trg.join(bc(it_trg.select("trg").distinct()), "trg", "left_semi")
            .groupBy("trg").agg(F.count(F.lit(1)).alias("freq")))
    keep = F.col("n_a") - F.floor(F.col("n_a") * F.lit(float(max(min_pct, 0.0))) / 100.0) + 1
    w_rare = Window.partitionBy("item_index").orderBy(F.col("freq").asc(), F.col("trg").asc())
    prefix = (it_trg.join(bc(freq), "trg", "left").fillna(0, ["freq"])
              .withColumn("r", F.row_number().over(w_rare)).filter(F.col("r") <= keep)
              .select("item_index", "trg", "r"))
    pj = bc(prefix.join(it_trg.select("item_index", "n_a").distinct(), "item_index"))
    cand_pairs = ent_trg.join(pj, "trg")
    if not use_word_similarity and t_frac > 0:
        # Plain similarity also knows the row's size: s / (n_a + n_b - s) >= t needs
        # s >= t (n_a + n_b) / (1 + t), so only the n_a - s_min + 1 rarest trigrams of the term
        # can carry the pair (length-aware prefix; a few trigrams for a long row). Bounds are
        # taken non-strict with a small margin, so float rounding can only keep more.
        s_min = F.ceil(F.lit(t_frac) * (F.col("n_a") + F.col("n_b")) / F.lit(1.0 + t_frac) - F.lit(1e-9))
        cand_pairs = cand_pairs.filter((F.col("n_b") * t_frac <= F.col("n_a") + F.lit(1e-9))
                                       & (F.col("r") <= F.col("n_a") - s_min + 1))
    # the recount below is CPU-bound: fix the pair partitioning at the task-slot count (the same
    # hash partitioning serves the distinct, and the adaptive planner does not pack it)
    cand = cand_pairs.select("item_index", "id").repartition(slots, "item_index", "id").distinct()

    # survivors get texts (entity by id: both sides grow with the entity, and the planned size of its sets is
    # that of the compressed table, so neither is ever broadcast) and the term's set (checked-small batch), then an
    # exact recount per column
    cand = cand.join(ent_sets.hint("merge"), "id").join(bc(it_sets), "item_index")
    cand = cand.select("item_index", "id", "name", "term", "a_set", *[f"t{i}" for i in range(n_cols)],
                       F.size("a_set").alias("n_a"),
                       *[F.size(F.array_intersect("a_set", f"b{i}")).alias(f"s{i}") for i in range(n_cols)],
                       *[F.size(f"b{i}").alias(f"nb{i}") for i in range(n_cols)])

    best_shared = F.greatest(*[F.col(f"s{i}") for i in range(n_cols)]) if n_cols > 1 else F.col("s0")
    cand = cand.filter(best_shared * 100.0 >= F.lit(float(min_pct)) * F.col("n_a") - F.lit(1e-9))

    sims = [similarity_from_counts(F.col(f"s{i}"), F.col("n_a"), F.coalesce(F.col(f"nb{i}"), F.lit(0))) for i in range(n_cols)]
    if use_word_similarity:
        # Floors (exact): the k-th best plain similarity of an item is never above its k-th best score, and no pair
        # scores above shared / n_a. Pairs whose bound is under their item's floor are not searched for runs.
        cand = stored(cand.drop("a_set"), "search-pairs")
        plain = F.greatest(*sims) if n_cols > 1 else sims[0]
        by_plain = Window.partitionBy("item_index").orderBy(F.col("plain").desc())
        floors = (cand.select("item_index", plain.alias("plain")).withColumn("r", F.row_number().over(by_plain))
                  .where(F.col("r") == int(k)).select("item_index", F.col("plain").alias("floor")))
        cand = (cand.join(bc(floors), "item_index", "left")
                .where(F.col("floor").isNull() | (best_shared / F.col("n_a") >= F.col("floor") - F.lit(1e-9))).drop("floor"))
        # CPU-heavy per row: spread the remaining candidates over every task slot, as the
        # adaptive planner would otherwise pack them into a few partitions by byte size; the
        # ordered trigram codes of each text, then one linear run search per pair
        cand = cand.repartition(slots)
        cand = with_trigram_codes(cand, [("term", "a_set", False), *[(f"t{i}", f"l{i}", True) for i in range(n_cols)]],
                                  fold_upper=fold_upper)
        cand = add_run_similarity(cand, [("a_set", f"l{i}", f"w{i}") for i in range(n_cols)])
    scores = []
    for i in range(n_cols):
        scores.append((F.greatest(sims[i], F.col(f"w{i}")) if use_word_similarity else sims[i]) * 100.0)
    score = F.greatest(*scores) if len(scores) > 1 else scores[0]
    scored = cand.select("item_index", "term", "id", "name", score.alias("raw_score"))
    scored = scored.filter(F.col("raw_score") > F.lit(float(min_pct)))
    w = Window.partitionBy("item_index").orderBy(F.col("raw_score").desc(), F.col("id").asc())
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= int(k))
    return top.select("item_index", F.concat(F.lit("item_"), F.col("item_index").cast("string")).alias("item"),
                      "term", "id", F.coalesce(F.col("name"), F.lit("")).alias("name"),
                      F.round("raw_score", 4).alias("score"),
                      score_text(F.col("raw_score")).alias("similarity_percent"), "rank")


def _reaching_rows(ent: DataFrame, n_cols: int, it_sets: DataFrame, min_pct: float, k: int, fold_upper: bool) -> DataFrame:
    """The rows that reach the threshold for some term by plain similarity and, of the rows their task has met until then, are among the
    term's k best (ties included): all that the search can return. Rows without an id match nothing, as in the join by id."""
    import numpy as np

    rows = it_sets.where(F.col("item_index").isNotNull() & (F.size("a_set") > 0)).select("a_set").collect()
    sets = [np.array(r[0], np.int64) for r in rows]

    def run(batches):
        from ..functions.trigram_counts import Reaching, TermLists

        reaching = Reaching(TermLists(sets), min_pct, max(k, 1))
        for pdf in batches:
            yield pdf.iloc[reaching.rows([pdf[f"t{i}"].tolist() for i in range(n_cols)], fold_upper)]

    return ent.where(F.col("id").isNotNull()).mapInPandas(run, ent.schema)


# Terms that every task holds; more are read by the tasks from a table in the shared folder, block by block.
TERM_ROWS, TERM_CHARS = 10_000, 8_000_000
BLOCK_TERMS = 256  # terms counted against a text at once
SCOUT_SHARE, SCOUT_ROWS = 0.05, 20_000  # texts that set the first floors
CHUNK_PLACES = 1_000_000  # trigram places of the texts a task holds at once


def _long_text_scorer(term_blocks, min_pct: float, k: int, guess: bool = False):
    """Task function: (item_index, id, name, raw_score) rows that hold each term's top k of the task, ties included.

    ``term_blocks()`` yields lists of (item_index, term, floor). A term's floor rises to the k-th best score met so far.
    With ``guess`` the k-th best score of one run of each text, which is no more than the k-th best score, raises the floors before."""
    import numpy as np
    import pandas as pd

    low = max(min_pct / 100.0, 1e-9)
    columns = ["item_index", "id", "name", "raw_score"]

    def scored(texts, floors):
        for n, terms in enumerate(term_blocks()):
            sets = [np.unique(trigram_places(t)) for _, t, _ in terms]
            block = TermBlock(sets)
            mine = floors.setdefault(n, np.array([max(low, f) for *_, f in terms]))
            for score in (guesses_of, scores_of) if guess else (scores_of,):
                tops = [[] for _ in terms]
                for (id_, name, codes), some in zip(texts, block.reaching([c for *_, c in texts], mine), strict=True):
                    if not len(some):
                        continue
                    for j, best in score(Text(codes), block, mine, some).items():
                        tops[j].append((best, id_, name))
                        if len(tops[j]) >= k:
                            mine[j] = max(mine[j], sorted((s for s, _, _ in tops[j]), reverse=True)[k - 1])
                            tops[j] = [r for r in tops[j] if r[0] >= mine[j]]
            yield pd.DataFrame([(i, id_, name, s * 100.0) for (i, *_), top in zip(terms, tops, strict=True) for s, id_, name in top], columns=columns)

    def run(batches):
        floors, texts, held = {}, [], 0
        for pdf in batches:
            for id_, name, text in zip(pdf["id"], pdf["name"], pdf["text"], strict=True):
                places = trigram_places(text)
                if len(places):
                    texts.append((id_, name, places))
                    held += len(places)
                if held > CHUNK_PLACES:
                    yield from scored(texts, floors)
                    texts, held = [], 0
        if texts:
            yield from scored(texts, floors)

    return run


def _quote_scorer(rows: list, k: int):
    """Task function: (item_index, raw_score), each term's k best scores of runs that quote it, one for each of the task's texts at most."""
    import numpy as np
    import pandas as pd

    rows = [(i, t) for i, t, *_ in rows if i is not None]

    def run(batches):
        quotes = Quotes([t for _, t in rows])
        best = [[] for _ in rows]
        for pdf in batches:
            if not (texts := [t.lower() for t in pdf["text"] if t]):
                continue
            part = np.cumsum([len(t) for t in texts]) // GROUP_CHARS
            for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(part)) + 1):
                for _, j, score in quotes.scores([texts[i] for i in some.tolist()]):
                    if len(best[j]) < k or score > best[j][-1]:
                        best[j] = sorted([*best[j], score], reverse=True)[:k]
        yield pd.DataFrame([(i, s * 100.0) for (i, _), top in zip(rows, best, strict=True) for s in top], columns=["item_index", "raw_score"])

    return run


def _held_terms(rows: list):
    return lambda: (rows[s:s + BLOCK_TERMS] for s in range(0, len(rows), BLOCK_TERMS))


def _stored_terms(terms: DataFrame):
    """The terms as a table in the shared folder that tasks read a block at a time; nothing passes through the driver."""
    folder = fresh_shared_path(terms.sparkSession, "search-terms")
    terms.write.parquet(folder)

    def blocks():
        import pyarrow.dataset as ds

        from ..sources.blobs import _fs

        fs, inner = _fs(folder)
        for part in sorted(ds.dataset(inner, filesystem=fs, format="parquet").files):
            for batch in ds.dataset(part, filesystem=fs, format="parquet").to_batches(batch_size=BLOCK_TERMS):
                yield list(zip(batch["item_index"].to_pylist(), batch["term"].to_pylist(), batch["floor"].to_pylist(), strict=True))

    return blocks


def search_long_texts(entity: DataFrame, id_col: str, text_col: str, items: DataFrame,
                      min_pct: float = DEFAULT_MIN_PCT, k: int = DEFAULT_K) -> DataFrame:
    """``similarity_search`` by both measures over one column of long texts, case as in the rules, with the
    id as name. No (item, row) pair becomes a row: a count filter over sliding windows bounds every run (see
    ``functions.text_windows``), only what can reach a term's k-th best score is scored, and every task keeps its own top k.
    The whole text is one of its runs, so the best run is the greater of both measures."""
    terms = normalise_items(items.select(F.col("item_index").cast("long").alias("item_index"), "term"))
    small = fits(terms, TERM_ROWS) and (terms.agg(F.sum(F.length("term"))).first()[0] or 0) <= TERM_CHARS
    kind = entity.schema[id_col].dataType
    rows = entity.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))

    def search(texts: DataFrame, terms: DataFrame, guess: bool = False) -> DataFrame:
        source = _held_terms([tuple(r) for r in terms.collect()]) if small else _stored_terms(terms)
        return spread_small(texts, "id").mapInPandas(_long_text_scorer(source, float(min_pct), int(k), guess), "item_index long, id string, name string, raw_score double")

    best = Window.partitionBy("item_index").orderBy(F.col("raw_score").desc())

    def with_floors(terms: DataFrame, scores: DataFrame) -> DataFrame:
        """The k-th best of some scores, one of each text at most, is never above the k-th best of all."""
        kth = (scores.withColumn("r", F.row_number().over(best)).where(F.col("r") == int(k))
               .select("item_index", (F.col("raw_score") / 100.0 - 1e-12).alias("more")))
        return terms.join(kth, "item_index", "left").select("item_index", "term", F.greatest("floor", F.coalesce("more", F.lit(0.0))).alias("floor"))

    # texts that quote a term, then a few texts scored in full, give every term a first floor
    floored = terms.withColumn("floor", F.lit(0.0))
    if small:
        quoting = spread_small(rows, "id").mapInPandas(_quote_scorer([tuple(r) for r in terms.collect()], max(int(k), 1)), "item_index long, raw_score double")
        floored = cut_lineage(with_floors(floored, quoting))
    share = min(SCOUT_SHARE, SCOUT_ROWS / max(rows.count(), 1))
    scouts = rows.where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    scored = search(rows, with_floors(floored, search(scouts, floored, guess=True)))
    scored = scored.where(F.col("raw_score") > F.lit(float(min_pct))).withColumn("id", F.col("id").cast(kind))
    w = Window.partitionBy("item_index").orderBy(F.col("raw_score").desc(), F.col("id").asc())
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= int(k)).join(terms, "item_index")
    return top.select("item_index", F.concat(F.lit("item_"), F.col("item_index").cast("string")).alias("item"),
                      "term", "id", F.coalesce(F.col("name"), F.lit("")).alias("name"),
                      F.round("raw_score", 4).alias("score"),
                      score_text(F.col("raw_score")).alias("similarity_percent"), "rank")


def search_request(entities: dict, entity: str | None, items_json: str | None, qty_results=None,
                   min_sim_percent=None, spark=None) -> DataFrame:
    """B14 request form. ``entities`` maps a name to (DataFrame, id column, identifier columns).
    Missing items or entity → error; an unknown entity gives one status row, not a failure;
    'null' / empty parameters take the defaults."""
    if not items_json or not entity:
        raise ValueError("Missing parameter: items and entityName are required")
    if entity not in entities:
        return spark.createDataFrame([(entity, "Entity not found")], "entity string, status string")
    df, id_col, configured = entities[entity]
    req = df.sparkSession.createDataFrame([(items_json,)], "items string")
    items = items_from_json(req)
    cols = identifier_columns(df.schema, configured)
    return similarity_search(df, id_col, cols, items, min_pct=parse_min_pct(min_sim_percent),
                             k=parse_k(qty_results), label=None if cols else F.col(id_col).cast("string"))
