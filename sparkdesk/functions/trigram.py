"""Trigram columns (B1-B3) as JVM-side expressions, plus the word-similarity extent search.

A trigram set follows the documented trigram rules: lower-case, split on
non-alphanumerics, pad each word with two leading blanks and one trailing blank, take
every 3-character substring. ``similarity`` is shared / union of the distinct sets.
``word_similarity(a, b)`` is the best similarity between the set of ``a`` and the set of
any contiguous run of ``b``'s ordered (non-deduplicated) trigrams. The run search is
written with array functions for identifier-sized text and as an Arrow-batched pandas UDF
(one linear pass per start) for long text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

WORD_SPLIT = r"[^\p{L}\p{N}]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trigram_list(text) -> Column:
    """Ordered trigrams, word by word, duplicates kept."""
    words = F.filter(F.split(F.regexp_replace(F.lower(_c(text)), WORD_SPLIT, " "), " "),
                     lambda w: F.length(w) > 0)
    return F.flatten(F.transform(
        words,
        lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1),
                              lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, 3))))


def trigram_set(text) -> Column:
    return F.coalesce(F.array_distinct(trigram_list(text)), F.array().cast("array<string>"))


def trigram_codes(text) -> Column:
    """The distinct trigram set as array<bigint> codes (same codes as ``py_trigram_codes``)."""
    def code(g):
        cp = lambda k: F.ascii(F.substring(g, k, 1)).cast("bigint")  # noqa: E731  (code point)
        return F.shiftleft(cp(1), 42).bitwiseOR(F.shiftleft(cp(2), 21)).bitwiseOR(cp(3))
    return F.transform(trigram_set(text), code)


def similarity_from_counts(shared: Column, n_a: Column, n_b: Column) -> Column:
    """shared / (n_a + n_b - shared); 0 when either side has no trigram."""
    union = n_a + n_b - shared
    return F.when((n_a > 0) & (n_b > 0), shared / union).otherwise(F.lit(0.0))


def similarity(a, b) -> Column:
    sa, sb = trigram_set(a), trigram_set(b)
    return similarity_from_counts(F.size(F.array_intersect(sa, sb)), F.size(sa), F.size(sb))


def best_extent_similarity(term_set, target_list) -> float:
    """Max over contiguous runs of ``target_list`` of |A ∩ R| / |A ∪ R| (R = set of the run).

    Only runs that start and end on a trigram of A can be best. A run is extended while it
    can still beat the best so far: with u distinct trigrams its score is at most n_a / u.
    """
    a = set(term_set) if term_set is not None else set()
    n_a = len(a)
    if n_a == 0 or target_list is None or len(target_list) == 0:
        return 0.0
    t = list(target_list)
    n = len(t)
    best = 0.0
    for s in range(n):
        if t[s] not in a:
            continue
        seen = set()
        shared = 0
        for e in range(s, n):
            g = t[e]
            if g not in seen:
                seen.add(g)
                if g in a:
                    shared += 1
                elif n_a / len(seen) <= best:
                    break
            if g in a:
                sim = shared / (n_a + len(seen) - shared)
                if sim > best:
                    best = sim
        if best >= 1.0:
            break
    return best


def word_similarity_arrays(a_set: Column, t_list: Column) -> Column:
    """Native form: every run that starts and ends on a trigram of A is scored with array
    functions (JVM-side). Cost grows with (matching positions)^2 x length, so it suits
    identifier-sized text; ``add_run_similarity`` is the linear-pass form for long text."""
    n_a = F.size(a_set)
    n = F.size(t_list)
    hit = lambda i: F.array_contains(a_set, F.element_at(t_list, i))

    def run_score(i, j):
        run = F.array_distinct(F.slice(t_list, i, j - i + 1))
        sh = F.size(F.array_intersect(a_set, run))
        return sh / (n_a + F.size(run) - sh)

    per_start = lambda i: F.array_max(F.transform(F.filter(F.sequence(i, n), hit),
                                                  lambda j: run_score(i, j)))
    best = F.aggregate(F.filter(F.sequence(F.lit(1), n), hit), F.lit(0.0).cast("double"),
                       lambda acc, i: F.greatest(acc, per_start(i)))
    return F.when((n_a > 0) & (n > 0), best).otherwise(F.lit(0.0))


def word_similarity(a, b) -> Column:
    """Asymmetric, term first. For use over many rows prefer ``with_word_similarity``, which
    computes both trigram arrays once per row instead of inside the run search."""
    return word_similarity_arrays(trigram_set(a), trigram_list(b))


def with_word_similarity(df: DataFrame, a, b, out: str) -> DataFrame:
    """Adds ``out`` = word_similarity(a, b): the JVM builds both trigram arrays, then one
    ``mapInPandas`` pass runs the linear run search over Arrow batches."""
    tmp_a, tmp_b = f"__{out}_a", f"__{out}_b"
    staged = df.select("*", trigram_set(a).alias(tmp_a), trigram_list(b).alias(tmp_b))
    return add_run_similarity(staged, [(tmp_a, tmp_b, out)]).drop(tmp_a, tmp_b)


# A task's memo of scored pairs is emptied at about this size.
MEMO_BYTES, MEMO_ENTRY = 16 << 20, 400


def add_run_similarity(df: DataFrame, specs: list) -> DataFrame:
    """For each (set column, list column, out) adds ``out`` = best run similarity, per row."""
    outs = [o for _, _, o in specs]
    schema = StructType(list(df.schema.fields) + [StructField(o, DoubleType()) for o in outs])

    def key(v):
        """Codes as their bytes (a tuple of Python integers takes five times as much)."""
        if v is None or len(v) == 0:
            return b""
        return v.tobytes() if getattr(v, "dtype", None) == "int64" else tuple(v)

    def run(batches):
        memo: dict = {}  # repeated (term, text) pairs are scored once while the memo holds them
        held = 0
        for pdf in batches:
            for a, b, o in specs:
                vals = []
                for x, y in zip(pdf[a], pdf[b]):
                    pair = (key(x), key(y))
                    v = memo.get(pair)
                    if v is None:
                        v = best_extent_similarity(x, y)
                        held += MEMO_ENTRY + 16 * (len(x if x is not None else ()) + len(y if y is not None else ()))
                        if held > MEMO_BYTES:
                            memo.clear()
                            held = 0
                        memo[pair] = v
                    vals.append(v)
                pdf[o] = vals
            yield pdf

    return df.mapInPandas(run, schema)


_WORDS = None


def _words(text: str) -> list:
    global _WORDS
    if _WORDS is None:
        import regex

        _WORDS = regex.compile(r"[\p{L}\p{N}]+")
    return _WORDS.findall(text)


def py_trigram_list(text, fold_upper: bool = False) -> list:
    """The same rules in Python, for Arrow batches (identical to ``trigram_list``)."""
    if text is None:
        return []
    t = text.upper().lower() if fold_upper else text.lower()
    out = []
    for w in _words(t):
        p = "  " + w + " "
        out.extend(p[i:i + 3] for i in range(len(w) + 1))
    return out


def py_trigram_set(text, fold_upper: bool = False) -> list:
    if text is None:
        return []
    t = text.upper().lower() if fold_upper else text.lower()
    out = set()
    for w in set(_words(t)):
        p = "  " + w + " "
        out.update(p[i:i + 3] for i in range(len(w) + 1))
    return list(out)


def _code(g: str) -> int:
    """A trigram as one integer: three code points (< 2**21 each) in 63 bits, no collisions."""
    return (ord(g[0]) << 42) | (ord(g[1]) << 21) | ord(g[2])


def py_trigram_codes(text, fold_upper: bool = False) -> list:
    return [_code(g) for g in py_trigram_set(text, fold_upper)]


def py_trigram_code_list(text, fold_upper: bool = False) -> list:
    return [_code(g) for g in py_trigram_list(text, fold_upper)]


PART_CHARS = 1 << 18  # characters of text whose codes a task holds at once
SHORT = 100


def with_trigram_codes(df: DataFrame, specs: list, fold_upper: bool = False) -> DataFrame:
    """Adds, per (text column, out, ordered), the text's trigrams as array<bigint> codes: the
    distinct set, or the ordered list with repeats when ``ordered``. Joins and intersections
    on these run on primitive longs instead of strings."""
    from pyspark.sql.types import ArrayType, LongType

    schema = StructType(list(df.schema.fields) + [StructField(o, ArrayType(LongType())) for _, o, _ in specs])

    def run(batches):
        import numpy as np

        from .text_windows import trigram_places

        def codes(text, ordered):
            if text is None or len(text) < SHORT:  # below, a call of numpy costs more than the text
                return (py_trigram_code_list if ordered else py_trigram_codes)(text, fold_upper)
            if fold_upper:
                text = text.upper()
            places = trigram_places(text)
            return places if ordered else np.unique(places)

        for pdf in batches:
            size = sum(pdf[c].str.len().fillna(0).to_numpy("int64") for c, *_ in specs)
            # a batch of long texts is handed back in parts, as its codes take eight bytes a character
            part = (size.cumsum() // PART_CHARS) if len(pdf) else size
            for _, some in pdf.groupby(part, sort=False):
                yield some.assign(**{o: [codes(x, ordered) for x in some[c]] for c, o, ordered in specs})

    return df.mapInPandas(run, schema)


def previous_places(codes):
    """Distinct codes, each place's index among them, and the place where its code stood before (-1: nowhere)."""
    import numpy as np

    distinct, inverse = np.unique(codes, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    prev = np.full(len(codes), -1, np.int64)
    same = inverse[order[1:]] == inverse[order[:-1]]
    prev[order[1:][same]] = order[:-1][same]
    return distinct, inverse, prev
