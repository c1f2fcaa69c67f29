"""Scalar text functions as column expressions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords the SQL guard rejects when contained anywhere in the text, in this order.
GUARD_KEYWORDS = ["drop", "delete", "truncate", "alter", "create", "insert", "update", "grant", "revoke",
                  "exec", "execute", "sp_", "xp_"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def score_text(score) -> Column:
    """Score at 4 decimals, half-up, with a '%' suffix; null → 0."""
    s = F.coalesce(_c(score).cast("double"), F.lit(0.0))
    return F.concat(s.cast("decimal(10,4)").cast("string"), F.lit("%"))


def safe_name(name) -> Column:
    """Every character that is not a letter, digit, '_' or '-' becomes '_'."""
    return F.regexp_replace(_c(name), r"[^\p{L}\p{N}_-]", "_")


def url_file_name(url, is_text: Column | None = None) -> Column:
    """Last segment of the URL path; 'downloaded_file' when empty; '.txt' appended to a
    text download whose name has no extension."""
    path = F.coalesce(F.regexp_extract(_c(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit(""))
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    name = F.when(base == "", F.lit("downloaded_file")).otherwise(base)
    if is_text is None:
        return name
    # an extension as os.path.splitext sees it: a last dot-part after a non-dot character
    has_ext = name.rlike(r"^\.*[^.].*\.[^.]*$")
    return F.when(is_text & ~has_ext, F.concat(name, F.lit(".txt"))).otherwise(name)


def normalised_query(q) -> Column:
    """lower(strip(q)): surrounding whitespace of any kind removed, as a Python strip() does."""
    return F.lower(F.regexp_replace(_c(q), r"^\s+|\s+$", ""))


def guard_first_keyword(q) -> Column:
    """First guard keyword (in list order) contained in lower(strip(q)), else null."""
    low = normalised_query(q)
    out = F.lit(None).cast("string")
    for kw in reversed(GUARD_KEYWORDS):
        out = F.when(F.instr(low, kw) > 0, F.lit(kw)).otherwise(out)
    return out


def guard_first_word_keyword(q) -> Column:
    """A9 whole-word variant: the same keywords, matched only as whole words."""
    low = normalised_query(q)
    out = F.lit(None).cast("string")
    alts = []
    for kw in reversed(GUARD_KEYWORDS):
        end = "" if kw.endswith("_") else r"($|[^a-z0-9_])"  # sp_ / xp_ are name prefixes
        out = F.when(low.rlike(r"(^|[^a-z0-9_])" + kw + end), F.lit(kw)).otherwise(out)
        alts.append(kw)
    # one scan decides whether any keyword occurs at all; the ordered checks run only then
    anywhere = "|".join(sorted(alts, key=len, reverse=True))
    return F.when(low.rlike(f"({anywhere})"), out)


def guard_allows(q) -> Column:
    """A9 substring verdict: no keyword contained and the text starts with 'select'."""
    low = normalised_query(q)
    return guard_first_keyword(q).isNull() & low.startswith("select")


def guard_allows_whole_word(q) -> Column:
    low = normalised_query(q)
    return guard_first_word_keyword(q).isNull() & low.startswith("select")


def statement_kind(q) -> Column:
    """First word of the statement, lower case."""
    return F.regexp_extract(normalised_query(q), r"^([a-z]+)", 1)
