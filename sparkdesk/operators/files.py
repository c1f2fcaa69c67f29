"""File-set operators over manifests and contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The formats the image/PDF reader accepts, and friendly file types.
ACCEPTED_MIME = ("image/jpeg", "image/png", "image/webp", "image/gif", "application/pdf")
FRIENDLY_TYPES = {
    "spreadsheet": "application/vnd.google-apps.spreadsheet",
    "doc": "application/vnd.google-apps.document",
    "slides": "application/vnd.google-apps.presentation",
    "pdf": "application/pdf",
    "pdfs": "application/pdf",
}
LIST_PAGE = 100
# Candidate locations of a relative file, in the order they are tried.
LOCATION_PREFIXES = ("/app", "..", "")


class FileTypeError(ValueError):
    pass


SNIFF_BYTES = 12  # what sniff_mime looks at


def sniff_mime(content) -> Column:
    """Type from the leading bytes; unknown → null."""
    c = F.col(content) if isinstance(content, str) else content
    h = F.hex(F.substring(c, 1, SNIFF_BYTES))
    return (F.when(h.startswith("FFD8FF"), F.lit("image/jpeg"))
            .when(h.startswith("89504E470D0A1A0A"), F.lit("image/png"))
            .when(h.startswith("474946383761") | h.startswith("474946383961"), F.lit("image/gif"))
            .when(h.startswith("52494646") & (F.substring(h, 17, 8) == "57454250"), F.lit("image/webp"))
            .when(h.startswith("25504446"), F.lit("application/pdf"))
            .when(h.startswith("504B0304"), F.lit("application/zip"))
            .when(h.startswith("1F8B"), F.lit("application/gzip"))
            .when(h.startswith("425A68"), F.lit("application/x-bzip2")))


def route_by_type(files: DataFrame, content: str = "content") -> DataFrame:
    """(path, mime, accepted) per file."""
    mime = sniff_mime(content)
    return files.select("path", mime.alias("mime"),
                        F.coalesce(mime.isin(*ACCEPTED_MIME), F.lit(False)).alias("accepted"))


def routing_summary(routed: DataFrame) -> DataFrame:
    return routed.groupBy("mime").agg(F.count(F.lit(1)).alias("n_files"),
                                      F.count(F.when(F.col("accepted"), 1)).alias("n_accepted"))


def to_base64(c) -> Column:
    """E5: bytes (or text as UTF-8) → base64 text on one line (Spark's encoder may wrap lines)."""
    return F.regexp_replace(F.base64(c), r"[\r\n]", "")


def from_base64(c) -> Column:
    """E5: base64 text → bytes; invalid input gives null, missing padding is accepted."""
    return F.try_to_binary(F.col(c) if isinstance(c, str) else c, F.lit("base64"))


def first_existing(requests: DataFrame, manifest: DataFrame, req_col: str = "request",
                   prefixes: tuple = LOCATION_PREFIXES) -> DataFrame:
    """For each requested relative path, the first candidate location that exists.

    Candidates are exploded with their rank, equi-joined to the manifest, and the lowest rank
    kept with a partial aggregate. Requests without a hit stay, with null.
    """
    cands = requests.select(req_col, F.posexplode(F.array(*[F.concat(F.lit(p), F.col(req_col))
                                                            for p in prefixes])).alias("rank", "candidate"))
    hits = cands.join(manifest.select(F.col("path").alias("candidate")).distinct(), "candidate")
    best = hits.groupBy(req_col).agg(F.min(F.struct("rank", "candidate")).alias("b"))
    return (requests.select(req_col).distinct().join(best, req_col, "left")
            .select(req_col, F.col("b.candidate").alias("found"), F.col("b.rank").alias("rank")))


def list_by_type(manifest: DataFrame, friendly: str, mime_col: str = "mime", name_col: str = "name",
                 page: int = LIST_PAGE, start: int = 0) -> DataFrame:
    """Friendly type → mime (unknown → error); ``page`` files by name from row ``start`` on."""
    mime = FRIENDLY_TYPES.get(friendly.lower())
    if mime is None:
        raise FileTypeError(f"Unsupported file type: {friendly}")
    return manifest.filter(F.col(mime_col) == mime).orderBy(name_col, "path").offset(start).limit(page)


def idle_records(events: DataFrame, key: str, ts: str, now: Column, idle: str = "1 hour") -> DataFrame:
    """Last activity per key; expired when there is none or it is older than ``idle``."""
    last = events.groupBy(key).agg(F.max(ts).alias("last_ts"))
    cutoff = now - F.expr(f"INTERVAL {idle}")
    return last.withColumn("expired", F.col("last_ts").isNull() | (F.col("last_ts") < cutoff))
