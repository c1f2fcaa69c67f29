"""BPE encoding by forced boundaries, and decoding.

Two neighbouring symbols that stand next to each other inside no vocabulary token can never end up
in one token, so a cut between them is certain. Each pre-token falls into fragments at these cuts;
fragments are merged independently (and remembered), and the results are concatenated.

Defined results: a null text is empty (no ids, decoded text ""); special strings inside a text give
their own id; rows are independent, so ties, repeats, null ids and extra columns change nothing.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Splitter, byte_symbols, load_model, merge, with_classes
from .common import Memo

# Fixed value: the pre-token pattern of the word-level vocabulary, with the class names to fill in.
WORD_LEVEL = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"


def symbols_of(token: str, suffix: str) -> list[str]:
    """The unmerged symbols of a vocabulary string; the word-end mark belongs to the last one."""
    if suffix and token.endswith(suffix) and len(token) > len(suffix):
        body = token[:-len(suffix)]
        return [*body[:-1], body[-1] + suffix]
    return list(token)


@functools.lru_cache(maxsize=4)
def inner_pairs(path: str) -> tuple[frozenset[str], frozenset[str]]:
    """Neighbouring symbols inside at least one vocabulary token: plain pairs, and pairs whose second
    symbol carries the word-end mark (written without it)."""
    model = load_model(path)
    plain, final = set(), set()
    for token in model["vocab"]:
        parts = symbols_of(token, model["suffix"])
        for a, b in zip(parts, parts[1:], strict=False):
            if len(b) > 1:
                final.add(a + b[0])
            else:
                plain.add(a + b)
    return frozenset(plain), frozenset(final)


def fragments(word: str, plain, final) -> list[str]:
    """A word's symbols cut wherever two neighbours occur inside no token."""
    out, start, last = [], 0, len(word) - 1
    for i in range(1, last + 1):
        if word[i - 1:i + 1] not in (plain if i < last else final):
            out.append(word[start:i])
            start = i
    out.append(word[start:])
    return out


@functools.lru_cache(maxsize=4)
def normalizer_of(path: str):
    """The file's normalizer alone, without its vocabulary."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as fh:
        spec = json.load(fh)
    bare = {"version": "1.0", "added_tokens": [], "normalizer": spec["normalizer"], "pre_tokenizer": None, "post_processor": None, "decoder": None,
            "truncation": None, "padding": None, "model": {"type": "BPE", "vocab": {}, "merges": []}}
    return Tokenizer.from_str(json.dumps(bare)).normalizer


class Encoder:
    """Ids and decoded text of one text, as the library gives them for this file."""

    def __init__(self, path: str, patterns, inside):
        model = load_model(path)
        self.vocab, self.ranks, self.suffix = model["vocab"], model["ranks"], model["suffix"]
        self.specials = model["specials"]
        self.splitter = Splitter(patterns, self.specials)
        self.normalizer = normalizer_of(path)  # Unicode normal form, spaces, lower case
        self.beyond_latin = re.compile("[^\x00-\u024f]")
        self.unusual = re.compile("[^\t-\r -~\u00a1-\u00ac\u00ae-\u024f]")  # or white space that str.split sees otherwise
        self.plain, self.final = inside
        self.final = self.final if self.suffix else self.plain
        names = {i: t for t, i in [*self.vocab.items(), *self.specials.items()]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.inner = Memo(lambda f: self._ids(list(f)), 100_000)
        self.ending = Memo(lambda f: self._ids([*f[:-1], f[-1] + self.suffix]), 100_000)
        self.words = Memo(self._word, 100_000)
        self.chunks = Memo(self._chunk, 100_000)

    def _ids(self, symbols: list[str]) -> tuple[int, ...]:
        return tuple(self.vocab[t] for t in merge(symbols, self.ranks))

    def _word(self, pretoken: str) -> tuple[int, ...]:
        parts = fragments(byte_symbols(pretoken), self.plain, self.final)
        last = self.ending[parts.pop()]
        return (*(i for f in parts for i in self.inner[f]), *last) if parts else last

    def normalized(self, text: str) -> str:
        """Text without characters beyond Latin is in normal form already, and lower() agrees there."""
        if text.isascii() or self.beyond_latin.search(text) is None:
            return text.lower()
        return self.normalizer.normalize_str(text)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(itertools.chain.from_iterable(map(self.words.__getitem__, self.splitter.pretokens(chunk))))

    def encode(self, text: str) -> list[int]:
        if self.unusual.search(text) is None and (self.splitter.special is None or self.splitter.special.search(text) is None):
            # pre-tokens never span white space: what stands between it is looked up whole
            return list(itertools.chain.from_iterable(map(self.chunks.__getitem__, text.lower().split())))
        ids: list[int] = []
        for special, part in self.splitter.segments(text):
            if special:
                ids.append(self.specials[part])
            else:
                words = self.splitter.pretokens(self.normalized(part))
                ids += itertools.chain.from_iterable(map(self.words.__getitem__, words))
        return ids

    def decode(self, ids) -> str:
        """The token strings joined by a space (the file names no decoder)."""
        return " ".join(map(self.names.__getitem__, ids))


def bpe(spark: SparkSession, text: Column, path: str) -> Column:
    """struct(ids array<int>, decoded string) of a text column."""
    shipped = spark.sparkContext.broadcast((with_classes(WORD_LEVEL), inner_pairs(path)))

    @F.pandas_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, *shipped.value)
        for texts in batches:
            ids = [encoder.encode(t) if t else [] for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [encoder.decode(x) for x in ids]})

    return run(text)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, decoded for every row."""
    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.select(key, bpe(docs.sparkSession, F.col("_text"), path).alias("_r")).select(key, "_r.ids", "_r.decoded")


def encoding_digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256. Ids and decoded texts are hashed one by one where they are made."""
    shipped = docs.sparkSession.sparkContext.broadcast((with_classes(WORD_LEVEL), inner_pairs(path)))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, *shipped.value)
        decimal = list(map(str, range(len(encoder.names))))
        for texts in batches:
            out = []
            for t in texts:
                ids = encoder.encode(t) if t else []
                out.append((len(ids), hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                            hashlib.sha256(encoder.decode(ids).encode()).hexdigest()))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.select(key, run("_text").alias("_r")).select(key, "_r.n_tokens", "_r.ids_sha256", "_r.decoded_sha256")
