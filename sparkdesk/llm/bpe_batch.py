"""Encoding of whole batches of texts in numpy: pre-tokens are found, numbered and merged as arrays, without a Python object each.

A batch is one byte array. Byte classes give the pre-token starts; equal pre-tokens get one number (by a 64-bit
hash, and all their bytes are compared, so a collision is noticed); those not met before are merged together. Texts with characters
outside the plain range, or with special strings, go through `Encoder` one by one.
"""

from __future__ import annotations

import functools

import numpy as np

from .bpe import byte_alphabet, load_model, unicode_classes
from .common import mix64
from .encoding import Encoder

NONE = np.iinfo(np.int64).max
SPACE, LETTER, NUMBER, OTHER, INSIDE = range(5)
TOP = 0x250  # first code point beyond the plain range
CONTRACTED = {"s": 1, "t": 1, "m": 1, "d": 1, "re": 2, "ve": 2, "ll": 2}  # fixed value: endings of the word-level pattern


@functools.lru_cache(maxsize=2)
def merge_table(path: str) -> dict:
    """Ids of the 256 bytes, inside a word and at its end, and the merges as sorted (pair, rank, merged id)."""
    model = load_model(path)
    vocab, suffix = model["vocab"], model["suffix"]
    size = max(vocab.values()) + 1
    left, right, made = (np.array([vocab[x] for x in col], np.int64) for col in zip(*[(a, b, a + b) for a, b in model["ranks"]], strict=True))
    pair = left * size + right
    order = np.argsort(pair)
    return {"inside": np.array([vocab[c] for c in byte_alphabet()], np.int64), "ending": np.array([vocab[c + suffix] for c in byte_alphabet()], np.int64),
            "size": size, "pair": pair[order], "rank": np.fromiter(model["ranks"].values(), np.int64)[order], "made": made[order]}


def merge_words(data: np.ndarray, size: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids one word after another, number of ids per word) of words given as joined bytes and byte lengths.

    A round merges, in every word, the pair of lowest rank at all its places from the left; finished words leave."""
    t = merge_table(path)
    of, last = np.repeat(np.arange(len(size)), size), np.cumsum(size) - 1
    ids = t["inside"][data]
    ids[last] = t["ending"][data[last]]
    done_ids, done_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(ids):
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        pair = np.append(ids[:-1] * t["size"] + ids[1:], -1)
        at = np.minimum(np.searchsorted(t["pair"], pair), len(t["pair"]) - 1)
        rank = np.where(t["pair"][at] == pair, t["rank"][at], NONE)
        rank[np.append(first[1:], len(ids)) - 1] = NONE  # the last symbol of a word has no right neighbour
        span = np.diff(first, append=len(ids))
        least = np.repeat(np.minimum.reduceat(rank, first), span)
        done = least == NONE
        done_ids.append(ids[done])
        done_of.append(of[done])
        run = np.flatnonzero((rank == least) & ~done)
        if len(run):  # of pairs that overlap ("aaa") every second one
            fresh = np.append(True, np.diff(run) > 1)
            run = run[(run - run[np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))]) % 2 == 0]
            ids[run] = t["made"][at[run]]
        stay = ~done
        stay[run + 1] = False
        ids, of = ids[stay], of[stay]
    of = np.concatenate(done_of)
    return np.concatenate(done_ids)[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(size))


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for size[0] entries, then the same for the next."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


@functools.lru_cache(maxsize=1)
def point_classes() -> np.ndarray:
    out = np.full(TOP, OTHER, np.uint8)
    for name, kind in (("L", LETTER), ("N", NUMBER), ("S", SPACE)):
        for a, b in unicode_classes()[name]:
            out[a:min(b, TOP - 1) + 1] = kind
    return out


def pretoken_starts(b: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the pre-tokens of lower-case plain UTF-8 bytes."""
    kind = classes[np.minimum(b, 127)]
    lead = np.flatnonzero(b >= 0xC0)
    kind[lead] = classes[((b[lead] & 0x1F).astype(np.int32) << 6) | (b[lead + 1] & 0x3F)]
    kind[lead + 1] = kind[lead]
    begin = np.append(True, kind[1:] != kind[:-1]) | (kind == NUMBER)
    begin[lead + 1] = False
    quote = np.flatnonzero((b == 39) & begin)
    quote = quote[quote + 1 < len(b)]
    for ending, n in CONTRACTED.items():
        here = quote[(quote + n < len(b))]
        for k, ch in enumerate(ending):
            here = here[b[here + 1 + k] == ord(ch)]
        begin[here + 1] = False
        after = here[here + 1 + n < len(b)] + 1 + n
        begin[after] = kind[after] != SPACE
    begin &= kind != SPACE
    start = np.flatnonzero(begin)
    gap = np.flatnonzero((kind[1:] == SPACE) & (kind[:-1] != SPACE)) + 1  # ends before white space
    bound = np.append(start[1:], len(b))
    nearest = np.append(gap, len(b))[np.searchsorted(gap, start, side="right")]
    return start, np.minimum(bound, nearest) - start


class BatchEncoder(Encoder):
    """Encodes lists of texts and keeps up to ``limit`` pre-tokens it has met."""

    limit = 500_000

    def __init__(self, path: str, patterns, inside, classes: np.ndarray):
        super().__init__(path, patterns, inside)
        self.path, self.classes = path, classes
        salt = np.random.default_rng(7)
        self.of_byte, self.of_place = (salt.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (256, 64))
        self.forget()

    def forget(self):
        self.hashes, self.at, self.count, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.text, self.text_at, self.text_size = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray | None:
        """The known number of each pre-token, after learning the new ones; None if two different ones share a hash."""
        flat = data[spread(start, size)]
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        key = mix64(np.add.reduceat(self.of_byte[flat] * self.of_place[place & 63], np.cumsum(size) - size))
        uniq, one, inverse = np.unique(key, return_index=True, return_inverse=True)
        if not ((size == size[one][inverse]).all() and np.array_equal(flat, data[spread(start[one][inverse], size)])):
            return None
        if len(self.hashes) + len(uniq) > self.limit:
            self.forget()
        place = np.minimum(np.searchsorted(self.hashes, uniq), max(len(self.hashes) - 1, 0))
        known = self.hashes[place] == uniq if len(self.hashes) else np.zeros(len(uniq), bool)
        a, b = place[known], one[known]
        if not ((self.text_size[a] == size[b]).all() and np.array_equal(self.text[spread(self.text_at[a], self.text_size[a])], data[spread(start[b], size[b])])):
            return None
        new = one[~known]
        if len(new):
            said = data[spread(start[new], size[new])]
            ids, count = merge_words(said, size[new], self.path)
            merged = np.append(self.hashes, uniq[~known])
            order = np.argsort(merged, kind="stable")
            self.at = np.append(self.at, len(self.pool) + np.cumsum(count) - count)[order]
            self.count = np.append(self.count, count)[order]
            self.text_at = np.append(self.text_at, len(self.text) + np.cumsum(size[new]) - size[new])[order]
            self.text_size = np.append(self.text_size, size[new])[order]
            self.hashes, self.pool, self.text = merged[order], np.append(self.pool, ids.astype(np.int32)), np.append(self.text, said)
        return np.searchsorted(self.hashes, uniq)[inverse]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        special = self.splitter.special
        lower = {k: t.lower() for k, t in enumerate(texts) if self.unusual.search(t) is None and (special is None or special.search(t) is None)}
        lower = {k: t for k, t in lower.items() if t.isascii() or self.unusual.search(t) is None}  # some letters' lower case lies beyond
        out: list = [None] * len(texts)
        parts = [t.encode() + b"\n" for t in lower.values()]
        data = np.frombuffer(b"".join(parts), np.uint8)
        start, size = pretoken_starts(data, self.classes) if len(data) else (np.zeros(0, np.int64),) * 2
        number = self.numbers(data, start, size) if len(start) else np.zeros(0, np.int64)
        if number is not None:
            count = self.count[number]
            ids = self.pool[spread(self.at[number], count)]
            ends = np.cumsum([len(p) for p in parts])
            cut = np.append(0, np.cumsum(count))[np.searchsorted(start, np.append(0, ends))] if len(parts) else []
            for j, k in enumerate(lower):
                out[k] = ids[cut[j]:cut[j + 1]]
        return [np.array(self.encode(t), np.int32) if x is None else x for t, x in zip(texts, out, strict=True)]


_ENCODERS: dict = {}


def batch_encoder(path: str, *shipped) -> BatchEncoder:
    """One encoder per worker process: what it has learnt serves the next task too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path, *shipped)
    return _ENCODERS[path]
