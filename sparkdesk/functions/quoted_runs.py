"""Runs of texts that quote a term, found by equal stretches of trigrams.

A cheap way to lower bounds of word similarity: where ``SPAN`` trigrams in a row are those of a term, the run that lies over the term in
the same alignment is scored exactly. A score of one run is no more than the text's word similarity, whatever the stretch was worth.
"""

from __future__ import annotations

import numpy as np

from .text_windows import trigram_places, word_trigrams

SPAN = 16  # trigrams in a row, a power of two
TABLE_BITS = 20
TERMS_A_STRETCH = 16  # terms that are tried for one stretch


def stretch_keys(codes: np.ndarray) -> np.ndarray:
    """A 64-bit key of the SPAN codes from each place on (equal keys of unequal codes only cost a useless try)."""
    key = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    size = 1
    while size < SPAN:
        key = key[:-size] * np.uint64(0xBF58476D1CE4E5B9) + key[size:] if len(key) > size else key[:0]
        key ^= key >> np.uint64(31)
        size *= 2
    return key


class Quotes:
    """Stretches of all terms: key, term and place in the term."""

    def __init__(self, terms: list[str]):
        places = [trigram_places(t) for t in terms]
        self.lengths, self.sets = [len(p) for p in places], [np.unique(p) for p in places]
        keys = [stretch_keys(p) for p in places]
        key = np.concatenate([np.zeros(0, np.uint64), *keys])
        term = np.repeat(np.arange(len(terms)), [len(k) for k in keys])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(k)) for k in keys)])
        order = np.lexsort((place, term, key))
        key, term, place = key[order], term[order], place[order]
        first = np.append(True, (key[1:] != key[:-1]) | (term[1:] != term[:-1]))[:len(key)]  # a term's first stretch of a kind
        key, self.term, self.place = key[first], term[first], place[first]
        self.keys, self.first, self.count = np.unique(key, return_index=True, return_counts=True)
        self.count = np.minimum(self.count, TERMS_A_STRETCH)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.keys >> np.uint64(64 - TABLE_BITS)] = True

    def scores(self, texts: list[str]) -> list[tuple[int, int, float]]:
        """(text, term, score of one run) for lower-cased texts, one for each pair that has an equal stretch."""
        codes, count = word_trigrams(texts)
        key, ends = stretch_keys(codes), np.cumsum(count)
        at = np.flatnonzero(self.table[key >> np.uint64(64 - TABLE_BITS)])
        found = np.minimum(np.searchsorted(self.keys, key[at]), max(len(self.keys) - 1, 0))
        same = self.keys[found] == key[at] if len(self.keys) else np.zeros(len(at), bool)
        at, found = at[same], found[same]
        size = self.count[found]
        entry = np.arange(int(size.sum())) + np.repeat(self.first[found] - np.cumsum(size) + size, size)
        at = np.repeat(at, size)
        text, term, begin = np.searchsorted(ends, at, side="right"), self.term[entry], at - self.place[entry]
        order = np.lexsort((begin, term, text))
        text, term, begin = text[order], term[order], begin[order]
        new = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(term) != 0) | (np.diff(begin) != 0))[:len(text)])
        votes = np.diff(np.append(new, len(text)))
        best: dict = {}  # the alignment with most equal stretches
        for i, n in zip(new.tolist(), votes.tolist(), strict=True):
            pair = int(text[i]), int(term[i])
            if n > best.get(pair, (0, 0))[0]:
                best[pair] = n, int(begin[i])
        out = []
        for (i, j), (_, start) in best.items():
            run = np.unique(codes[max(start, int(ends[i] - count[i])):min(start + self.lengths[j], int(ends[i]))])
            shared = len(np.intersect1d(run, self.sets[j], assume_unique=True))
            out.append((i, j, shared / (len(self.sets[j]) + len(run) - shared)))
        return out
