"""Plain trigram similarity of many texts against many terms, counted in one pass over the texts.

The terms' trigram sets are kept as lists (for each trigram, the terms that have it). The trigrams of a group of texts are made
in one go, sorted text by text, and their lists added up: that gives the shared count of every (text, term) pair at once.
A text with more than ``most`` distinct trigrams can't reach the threshold of any term, and a beginning of a text, cut at a blank, has
no more distinct trigrams than the whole: long texts are looked at in growing beginnings, to the end only while they may still pass.
"""

from __future__ import annotations

import numpy as np

from .text_windows import word_trigrams

GROUP_CHARS = 1 << 16  # characters of text counted together
PAIRS = 1 << 21  # (text, term) counts held at once
DENSE = 1 << 22  # trigrams times terms up to which the lists are a matrix


class TermLists:
    """Distinct trigram codes of all terms and, for each, the numbers of the terms that have it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        codes = np.concatenate([np.asarray(s, np.int64) for s in sets]) if sets else np.zeros(0, np.int64)
        order = np.argsort(codes, kind="stable")
        self.terms = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.vocab, self.first, self.count = np.unique(codes[order], return_index=True, return_counts=True)
        self.has = None
        if len(self.vocab) * len(sets) <= DENSE:
            self.has = np.zeros((len(self.vocab), len(sets)), np.float32)
            self.has[np.repeat(np.arange(len(self.vocab)), self.count), self.terms] = 1.0

    def shared(self, codes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        """Shared counts, texts by terms, of distinct codes that belong to the texts given with them."""
        at = np.minimum(np.searchsorted(self.vocab, codes), len(self.vocab) - 1)
        known = self.vocab[at] == codes
        at, text = at[known], text[known]
        if self.has is not None:
            present = np.zeros((texts, len(self.vocab)), np.float32)
            present[text, at] = 1.0
            return present @ self.has
        size = self.count[at]
        place = np.arange(int(size.sum())) + np.repeat(self.first[at] - np.cumsum(size) + size, size)
        pairs = np.repeat(text * len(self.sizes), size) + self.terms[place]
        return np.bincount(pairs, minlength=texts * len(self.sizes)).reshape(texts, len(self.sizes))


def distinct_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigram codes of lower-cased texts, text by text, and the number of the text for each."""
    codes, count = word_trigrams(texts)
    first = np.cumsum(count) - count
    for a, b in zip(first.tolist(), (first + count).tolist(), strict=True):
        codes[a:b].sort()
    new = np.append(True, codes[1:] != codes[:-1])[:len(codes)]
    new[first[count > 0]] = True
    return codes[new], np.repeat(np.arange(len(texts)), count)[new]


def _beginning(text: str, size: int) -> str:
    """At least ``size`` characters, up to a blank: no word is cut, and the lower case of what comes before doesn't depend on the rest."""
    at = text.find(" ", size)
    return text if at < 0 else text[:at]


def reaching_counts(texts: list, lists: TermLists, most: float, fold_upper: bool = False):
    """(numbers of texts, their distinct trigrams, shared counts by terms) in parts; texts without trigrams or with more than
    ``most`` distinct ones are left out."""
    group = max(1, PAIRS // max(len(lists.sizes), 1))
    size, open_ = max(int(4 * most), 256), np.array([i for i, t in enumerate(texts) if t], np.int64)
    while len(open_):
        chars = np.array([min(len(texts[i]), size) for i in open_])
        part = np.maximum.accumulate(np.maximum(np.cumsum(chars) // GROUP_CHARS, np.arange(len(open_)) // group))
        longer = []
        for some in np.split(open_, np.flatnonzero(np.diff(part)) + 1):
            begun = [_beginning(texts[i], size) for i in some.tolist()]
            whole = np.array([len(b) == len(texts[i]) for b, i in zip(begun, some.tolist(), strict=True)])
            codes, owner = distinct_codes([(b.upper() if fold_upper else b).lower() for b in begun])
            n_b = np.bincount(owner, minlength=len(some))
            longer.append(some[~whole & (n_b <= most)])
            keep = whole & (n_b > 0) & (n_b <= most)
            if keep.any():
                number = np.cumsum(keep) - 1
                mine = keep[owner]
                yield some[keep], n_b[keep], lists.shared(codes[mine], number[owner[mine]], int(keep.sum()))
        open_, size = np.concatenate(longer), size * 4


class Reaching:
    """Which rows can be among the ``k`` best of some term, as far as the rows seen until now tell."""

    def __init__(self, lists: TermLists, min_pct: float, k: int):
        self.lists, self.k, self.low = lists, k, min_pct
        self.most = lists.sizes.max(initial=0) / (min_pct / 100.0) + 1e-6
        self.best = np.full((len(lists.sizes), k), -np.inf)  # each term's k best scores, ascending

    def rows(self, columns: list[list], fold_upper: bool = False) -> np.ndarray:
        """Numbers of the rows, ascending, whose best column scores over the threshold and not below a term's k-th best score."""
        found = []
        for texts in columns:
            for rows, n_b, shared in reaching_counts(texts, self.lists, self.most, fold_upper):
                score = shared / (self.lists.sizes + n_b[:, None] - shared.astype(np.float64)) * 100.0
                r, term = np.nonzero(score >= np.maximum(self.low - 1e-9, self.best[:, 0]))
                found.append((rows[r], term, score[r, term]))
        if not found:
            return np.zeros(0, np.int64)
        row, term, score = (np.concatenate(x) for x in zip(*found, strict=True))
        # a row counts once for a term, with its best column
        order = np.lexsort((-score, row, term))
        row, term, score = row[order], term[order], score[order]
        first = np.append(True, (row[1:] != row[:-1]) | (term[1:] != term[:-1]))[:len(row)]
        row, term, score = row[first], term[first], score[first]
        order = np.lexsort((-score, term))
        row, term, score = row[order], term[order], score[order]
        rank = np.arange(len(term)) - np.searchsorted(term, term)
        top = rank < self.k
        mine = np.full(self.best.shape, -np.inf)
        mine[term[top], rank[top]] = score[top]
        self.best = np.sort(np.concatenate([self.best, mine], axis=1), axis=1)[:, -self.k:]
        return np.unique(row[score >= self.best[term, 0]])
