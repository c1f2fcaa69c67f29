"""Word similarity of many terms against long texts by a sliding-window count filter.

A run of a text with d distinct trigrams that shares x of a term's n scores x / (n + d - x). The text is cut into blocks of
``BLOCK`` trigram places. For every rung u of a ladder of sizes, all runs with u <= d < 1.05 u that start in a block lie inside one window:
the places from the block's start until 1.05 u + BLOCK distinct trigrams are reached. The window's trigrams, counted against a
term, give x at most, so c / (n + u - c) bounds these runs. Two steps: windows of ``WIDE`` blocks and ``RUNGS`` rungs at once are counted
for all terms as one matrix product; single blocks and rungs only where that count reaches the term's floor, as bits. Only blocks whose
bound reaches the floor are scored exactly. The bound never falls below a score, so nothing is lost.
"""

from __future__ import annotations

import functools

import numpy as np

from .trigram import previous_places

BLOCK, RATIO = 8, 1.05
WIDE, RUNGS = 2, 2  # blocks and rungs that are counted together first
SCORED = 4  # neighbouring blocks whose runs are scored together
COARSE = 16  # wide blocks that are counted together before them
PRESENT = 1 << 20  # texts times trigrams counted against all terms at once
ENDS = 1 << 18  # places looked at together for the ends of windows
WINDOWS, TRIPLES = 1 << 12, 1 << 16  # windows in one matrix product, (block, rung, term) counted as bits at once
LADDER = np.unique(np.floor(RATIO ** np.arange(0, 600)).astype(np.int64))


@functools.lru_cache(maxsize=1)
def word_points() -> np.ndarray:
    """True for the code points that belong to words."""
    import regex

    table = np.zeros(0x110000, bool)
    word = regex.compile(r"[\p{L}\p{N}]+")
    for start in range(0, len(table), 1 << 12):  # a little at a time: every worker makes the table
        points = "".join(chr(c) for c in range(start, start + (1 << 12)) if not 0xD800 <= c < 0xE000)
        table[np.frombuffer("".join(word.findall(points)).encode("utf-32-le"), np.uint32)] = True
    return table


def word_trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ordered trigram codes of lower-cased texts, one text after the other, and how many each text has."""
    joined = "\n".join(["", "", *texts, ""])  # a line end is in no word
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = word_points().take(points)
    points = np.where(inside, points, 32).astype(np.int64)
    codes = np.where(inside[1:-1], points[:-2], 32)  # before a word there are two blanks
    for later in (points[1:-1], points[2:]):
        codes <<= 21
        codes |= later
    some = inside[1:-1] | inside[2:]  # a trigram ends in a word or right behind one
    ends = np.cumsum([len(t) + 1 for t in texts])
    return codes[some], np.diff(np.cumsum(some)[ends - 1], prepend=0)


def trigram_places(text: str | None) -> np.ndarray:
    """The ordered trigram codes of a text (as ``py_trigram_code_list``)."""
    return word_trigrams([(text or "").lower()])[0]


class Text:
    """A text's trigram places, the places where each stood before, and its blocks."""

    def __init__(self, codes: np.ndarray):
        self.distinct, self.inverse, self.prev = previous_places(codes)
        self.n = len(codes)
        self.starts = np.arange(0, self.n, BLOCK)

    def window_ends(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For every start and size: the first place at which more than that many distinct trigrams are reached."""
        out = np.full((len(starts), len(sizes)), self.n, np.int64)
        open_, reach = np.arange(len(starts)), 2 * int(sizes[-1]) + BLOCK
        while len(open_):
            width = min(reach, self.n)
            before = np.lib.stride_tricks.sliding_window_view(np.pad(self.prev, (0, width), constant_values=self.n), width)
            longer = []
            for some in np.split(open_, range(step := max(1, ENDS // width), len(open_), step)):
                s = starts[some]
                new = before[s] < s[:, None]
                place, count = np.flatnonzero(new), np.count_nonzero(new, axis=1)
                at = np.minimum((np.cumsum(count) - count)[:, None] + sizes, max(len(place) - 1, 0))
                reached = sizes < count[:, None]
                out[some] = np.where(reached, place[at] - (np.arange(len(some)) * width - s)[:, None], self.n)
                longer.append(some[~reached[:, -1] & (s + width < self.n)])
            open_, reach = np.concatenate(longer), reach * 2
        return out


def union_spans(present: np.ndarray, longest: int) -> list[np.ndarray]:
    """spans[m][b]: what blocks b .. b + 2**m - 1 hold, for all that windows of ``longest`` blocks need."""
    spans = [present]
    while 2 ** len(spans) <= min(longest, len(present)):
        last, step = spans[-1], 2 ** (len(spans) - 1)
        joined = last.copy()
        joined[:-step] |= last[step:]
        spans.append(joined)
    return spans


def window_union(spans: list[np.ndarray], first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """What the blocks first .. stop - 1 hold, a row for each window."""
    level = np.log2(np.maximum(stop - first, 1)).astype(np.int64)
    out = np.empty((len(first), spans[0].shape[1]), spans[0].dtype)
    for m in np.unique(level).tolist():
        at = np.flatnonzero(level == m)
        out[at] = spans[m][first[at]] | spans[m][stop[at] - 2 ** m]
    return out


class TermBlock:
    """Some terms: their trigram sets as a 0/1 matrix over their joint vocabulary."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self.vocab = np.unique(np.concatenate(sets)) if len(sets) else np.zeros(0, np.int64)
        self.has = np.zeros((len(self.vocab), len(sets)), np.float32)
        for j, s in enumerate(sets):
            self.has[np.searchsorted(self.vocab, s), j] = 1.0

    def rows_of(self, text: Text) -> tuple[np.ndarray, np.ndarray]:
        """(matrix rows of the text's distinct trigrams that some term has, for each place its position among these or -1)."""
        at = np.minimum(np.searchsorted(self.vocab, text.distinct), len(self.vocab) - 1)
        known = self.vocab[at] == text.distinct
        number = np.where(known, np.cumsum(known) - 1, -1)
        return at[known], number[text.inverse]

    def reaching(self, codes: list[np.ndarray], floors: np.ndarray) -> list[np.ndarray]:
        """For each text, given by its trigram codes, the terms that share enough of their trigrams with it."""
        found, step = [], max(1, PRESENT // max(len(self.vocab), 1))
        for a in range(0, len(codes), step):
            some = codes[a:a + step]
            present = np.zeros((len(some), len(self.vocab) + 1), np.float32)  # the last place: trigrams of no term
            for row, c in zip(present, some, strict=True):
                at = np.minimum(np.searchsorted(self.vocab, c), len(self.vocab) - 1)
                row[np.where(self.vocab[at] == c, at, len(self.vocab))] = 1.0
            enough = present[:, :-1] @ self.has >= floors * self.sizes - 1e-3
            found += [np.flatnonzero(row) for row in enough]
        return found

    def windows(self, text: Text, floors: np.ndarray, some: np.ndarray | None = None) -> Windows | None:
        """The text against the terms (of ``some``) that share enough of their trigrams with it, with the rungs on which some can reach its floor."""
        rows, place = self.rows_of(text)
        cols = np.arange(len(self.sizes)) if some is None else some
        has = self.has[np.ix_(rows, cols)]
        enough = has.sum(axis=0) >= floors[cols] * self.sizes[cols] - 1e-3
        cols, has = cols[enough], has[:, enough]
        sizes, floors = self.sizes[cols], floors[cols]
        used = np.append(has.any(axis=1), False)  # trigrams of these terms only
        has, place = has[used[:-1]], np.where(used[place], np.cumsum(used)[place] - 1, -1)
        ladder = np.stack([LADDER[:-1], LADDER[1:]], axis=1)
        ladder = ladder[(ladder[:, 1] >= (floors * sizes).min(initial=np.inf)) & (ladder[:, 0] <= min((sizes / floors).max(initial=0), len(text.distinct)))]
        return Windows(text, ladder, place, cols, has, sizes, floors) if len(has) and len(ladder) else None


class Windows:
    """The two counts of one text against some terms."""

    def __init__(self, text: Text, ladder: np.ndarray, place: np.ndarray, terms: np.ndarray, has: np.ndarray, sizes: np.ndarray, floors: np.ndarray):
        self.text, self.ladder, self.place, self.terms, self.has, self.sizes, self.floors = text, ladder, place, terms, has, sizes, floors
        self.present = np.zeros((len(text.starts), len(has)), bool)
        here = np.flatnonzero(place >= 0)
        self.present[here // BLOCK, place[here]] = True
        first = np.arange(0, len(ladder), RUNGS)
        self.low, self.high = ladder[first, 0], ladder[np.minimum(first + RUNGS, len(ladder)) - 1, 1]  # sizes of a group of rungs: low <= d < high
        # the least count by which a run of the group can reach the floor
        self.least = least_count(sizes, floors, self.low[:, None]).astype(np.float32)
        self.least[(self.high[:, None] < floors * sizes) | (self.low[:, None] > sizes / floors)] = np.inf

    def wide(self):
        """(groups, wide blocks, ends, counts) in parts: one row for each window of ``WIDE`` blocks and one group of rungs, without the
        windows that lie in one of ``COARSE`` such blocks whose count reaches no term's least."""
        starts = np.arange(0, len(self.present), WIDE)
        first = np.arange(0, len(starts), COARSE)
        ends = self.text.window_ends(self.text.starts[starts[first]], self.high + COARSE * WIDE * BLOCK)
        stop = -(-ends // (WIDE * BLOCK))  # past the last wide block of the window
        present = np.zeros((len(starts), len(self.has)), bool)
        here = np.flatnonzero(self.place >= 0)
        present[here // (WIDE * BLOCK), self.place[here]] = True
        spans = union_spans(present, int((stop - first[:, None]).max()))
        pairs = [np.zeros((2, 0), np.int64)]
        for a in range(0, stop.size, WINDOWS):
            group, block = np.divmod(np.arange(a, min(a + WINDOWS, stop.size)), len(first))
            count = window_union(spans, first[block], stop[block, group]).astype(np.float32) @ self.has
            pairs.append(np.stack([group, block])[:, (count >= self.least[group]).any(axis=1)])
        group, block = np.concatenate(pairs, axis=1)
        group, block = np.repeat(group, COARSE), (block[:, None] * COARSE + np.arange(COARSE)).reshape(-1)
        group, block = group[block < len(starts)], block[block < len(starts)]
        if not len(block):
            return
        near, number = np.unique(block, return_inverse=True)
        ends = self.text.window_ends(self.text.starts[starts[near]], self.high + WIDE * BLOCK)
        stop = -(-ends // (WIDE * BLOCK))
        for a in range(0, len(group), WINDOWS):
            g, b, n = group[a:a + WINDOWS], block[a:a + WINDOWS], number[a:a + WINDOWS]
            yield g, b, ends[n, g], window_union(spans, b, stop[n, g]).astype(np.float32) @ self.has

    def bounds(self) -> tuple[np.ndarray, ...]:
        """Runs of neighbouring blocks whose bound reaches the term's floor, by term: (term, first block, bound, where the last window
        that may hold such a run ends)."""
        found = [np.zeros((3, 0), np.int64)]
        for group, block, _, count in self.wide():
            w, j = np.divmod(np.flatnonzero(count >= self.least[group]), len(self.sizes))
            found.append(np.stack([group[w], block[w], j]))
        group, block, term = np.concatenate(found, axis=1)
        kept = [np.zeros((4, 0))]
        if len(group):
            blocks = len(self.present)
            fine = (np.unique(block)[:, None] * WIDE + np.arange(WIDE)).reshape(-1)
            fine = fine[fine < blocks]
            number = np.full(blocks + WIDE, -1)
            number[fine] = np.arange(len(fine))
            ends = self.text.window_ends(self.text.starts[fine], self.ladder[:, 1] + BLOCK)
            stop = -(-ends // BLOCK)
            spans = union_spans(bits(self.present), int((stop - fine[:, None]).max()))
            term_bits = bits(self.has.T > 0)
            step = max(1, TRIPLES // (WIDE * RUNGS))
            parts = np.repeat(np.arange(RUNGS), WIDE), np.tile(np.arange(WIDE), RUNGS)
            for a in range(0, len(group), step):
                k = (group[a:a + step, None] * RUNGS + parts[0]).reshape(-1)
                at = number[(block[a:a + step, None] * WIDE + parts[1]).reshape(-1)]
                j = np.repeat(term[a:a + step], WIDE * RUNGS)
                some = (k < len(self.ladder)) & (at >= 0)
                k, at, j = k[some], at[some], j[some]
                u, end = self.ladder[k, 0], ends[at, k]
                inside = window_union(spans, fine[at], stop[at, k])
                inside &= term_bits[j]
                count = np.bitwise_count(inside).sum(axis=1, dtype=np.int64)
                bound = count / (self.sizes[j] + np.maximum(u - count, 0))
                some = bound >= self.floors[j] - 1e-6
                kept.append(np.stack([j[some], fine[at[some]] // SCORED, bound[some], end[some]]))
        term, block, bound, end = np.concatenate(kept, axis=1)
        order = np.lexsort((block, term))
        term, block, bound, end = term[order].astype(np.int64), block[order].astype(np.int64) * SCORED, bound[order], end[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, (np.diff(term) != 0) | (np.diff(block) != 0))) if len(term) else term
        if not len(term):
            return term, block, bound, end
        return term[first], block[first], np.maximum.reduceat(bound, first), np.maximum.reduceat(end, first)

    def is_term(self, j: int) -> np.ndarray:
        """Which places of the text hold a trigram of the term."""
        return (self.place >= 0) & (self.has[:, j][self.place] > 0)

    def best_guess(self) -> tuple[np.ndarray, ...]:
        """For every term the wide window with the highest bound: (first block, bound, end)."""
        at, best, until = np.zeros(len(self.sizes), np.int64), np.zeros(len(self.sizes)), np.zeros(len(self.sizes), np.int64)
        column = np.arange(len(self.sizes))
        for group, block, end, count in self.wide():
            bound = count / (self.sizes + np.maximum(self.low[group][:, None] - count, 0))
            w = bound.argmax(axis=0)
            more = bound[w, column] > best
            at[more], best[more], until[more] = block[w[more]] * WIDE, bound[w, column][more], end[w[more]]
        return at, best, until


def least_count(n: np.ndarray, floor: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The least c whose bound c / (n + max(u - c, 0)) reaches the floor."""
    return np.where(u >= floor * n, floor * (n + u) / (1 + floor), floor * n) - 1e-3


def bits(rows: np.ndarray) -> np.ndarray:
    """Boolean rows as 64-bit words."""
    packed = np.packbits(rows, axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def best_in_blocks(text: Text, is_a: np.ndarray, n_a: int, block: int, blocks: int, end: int) -> float:
    """The best score of the runs that start in ``blocks`` blocks from ``block`` and end before ``end``."""
    s, size = int(text.starts[block]), blocks * BLOCK
    hits = s + np.flatnonzero(is_a[s:min(s + size, end)])
    if not len(hits):
        return 0.0
    prev = text.prev[s:end]
    places = np.flatnonzero(prev < s + size)  # no other place is the first of its trigram in any of these runs
    new = prev[places] < hits[:, None]
    places += s
    new[:, :size] &= places[:size] >= hits[:, None]
    total = np.cumsum(new, axis=1, dtype=np.int32)
    shared = np.cumsum(new & is_a[places], axis=1, dtype=np.int32)
    return float((shared / (n_a + total - shared)).max())


def scores_of(text: Text, terms: TermBlock, floors: np.ndarray, some: np.ndarray | None = None) -> dict[int, float]:
    """term -> the text's word similarity, for the terms whose floor (> 0) it reaches."""
    windows, out = terms.windows(text, floors, some), {}
    if windows is None:
        return out
    term, block, bound, end = windows.bounds()
    for j in np.unique(term).tolist():
        s, e = np.searchsorted(term, [j, j + 1]).tolist()
        is_a, best, floor = windows.is_term(j), 0.0, float(windows.floors[j])
        for b in (s + np.argsort(-bound[s:e], kind="stable")).tolist():
            if bound[b] < max(best, floor) - 1e-6:
                break
            best = max(best, best_in_blocks(text, is_a, int(windows.sizes[j]), int(block[b]), SCORED, int(end[b])))
        if best >= floor:
            out[int(windows.terms[j])] = best
    return out


def guesses_of(text: Text, terms: TermBlock, floors: np.ndarray, some: np.ndarray | None = None) -> dict[int, float]:
    """term -> a score of one run of the text (so no more than its word similarity), where that reaches the floor (> 0)."""
    windows, out = terms.windows(text, floors, some), {}
    if windows is None:
        return out
    block, bound, end = windows.best_guess()
    for j in np.flatnonzero(bound >= windows.floors - 1e-6).tolist():
        score = best_in_blocks(text, windows.is_term(j), int(windows.sizes[j]), int(block[j]), WIDE, int(end[j]))
        if score >= windows.floors[j]:
            out[int(windows.terms[j])] = score
    return out
