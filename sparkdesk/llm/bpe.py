"""Byte-pair merging over the published vocabulary files, shared by token counting and encoding.

Unicode classes: the tokenizers library carries its own tables for ``\\p{L}`` and ``\\p{N}``, which
differ from Python's for thousands of code points. The classes used here are therefore read off the
library once on the driver and shipped to the tasks as plain character ranges.
"""

from __future__ import annotations

import functools
import heapq
import json
import re


@functools.lru_cache(maxsize=1)
def byte_alphabet() -> tuple[str, ...]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return tuple(out[b] for b in range(256))


@functools.lru_cache(maxsize=1)
def _latin_table() -> dict[int, str]:
    return dict(enumerate(byte_alphabet()))


def byte_symbols(text: str) -> str:
    """The UTF-8 bytes of a text, one alphabet character per byte."""
    if text.isascii() and text.isprintable():  # every printable ASCII byte but the space stands for itself
        return text.replace(" ", byte_alphabet()[32])
    return text.encode("utf-8").decode("latin-1").translate(_latin_table())


@functools.lru_cache(maxsize=4)
def load_model(path: str) -> dict:
    """Vocabulary, merge ranks, suffix and added tokens of a tokenizers JSON file."""
    with open(path, encoding="utf-8") as fh:
        spec = json.load(fh)
    model = spec["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": model["vocab"], "ranks": {p: k for k, p in enumerate(pairs)},
            "suffix": model.get("end_of_word_suffix") or "",
            "specials": {t["content"]: t["id"] for t in spec.get("added_tokens", [])}}


@functools.lru_cache(maxsize=1)
def unicode_classes() -> dict[str, list[tuple[int, int]]]:
    """Code point ranges of letters (L), numbers (N) and white space (S) as the library sees them."""
    from tokenizers import Regex, pre_tokenizers

    probe = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000)
    out = {}
    for name, cls in (("L", r"\p{L}+"), ("N", r"\p{N}+"), ("S", r"\s+")):
        found = pre_tokenizers.Split(Regex(cls), "removed", invert=True).pre_tokenize_str(probe)
        out[name] = [(ord(piece[0]), ord(piece[-1])) for piece, _ in found if piece]
    # a run may step over the surrogates, which no text holds
    return out


def _ranges(spans, top: int) -> str:
    return "".join(f"\\U{a:08x}-\\U{min(b, top):08x}" for a, b in spans if a <= top)


def with_classes(template: str) -> tuple[str, str]:
    """A pattern with {L} {N} {S} filled in, for texts inside the basic plane and for all texts.

    (Python's matcher tests a set with astral ranges one range after another, so the common case
    gets a pattern without them.)"""
    cls = unicode_classes()
    return tuple(template.format(**{k: _ranges(v, top) for k, v in cls.items()}) for top in (0xFFFF, 0x10FFFF))


class Splitter:
    """Cuts a text at the special strings, and the rest into pre-tokens."""

    def __init__(self, patterns: tuple[str, str], specials: dict[str, int]):
        self.basic, self.full = (re.compile(p) for p in patterns)
        self.astral = re.compile("[\U00010000-\U0010ffff]")
        names = sorted(specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def segments(self, text: str) -> list[tuple[bool, str]]:
        """(is_special, string) in text order, empty strings left out."""
        if self.special is None or self.special.search(text) is None:
            return [(False, text)] if text else []
        return [(k % 2 == 1, s) for k, s in enumerate(self.special.split(text)) if s]

    def pretokens(self, text: str) -> list[str]:
        pattern = self.basic if text.isascii() or self.astral.search(text) is None else self.full
        return pattern.findall(text)


NO_MERGE = 1 << 60


def merge(symbols, ranks: dict) -> list[str]:
    """The merged symbols: always the pair of lowest rank, the leftmost of equals."""
    parts = list(symbols)
    if len(parts) > 48:
        return _merge_long(parts, ranks)
    get = ranks.get
    near = [get(p, NO_MERGE) for p in zip(parts, parts[1:], strict=False)]
    while near and (best := min(near)) < NO_MERGE:
        i = near.index(best)
        parts[i] += parts.pop(i + 1)
        near.pop(i)
        if i < len(near):
            near[i] = get((parts[i], parts[i + 1]), NO_MERGE)
        if i:
            near[i - 1] = get((parts[i - 1], parts[i]), NO_MERGE)
    return parts


def _merge_long(parts: list[str], ranks: dict) -> list[str]:
    """The same with a heap over a linked list, for n log n on very long pre-tokens."""
    n = len(parts)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
            if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j] = a + b, False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < n:
                r = ranks.get((parts[left], parts[after[left]]))
                if r is not None:
                    heapq.heappush(heap, (r, left, parts[left], parts[after[left]]))
    return [p for p, ok in zip(parts, alive, strict=True) if ok]
