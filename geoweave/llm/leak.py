"""Evaluation passages inside a corpus: Wu-Manber search, then direct comparison.

Texts are reduced to the letters and digits of any script (case, accents,
punctuation, spacing and markup do not count).  A passage of twelve or more
words with at most one in six changed or missing holds a run of at least four
unchanged words, so every run of four words of an item is a pattern; all
patterns are searched at once with block shift tables and suffix-hash buckets.
Each hit is extended in both directions by an alignment of words that allows as
many changed, missing or put-in words in one place as the item may lose at all;
the longest admissible stretch decides.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd

#: Fewest words of a passage, words one error is allowed for, words of a pattern.
LEAST, PER_ERROR, RUN = 12, 6, 4
#: Patterns at which nearly every place of a text needs a comparison.
DENSE = 10_000

_LETTERS = str.maketrans({"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe"})
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_BROKEN = re.compile("[Â-Å][\u0080-ÿŒœŠšŸŽžƒˆ˜–-›€™]")
_OTHER = re.compile(r"[\W_]+")
# Scripts written without blanks: every sign is a word of its own.
_SIGN = "\u2e80-\u2fdf\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_PARTS = re.compile(rf"[{_SIGN}]|[^\W_{_SIGN}]+")


def _mend(m: re.Match) -> str:
    try:
        return m.group().encode("cp1252").decode("utf-8")
    except UnicodeError:
        return m.group()


def plain(text: str) -> str:
    """Lower case, no markup, no accents, wrongly decoded letters mended."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _BROKEN.sub(_mend, text).lower().translate(_LETTERS)
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return text.lower()


def parts(text: str) -> list[str]:
    """The unbroken runs of letters and digits; their letters follow each other without gaps."""
    return _PARTS.findall(plain(text))


def words(text: str) -> list[str]:
    """What stands between blanks, reduced to letters; signs of scripts without blanks one by one."""
    return [w for t in plain(text).split() for w in _PARTS.findall(_OTHER.sub("", t))]


class _Tables:
    """Shift table and buckets of patterns that all have at least ``m`` letters."""

    def __init__(self, patterns: list[str], block: int):
        self.m = m = min(map(len, patterns))
        self.b = b = min(block, m)
        self.far = m - b + 1
        self.shift: dict[str, int] = {}
        self.buckets: dict[str, tuple[str, ...]] = {}
        for p in patterns:
            for end in range(b, m + 1):
                blk = p[end - b : end]
                self.shift[blk] = min(self.shift.get(blk, self.far), m - end)
            # Bucket by the block that ends the first m letters and by the prefix.
            key = p[m - b : m] + p[:b]
            self.buckets[key] = (*self.buckets.get(key, ()), p)

    def search(self, text: str) -> Iterator[tuple[int, str]]:
        m, b, far = self.m, self.b, self.far
        shift, n, end = self.shift.get, len(text), m
        while end <= n:
            blk = text[end - b : end]
            s = shift(blk, far)
            if s:
                end += s
                continue
            at = end - m
            for p in self.buckets.get(blk + text[at : at + b], ()):
                if text.startswith(p, at):
                    yield at, p
            end += 1


class WuManber:
    """Occurrences of many patterns.

    The shortest pattern bounds the steps, so patterns are searched in up to
    three classes of length, cut where the expected work is least: a class costs
    one look-up per step, and more the likelier a place is to need a comparison.
    """

    def __init__(self, patterns: dict[str, object], block: int = 5):
        self.patterns = patterns
        sizes = sorted(Counter(map(len, patterns)).items())

        def work(ms: tuple[int, ...]) -> float:
            held = [sum(n for size, n in sizes if m <= size < z) for m, z in zip(ms, (*ms[1:], sizes[-1][0] + 1))]
            return sum((1 + 3 * min(1, n / DENSE)) / (m - min(block, m) + 1) for m, n in zip(ms, held))

        lengths = [size for size, _ in sizes]
        ways = [(lengths[0], *cut) for n in range(3) for cut in combinations(lengths[1:], n)] if sizes else [()]
        self.cuts = min(ways, key=work) if sizes else ()
        classes: list[list[str]] = [[] for _ in self.cuts]
        for p in patterns:
            classes[sum(len(p) >= m for m in self.cuts) - 1].append(p)
        self.tables = [_Tables(c, block) for c in classes]

    def search(self, text: str) -> Iterator[tuple[int, str]]:
        for t in self.tables:
            yield from t.search(text)


def _near(a: str, b: str) -> bool:
    """Same length or one apart, and at most one letter different (misread letters)."""
    if abs(len(a) - len(b)) > 1 or len(a) < 5:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def _extend(ws: list[str], text: str, pos: int, edges: list[int], most: int) -> dict[int, int]:
    """Aligned words: index -> fewest words changed or missing before it, where that word stands unchanged.

    ``ws[0]`` stands at ``pos``.  Words follow each other directly, wherever the
    blanks are, or after a gap: then as whole words or with five letters.  A gap
    costs the words passed over, or the words that stand in it where those are
    more and longer.  A word of five letters with one misread counts as
    unchanged inside, not at the end.
    """
    best: dict[int, int] = {}
    states: list[dict[int, tuple[int, bool]]] = [{} for _ in ws]
    states[0][pos + len(ws[0])] = (0, True)
    last = len(edges) - 1

    def reach(i: int, end: int, failed: int, whole: bool) -> None:
        had = states[i].get(end)
        if had is None or (failed, not whole) < (had[0], not had[1]):
            states[i][end] = (failed, whole)

    for i in range(len(ws)):
        for end, (failed, whole) in states[i].items():
            if whole:
                best[i] = min(failed, best.get(i, failed))
            k = i + 1
            if k == len(ws):
                continue
            if text.startswith(ws[k], end):
                reach(k, end + len(ws[k]), failed, True)
                continue
            for size in (len(ws[k]) - 1, len(ws[k]), len(ws[k]) + 1):
                if _near(ws[k], text[end : end + size]):
                    reach(k, end + size, failed, False)
            first, room = bisect_left(edges, end), end
            for skip in range(min(most - failed + 1, len(ws) - k)):
                w = ws[k + skip]
                limit = max(room, edges[min(last, first + most - failed)])
                at = text.find(w, end, limit + len(w))
                while at >= 0:
                    z = at + len(w)
                    if len(w) >= 5 or at == end or _edge(edges, at) and _edge(edges, z):
                        cost = skip if at <= room else max(skip, bisect_left(edges, at) - first)
                        if failed + cost <= most:
                            reach(k + skip, z, failed + cost, True)
                    at = text.find(w, at + 1, limit + len(w))
                room += len(w) + 4
    return best


def _edge(edges: list[int], at: int) -> bool:
    i = bisect_left(edges, at)
    return i < len(edges) and edges[i] == at


def longest(left: dict[int, int], right: dict[int, int]) -> int:
    """Words of the longest stretch around a hit that begins and ends unchanged, one error allowed per six."""
    return max((n for a, f in left.items() for z, g in right.items() if (f + g) * PER_ERROR <= (n := a + z + 1)), default=0)


class Items:
    """A block of evaluation items with their search tables."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, words(t)) for i, t in items if t]
        patterns: dict[str, list[tuple[int, int]]] = {}
        for k, (_, ws) in enumerate(self.items):
            if len(ws) >= LEAST:
                for j in range(len(ws) - RUN + 1):
                    patterns.setdefault("".join(ws[j : j + RUN]), []).append((k, j))
        self.search = WuManber(patterns)

    def found(self, text: str) -> dict[int, int]:
        """item id -> words of its longest passage in the text, LEAST or more.

        Whole texts are searched.  Items shorter than LEAST words, empty or null
        ones are never found; an item occurring several times counts once, with
        its longest passage; equal items are each found.
        """
        pieces = parts(text)
        t = "".join(pieces)
        out: dict[int, int] = {}
        # Words of an item that an alignment already holds, by where they stand.
        seen: set[tuple[int, int, int]] = set()
        back = ""
        edges: list[int] = []
        mirrored: list[int] = []
        for at, p in self.search.search(t):
            for k, j in self.search.patterns[p]:
                ident, ws = self.items[k]
                if (k, j, at) in seen or out.get(ident, 0) >= len(ws):
                    continue
                if not back:
                    back, edges = t[::-1], [0]
                    for w in pieces:
                        edges.append(edges[-1] + len(w))
                    mirrored = [len(t) - e for e in reversed(edges)]
                # The hit's neighbours in an unbroken stretch give the same alignment.
                pos = at
                for x in range(j, len(ws)):
                    if not t.startswith(ws[x], pos):
                        break
                    seen.add((k, x, pos))
                    pos += len(ws[x])
                most = len(ws) // PER_ERROR
                right = _extend(ws[j:], t, at, edges, most)
                left = _extend([w[::-1] for w in reversed(ws[: j + 1])], back, len(t) - at - len(ws[j]), mirrored, most)
                n = longest(left, right)
                if n >= LEAST:
                    out[ident] = max(n, out.get(ident, 0))
        return out


def leak_frames(items: list[tuple[int, str]]):
    """mapInPandas function over (doc_id, text): (doc_id, item_id, words)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Items(items)
        for df in frames:
            rows = [(d, i, n) for d, t in zip(df["doc_id"], df["text"]) if t for i, n in block.found(t).items()]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "words"]).astype({"doc_id": "int64", "item_id": "int64", "words": "int32"})

    return run
