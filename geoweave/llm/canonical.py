"""Mapping freely typed values to a canonical list: trie and Levenshtein automaton.

The reference names and all their aliases form one trie.  It is walked together
with a universal Levenshtein automaton (with swaps of neighbouring letters):
states are bands of edit costs relative to the position, transitions depend only
on which query letters equal the trie letter, so they are computed once and
shared by all queries.  A walk leaves a branch as soon as the automaton dies.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd

# Letters and digits of every script.
_WORD = re.compile(r"[^\W_]+")
# Letters that have no decomposition.
_LETTERS = str.maketrans({"ł": "l", "Ł": "L", "ø": "o", "Ø": "O", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe"})
# Words around a name that are no part of it.
_BEFORE = re.compile(
    r"^(?:near|nr|prob|probably|pro|in the vicinity of|vicinity of|close to|town of|parish of|of|pres de|cerca de|bei|vers|by|at)\b[.\s]*|^[\s.,;:?!*\"'(\[]+"
)
_AFTER = re.compile(r"(?:\(\s*s(?:i(?:c)?)?\.?\s*\)?|\?|\b(?:p\.?\s?o\.?|post office|post off\.|twp\.?|township|co\.))\s*$|(?<=[a-z])twp$|[\s,;:?!*\"')\]]+$")
# Abbreviated words of names and what they stand for.
_SHORT = {
    "jct": "junction", "pt": "point", "hbr": "harbour", "is": "island", "r": "river", "ldg": "landing", "st": "saint", "ste": "saint",
    "ft": "fort", "mt": "mount", "l": "lake", "mls": "mills", "upr": "upper", "mtn": "mountain",
}
# At the start of a name these stand for something else.
_SHORT_FIRST = {"pt": "port", "l": "lake", "n": "new", "st": "saint", "ste": "saint", "ft": "fort", "mt": "mount", "u": "upper"}
# What is written where there is no place.
_NOTHING = {
    "", "unknown", "not stated", "none", "na", "n a", "illegible", "abroad", "at sea", "same as above", "ditto", "do", "in the old country", "his fathers farm",
    "inconnu", "unbekannt", "upriver", "elsewhere", "here", "home", "blank", "same", "null", "twp", "p o",
}


def fold(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.translate(_LETTERS))
    return "".join(c for c in s if not unicodedata.combining(c)).lower()


def reading(raw: str) -> tuple[list[str], bool, str]:
    """(spellings without blanks, whether the end was cut off, what follows a comma)."""
    s = fold(raw)
    s, _, tail = s.partition(",")
    s = s.replace("-", " ")
    s = re.sub(r"(?<=[a-z])0|0(?=[a-z])", "o", s)
    s = re.sub(r"(?<=[a-z])1|1(?=[a-z])", "l", s)
    old = None
    while old != s:
        old = s
        s = _AFTER.sub("", _BEFORE.sub("", s.strip()).strip())
    cut = s.endswith(".")
    words = _WORD.findall(s.replace("'", ""))
    if " ".join(words) in _NOTHING:
        return [], False, tail.strip()
    if words and words[-1] in _SHORT:
        cut = False
    ways = {"".join(words)}
    if len(words) > 1:
        last = [*words[:-1], _SHORT.get(words[-1], words[-1])]
        ways |= {"".join(last), "".join([_SHORT_FIRST.get(last[0], last[0]), *last[1:]]), "".join([_SHORT.get(last[0], last[0]), *last[1:]])}
    return sorted(w for w in ways if w), cut, tail.strip()


def spelling(name: str) -> str:
    """The form under which a reference name enters the trie."""
    return "".join(_WORD.findall(fold(name).replace("'", "")))


def allowed(n: int) -> int:
    """Edits allowed for a value of ``n`` letters."""
    return 0 if n < 4 else 1 if n < 7 else 2 if n < 10 else 3


class Automaton:
    """Universal Levenshtein automaton of degree k with neighbour swaps."""

    def __init__(self, k: int):
        self.k, self.width = k, (1 << (2 * k + 3)) - 1
        big = k + 1
        start = (tuple(j if j >= 0 else big for j in range(-k, k + 1)), None, 0)
        self.states, self.ids, self.moves = [start], {start: 0}, [{}]

    def go(self, state: int, chi: int) -> int:
        """Next state, or -1 if dead; bit b of chi: the letter equals query letter i - k - 1 + b."""
        to = self.moves[state].get(chi)
        if to is None:
            to = self.moves[state][chi] = self._make(state, chi)
        return to

    def _make(self, state: int, chi: int) -> int:
        k, big = self.k, self.k + 1
        row, before, last = self.states[state]
        new = []
        # Cell x is query position j = i + 1 - k + x; the letter before it is bit x + 1 of chi.
        for x in range(2 * k + 1):
            best = row[x] if chi >> (x + 1) & 1 else row[x] + 1
            if x < 2 * k:
                best = min(best, row[x + 1] + 1)
            if x:
                best = min(best, new[-1] + 1)
            # Swap: this letter equals query j - 2, the previous letter equals query j - 1.
            if before is not None and chi >> x & 1 and x + 2 <= 2 * k + 2 and last >> (x + 2) & 1:
                best = min(best, before[x] + 1)
            new.append(min(best, big))
        if min(new) > k:
            return -1
        nxt = (tuple(new), row, chi)
        if nxt not in self.ids:
            self.ids[nxt] = len(self.states)
            self.states.append(nxt)
            self.moves.append({})
        return self.ids[nxt]


#: Automata by degree; their states do not depend on the names, so a task builds each once.
_AUTOMATA: dict[int, Automaton] = {}


def _automaton(k: int) -> Automaton:
    if k not in _AUTOMATA:
        _AUTOMATA[k] = Automaton(k)
    return _AUTOMATA[k]


class Trie:
    """Names as nested letter maps; entry lists at their ends."""

    def __init__(self, names: dict[str, list[int]]):
        self.kids: list[dict[str, int]] = [{}]
        self.ends: dict[int, list[int]] = {}
        for name, entries in names.items():
            at = 0
            for c in name:
                nxt = self.kids[at].get(c)
                if nxt is None:
                    nxt = self.kids[at][c] = len(self.kids)
                    self.kids.append({})
                at = nxt
            self.ends[at] = entries

    def search(self, query: str, k: int) -> list[tuple[int, int]]:
        """All (distance, entry) within k edits."""
        auto = _automaton(k)
        n, found = len(query), []
        masks: dict[str, int] = {}
        for t, c in enumerate(query):
            masks[c] = masks.get(c, 0) | 1 << (t + k + 1)
        stack = [(0, 0, 0)]
        kids, ends, go, states, width = self.kids, self.ends, auto.go, auto.states, auto.width
        while stack:
            node, i, state = stack.pop()
            if node in ends and abs(n - i) <= k:
                cost = states[state][0][n - i + k]
                if cost <= k:
                    found += [(cost, e) for e in ends[node]]
            for c, child in kids[node].items():
                nxt = go(state, masks.get(c, 0) >> i & width)
                if nxt >= 0:
                    stack.append((child, i + 1, nxt))
        return found

    def completions(self, query: str, k: int) -> list[tuple[int, int]]:
        """All (distance of the query to a beginning, entry), however far the entry goes on."""
        auto = _automaton(k)
        n = len(query)
        masks: dict[str, int] = {}
        for t, c in enumerate(query):
            masks[c] = masks.get(c, 0) | 1 << (t + k + 1)
        best: dict[int, int] = {}
        stack = [(0, 0, 0)]
        while stack:
            node, i, state = stack.pop()
            if abs(n - i) <= k:
                cost = auto.states[state][0][n - i + k]
                if cost <= k:
                    below = [node]
                    while below:
                        at = below.pop()
                        for e in self.ends.get(at, ()):
                            best[e] = min(cost, best.get(e, cost))
                        below += self.kids[at].values()
            for c, child in self.kids[node].items():
                nxt = auto.go(state, masks.get(c, 0) >> i & auto.width)
                if nxt >= 0:
                    stack.append((child, i + 1, nxt))
        return [(c, e) for e, c in best.items()]


class Matcher:
    """Searches one block of the canonical list.

    ``entries``: (id, country, population, names).  ``countries``: (code, name),
    to read a country written behind a comma.
    """

    def __init__(self, entries: list[tuple[int, str | None, int, list[str]]], countries: list[tuple[str, str]]):
        self.entries = entries
        names: dict[str, list[int]] = {}
        for e, (_, _, _, own) in enumerate(entries):
            for w in dict.fromkeys(spelling(x) for x in own if x):
                if w:
                    names.setdefault(w, []).append(e)
        self.trie = Trie(names)
        self.countries = [(code, spelling(name)) for code, name in countries if code and name]
        self.cache: dict[str, tuple[int, list[int], list[str], bool]] = {}

    def candidates(self, raw: str) -> tuple[int, list[int], list[str], bool]:
        """(distance, closest entries, country codes read from the text, whether names were completed); distance -1: none."""
        hit = self.cache.get(raw)
        if hit is not None:
            return hit
        ways, cut, tail = reading(raw)
        key = spelling(tail)
        codes = [code for code, name in self.countries if len(key) >= 3 and name.startswith(key)] if key else []
        out: tuple[int, list[int], list[str], bool] = (-1, [], codes, False)
        most = max((allowed(len(w)) for w in ways), default=0)
        for k in range(most + 1):
            found = {f for w in ways if allowed(len(w)) >= k for f in self.trie.search(w, k)}
            completed = not found and cut
            if completed:
                found = {f for w in ways if len(w) >= 6 and allowed(len(w)) >= k for f in self.trie.completions(w, k)}
            if found:
                low = min(d for d, _ in found)
                out = (low, sorted({e for d, e in found if d == low}), codes, completed)
                break
        if len(self.cache) < 200_000:
            self.cache[raw] = out
        return out

    def best(self, raw: str | None, hint: str | None) -> tuple[int, int, bool, bool, int]:
        """(entry id or 0, distance or -1, name completed, outside the stated country, population).

        Null, empty and unreadable values and words for "no place" mean none.
        Of several closest entries the one in the stated country counts, then
        the most populous, then the smallest id; texts of any length are read whole.
        All but the id, in this order and population downwards, rank the bests of several blocks.
        """
        none = (0, -1, False, False, 0)
        if not raw:
            return none
        distance, found, codes, completed = self.candidates(raw)
        if not found:
            return none
        want = [hint.strip().upper()] if hint and hint.strip() else codes

        def rank(e: int) -> tuple:
            ident, country, population, _ = self.entries[e]
            return ((country or "").upper() not in want, -(population or 0), ident)

        elsewhere, fewer, ident = min(map(rank, found))
        return ident, distance, completed, elsewhere, -fewer

    def match(self, raw: str | None, hint: str | None) -> tuple[int, int]:
        """(entry id or 0, distance or -1) of the best entry."""
        return self.best(raw, hint)[:2]


def search_groups(countries: list):
    """applyInPandas function over one chunk of mentions (mention_id, raw, hint) and one block of the list.

    The groups of a task come by block, so the trie of a block is built once a task.
    """
    columns = ["geoname_id", "distance", "completed", "elsewhere", "population"]
    held: dict[int, Matcher] = {}

    def run(key: tuple, mentions: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if key[0] not in held:
            held.clear()
            rows = zip(entries["geonameId"], entries["countryCode"], entries["population"], entries["names"])
            held[key[0]] = Matcher([(int(i), c, int(p), list(n)) for i, c, p, n in rows], countries)
        m = held[key[0]]
        got = pd.DataFrame([m.best(r, h) for r, h in zip(mentions["raw"], mentions["hint"])], columns=columns, index=mentions.index)
        return pd.concat([mentions[["mention_id"]], got], axis=1)

    return run
