"""Personal data in free text: detection and surrogate generation.

Detection reads whole texts.  Names rest on the given and middle names of the
person table, every one of them; the other kinds on their formats and on what
stands around them.  Replacement gives each entity a keyed surrogate of its own
kind, format, script and, where the person table tells it, gender; the same
entity keeps its surrogate everywhere, different entities never share one (see
``queries.p9_redacted`` for the collision check over all documents).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd

# Blanks and at most one line break: no name or address goes on behind an empty line.
_S = r"(?=\s)[^\S\n]*\n?[^\S\n]*"
_L = "A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĘĚĞĪŁŃŇŌŐŘŚŠŤŪŮŰŹŻŽΑ-ΩЀ-Я"
_WORD = rf"[{_L}][\w¡-ſ'’\-]*[\w¡-ſ]"
_PARTICLE = rf"(?:(?:[Dd]e|[Vv]an|[Vv]on|[Dd]u|DE|VAN|VON|DU){_S})?"
_FAMILY = rf"{_PARTICLE}{_WORD}"
_INITIAL = rf"[{_L}]\."

# Street words.
_STREET = r"Street|St\.|Court|Ct\.|Avenue|Ave\.|Crescent|Cres\.|Terrace|Drive|Dr\.|Row|Road|Rd|Lane|Ln\.|Place|Boulevard|Blvd\.|Way|Square"
_EMAIL = re.compile(
    r"(?<![\w.+-])[\w.+-]*[\w+](?:\s?@\s?|\s?\(at\)\s?|\s?\[at\]\s?|\s?\{at\}\s?)[A-Za-z0-9][\w-]*(?:(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?|\s?\{dot\}\s?)[A-Za-z][\w-]*)+(?![\w])", re.I
)
_PHONE = re.compile(
    r"(?<![\w.+\-(])(?:"
    r"\+33\s?\(0\)\s?\d(?:[\s.-]\d\d){4}|\+33\s?\d(?:[\s.-]?\d\d){4}|0\d(?:[\s.-]\d\d){4}"
    r"|\+44\s\d{2,4}\s\d{3,4}\s\d{3,4}|020\s\d{4}\s\d{4}"
    r"|(?:\+?1[\s.-])?(?:\(\d{3}\)\s?|\d{3}[\s.-])\d{3}[\s.-]\d{4}|(?:\+?1)?[2-9]\d{2}[2-9]\d{6}"
    r")(?!\w|-\d|\.\d)"
)
_IDNUM = re.compile(
    r"(?<![\w.\-/])(?:\d{4}-\d{3}-\d{3}-[A-Z]{2}|\d\s\d\d\s\d\d\s\d\d\s\d{3}\s\d{3}|\d{3}-\d\d-\d{4}|[A-Z]{2}\d{7}|\d{3}\s\d{3}\s\d{3}|\d{9})(?![\w]|-\w|\.\d|\s\d{3}\b)"
)
# Before a bare number these announce a record, not a person's document.
_RECORD = re.compile(r"(?:identifi\w+|registe?r? (?:has|indica|steht)|indica|steht|register has|(?-i:\bid)|ref\.|reg\.|Q)\s*$", re.I)
_NUMBER = r"\d{1,4}(?:-[A-Z])?"
_NAMED = rf"(?:[NSEW]\.?\s|(?:North|South|East|West|NORTH|SOUTH|EAST|WEST)\s)?[{_L}][\w'’-]+(?:\s[{_L}][\w'’-]+)?"
_ADDRESS = re.compile(
    rf"(?<![\w.\-/])(?:(?:(?:Unit|UNIT|Apt\.?|Suite|Flat)\s\d+,\s)?{_NUMBER}{_S}{_NAMED}?{_S}(?:(?i:{_STREET}))(?!\w)"
    rf"|\d{{1,4}}(?:\sbis)?,?\s(?i:rue|chemin|avenue|ruelle|impasse|allée|quai|boulevard)\s(?:(?i:du|des|de\sla|de)\s|(?i:de\sl|d)['’])?[{_L}][\w'’-]+"
    rf"|(?:(?:Am|An\sder|Im|Auf\sdem)\s)?[{_L}][\wäöüß]*(?:weg|straße|strasse|hof|gasse|platz|allee)\s\d{{1,4}}[a-z]?(?!\w)"
    rf"|(?i:Avenida|Calle|Plaza|Paseo)\s(?:(?i:del|de\sla|de\slos|de)\s)?[{_L}][\w'’-]+,?\s\d{{1,4}}(?!\w))"
)
_DATED = re.compile(r"\bThe\s+$", re.I)
_FIRE = re.compile(r"\s+fire\b", re.I)


_INITIALS = re.compile(rf"(?<![\w.]){_INITIAL}(?:{_S}{_INITIAL}){{0,2}}{_S}{_FAMILY}")
_TOKEN = re.compile(rf"(?<![\w.-]){_WORD}(?!\w)")
_MIDDLE = re.compile(rf"{_S}(?:{_INITIAL}|({_WORD})(?!\w))")
_AFTER = re.compile(rf"{_S}{_FAMILY}")
_TOKEN_AT = re.compile(_WORD)
_BEFORE = re.compile(rf"(?<![\w.-]){_FAMILY},{_S}(?={_WORD})")


class Lexicon:
    """Names told by given and middle names, as written or in capitals; any number of them."""

    def __init__(self, given: list[str], middle: list[str]):
        self.given = {v for w in given for v in (w, w.upper())}
        self.middle = {v for w in middle for v in (w, w.upper())}

    def _middles(self, text: str, at: int) -> list[int]:
        """Where up to two middle names or initials behind ``at`` end, ``at`` first."""
        ends = [at]
        while len(ends) < 3 and (m := _MIDDLE.match(text, at)) and (m.group(1) is None or m.group(1) in self.middle):
            at = m.end()
            ends.append(at)
        return ends

    def _names(self, text: str) -> Iterator[tuple[int, int]]:
        if self.given:
            tokens = {m.start(): m.end() for m in _TOKEN.finditer(text) if m.group() in self.given}
            if tokens:
                for m in _BEFORE.finditer(text):
                    end = m.end() + len(_TOKEN_AT.match(text, m.end()).group())
                    if text[m.end() : end] in self.given:
                        yield m.start(), self._middles(text, end)[-1]
                last = 0
                for start, end in tokens.items():
                    family = start >= last and next((f for e in reversed(self._middles(text, end)) if (f := _AFTER.match(text, e))), None)
                    if family:
                        last = family.end()
                        yield start, last
        for m in _INITIALS.finditer(text):
            yield m.span()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Disjoint (start, end, kind) in text order.

        Where two kinds claim the same letters, the earlier of email, phone,
        document number, address, name keeps them.  An empty text has none.
        """
        taken: list[tuple[int, int, str]] = []

        def free(a: int, z: int) -> bool:
            return all(z <= s or a >= e for s, e, _ in taken)

        for kind, pattern in (("email", _EMAIL), ("phone", _PHONE), ("idnum", _IDNUM), ("address", _ADDRESS)):
            for m in pattern.finditer(text):
                a, z = m.span()
                if not free(a, z):
                    continue
                if kind == "idnum" and m.group().isdigit() and _RECORD.search(text, max(0, a - 24), a):
                    continue
                if kind == "address" and (_DATED.search(text, max(0, a - 6), a) or _FIRE.match(text, z)):
                    continue
                taken.append((a, z, kind))
        for a, z in self._names(text):
            # A compass point behind a house number begins a street.
            if free(a, z) and not (text[a : a + 2] in ("N.", "S.", "E.", "W.") and re.search(r"\d(?:-[A-Z])?\s+$", text[max(0, a - 8) : a])):
                taken.append((a, z, "name"))
        return sorted(taken)


_FR, _UK = re.compile(r"0\d(?:[\s.-]\d\d){4}"), re.compile(r"0\d\d\s\d{4}\s\d{4}")


def _phone(s: str) -> tuple[str, int]:
    """(country code, where the national digits begin): told by the prefix or by how digits are grouped."""
    m = re.match(r"\+(1|33|44)(?:\s?\(0\))?", s)
    if m:
        return m.group(1), m.end()
    if _FR.fullmatch(s) or _UK.fullmatch(s):
        return ("33" if _FR.fullmatch(s) else "44"), 1
    return "1", int(s.startswith("1") and sum(c.isdigit() for c in s) == 11)


def canonical(kind: str, text: str) -> str:
    """What an entity is known by, however written."""
    s = re.sub(r"\s+", " ", text).strip()
    if kind == "email":
        s = re.sub(r"\s*(?:\(at\)|\[at\]|\{at\}|@)\s*", "@", s, flags=re.I)
        return re.sub(r"\s*(?:\[dot\]|\(dot\)|\{dot\})\s*", ".", s, flags=re.I).lower()
    if kind == "phone":
        code, start = _phone(s)
        return f"+{code}" + re.sub(r"\D", "", s[start:])
    if kind == "idnum":
        return re.sub(r"[^0-9A-Z]", "", s.upper())
    if kind == "name":
        if "," in s:
            family, given = s.split(",", 1)
            s = f"{given.strip()} {family}"
        s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return s.casefold()


def linked(names: list[str]) -> dict[str, str]:
    """Initials with a family name -> the one full name of the same text they stand for, if just one fits."""
    full = [n for n in dict.fromkeys(names) if "." not in n.split(" ", 1)[0]]
    out = {}
    for n in dict.fromkeys(names):
        if "." in n.split(" ", 1)[0]:
            family = re.sub(r"^(?:\S\. )+", "", n)
            fits = [f for f in full if f[0] == n[0] and f.endswith(f" {family}")]
            if len(fits) == 1:
                out[n] = fits[0]
    return out


def find_frames(given: list[str] | None, middle: list[str] | None):
    """mapInPandas function over (doc_id, text): (doc_id, start, stop, kind, found_text, entity).

    Without lists the frames bring each document's own names as columns given and middle.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = Lexicon(given or [], middle or [])
        for df in frames:
            rows = []
            for at, (d, t) in enumerate(zip(df["doc_id"], df["text"])):
                if not t:
                    continue
                if given is None:
                    own = [df[c].iloc[at] for c in ("given", "middle")]
                    lex = Lexicon(*[[] if x is None else list(x) for x in own])
                hits = [(a, z, k, t[a:z], canonical(k, t[a:z])) for a, z, k in lex.spans(t)]
                same = linked([h[4] for h in hits if h[2] == "name"])
                rows += [(d, a, z, k, f, same.get(e, e) if k == "name" else e) for a, z, k, f, e in hits]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "stop", "kind", "found_text", "entity"]).astype({"doc_id": "int64", "start": "int32", "stop": "int32"})

    return run


# Syllables of surrogate names.
_HEADS = "Bal Cor Dan Fel Gar Hol Jas Kel Lor Mar Nel Os Per Quin Ras Sel Tam Ul Ver Wil Yar Zel".split()
_MIDDLES = "a e i o u an en in or ar el al".split()
_TAILS = "bert cott dale ford gard hurst land mont nock port rick sted ton vale well worth".split()
_GIVEN = {
    "f": "Alma Berta Clara Dora Edna Flora Greta Hilda Irma Julia Klara Laura Martha Nora Olga Paula Rosa Selma Thea Vera".split(),
    "m": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jakob Karl Ludwig Martin Niels Oscar Paul Robert Simon Thomas Victor".split(),
    "": "Alex Andrea Bobbie Camille Dominique Eden Francis Gale Hilary Jean Kim Leslie Marion Nicola Robin Sacha Toni Valery".split(),
}
# Letters of other scripts for Latin ones.
_SCRIPTS = {
    "CYRILLIC": str.maketrans(dict(zip("abcdefghijklmnopqrstuvwxyz", "а б к д е ф г х и й к л м н о п к р с т у в в кс ы з".split()))),
    "GREEK": str.maketrans(dict(zip("abcdefghijklmnopqrstuvwxyz", "α β κ δ ε φ γ χ ι ι κ λ μ ν ο π κ ρ σ τ υ β ω ξ υ ζ".split()))),
}


class _Stream:
    """Keyed, deterministic choices for one entity and attempt."""

    def __init__(self, key: str, kind: str, entity: str, attempt: int):
        h = hashlib.blake2b(f"{kind}\x00{entity}\x00{attempt}".encode(), key=key.encode()[:64], digest_size=64)
        self.n = int.from_bytes(h.digest(), "big")

    def pick(self, options):
        self.n, i = divmod(self.n, len(options))
        return options[i]

    def digits(self, n: int) -> str:
        return "".join(self.pick("0123456789") for _ in range(n))


def surrogate_core(key: str, kind: str, entity: str, attempt: int, sex: str = "") -> str:
    """The entity's replacement without its format: name, digits and letters, mailbox or street.

    Every fourth attempt lengthens names and numbers, so that the space cannot run out.
    """
    s = _Stream(key, kind, entity, attempt)
    family = s.pick(_HEADS) + "".join(s.pick(_MIDDLES) + s.pick("bdfglmnrst") for _ in range(1 + attempt // 4)) + s.pick(_MIDDLES) + s.pick(_TAILS)
    if kind == "name":
        return f"{s.pick(_GIVEN[sex])} {family}"
    if kind == "email":
        return f"{family.lower()}{s.digits(3)}@mail.example"
    if kind == "address":
        return f"{1 + int(s.digits(3 + attempt // 4))} {1 + int(s.digits(2))} {s.pick('ABCDEFGHJKLMNPRSTUVWXYZ')} {family}"
    return s.digits(20) + "".join(s.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(20))


# Words of addresses that are no one's name.
_PLAIN = set(
    "street st court ct avenue ave crescent cres terrace drive dr row road rd lane ln place boulevard blvd way square unit apt suite flat north south east west n s e w "
    "bis rue chemin ruelle impasse allée quai du des de la d l am an der im auf dem avenida calle plaza paseo del los".split()
)
_COMPOUND = re.compile(r"(?:weg|straße|strasse|hof|gasse|platz|allee)$", re.I)


def _address(found: str, core: str) -> str:
    """Numbers, flat letters and every word of the street's name are replaced; what kind of street it is stays."""
    number, unit, letter, street = core.split(" ")
    numbers = [unit, number] if re.match(r"(?i)(?:unit|apt|suite|flat)\b", found) else [number, unit]
    seen = {"n": 0, "w": 0}

    def put(m: re.Match) -> str:
        w = m.group("word")
        if m.group("num"):
            seen["n"] += 1
            return m.group("gap") + numbers[(seen["n"] - 1) % 2]
        if m.group("flat"):
            return m.group("gap") + (letter if m.group("flat")[-1].isupper() else letter.lower()).rjust(len(m.group("flat")), "-")
        head = re.match(r"[dl]['’]", w, re.I)
        rest = w[head.end() :] if head else w
        if rest.lower() in _PLAIN:
            return m.group()
        seen["w"] += 1
        if seen["w"] > 1:
            return ""
        tail = _COMPOUND.search(rest)
        return m.group("gap") + (head.group() if head else "") + street + (tail.group().lower() if tail else "")

    return re.sub(r"(?P<gap>\s*)(?:(?P<num>\d+)|(?P<flat>(?<=\d)-?[A-Za-z])(?!\w)|(?P<word>[^\W\d_][\w'’-]*))", put, found)


def _name(found: str, core: str) -> str:
    given, family = core.split(" ", 1)
    script = next((unicodedata.name(c, "").split(" ", 1)[0] for c in found if c.isalpha()), "")
    if script in _SCRIPTS:
        given, family = (x.lower().translate(_SCRIPTS[script]).capitalize() for x in (given, family))
    if "," in found:
        return f"{family}, {given}"
    return f"{given[0]}. {family}" if re.match(_INITIAL, found) else f"{given} {family}"


def dress(kind: str, found: str, core: str) -> str:
    """The replacement in the format of what was found."""
    if kind in ("phone", "idnum"):
        start = _phone(found)[1] if kind == "phone" else 0
        digits, letters = iter(core[:20]), iter(core[20:])
        return found[:start] + "".join(next(digits) if c.isdigit() else next(letters) if c.isalpha() else c for c in found[start:])
    if kind == "email":
        box, domain = core.split("@")
        m = re.search(r"\s?(?:@|\(at\)|\[at\]|\{at\})\s?", found, re.I)
        dot = re.search(r"\s?(?:\[dot\]|\(dot\)|\{dot\})\s?", found, re.I)
        out = box + (m.group() if m else "@") + (domain.replace(".", dot.group()) if dot else domain)
    else:
        out = _address(found, core) if kind == "address" else _name(found, core)
    return out.upper() if found.isupper() else out


def draw_frames(key: str):
    """mapInPandas function over (kind, entity, sex, found, attempt): adds core and what the dressed core is known by (shown)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            cores = [surrogate_core(key, k, e, int(a), x or "") for k, e, a, x in zip(df["kind"], df["entity"], df["attempt"], df["sex"])]
            yield df.assign(core=cores, shown=[canonical(k, dress(k, f, c)) for k, f, c in zip(df["kind"], df["found"], cores)])

    return run


def replace_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas function over (doc_id, text, hits): (doc_id, tagged, surrogate).

    Equal entities of a document share their number and surrogate; everything
    between the entities stays letter for letter.  A null text stays null.
    """
    for df in frames:
        out = []
        for d, text, hits in zip(df["doc_id"], df["text"], df["hits"]):
            if text is None or hits is None or not len(hits):
                out.append((d, text, text))
                continue
            tagged, fake, at = [], [], 0
            number: dict[tuple[str, str], int] = {}
            for h in sorted(hits, key=lambda h: h["start"]):
                n = number.setdefault((h["kind"], h["entity"]), 1 + sum(k == h["kind"] for k, _ in number))
                keep = text[at : h["start"]]
                tagged += [keep, f"[{h['kind'].upper()}_{n}]"]
                fake += [keep, dress(h["kind"], text[h["start"] : h["stop"]], h["core"])]
                at = h["stop"]
            out.append((d, "".join([*tagged, text[at:]]), "".join([*fake, text[at:]])))
        yield pd.DataFrame(out, columns=["doc_id", "tagged", "surrogate"])
