"""RDF event data: Turtle and N-Triples to triples, triples to persons and agents.

Turtle needs a tokenizer; whole files go through it in Python, one file per row,
so a collection is read file-parallel.  Everything after is joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import ids
from geoweave.functions.text import occupation_role, url_number

CRM = "http://www.cidoc-crm.org/cidoc-crm/"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
TYPE = RDF + "type"
LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
SAME = "http://www.w3.org/2002/07/owl#sameAs"

_TOKEN = re.compile(
    r"""(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<str>\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')"""
    r"""|(?P<tag>@[A-Za-z][A-Za-z0-9-]*)|(?P<cast>\^\^)|(?P<num>[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?(?![\w:]))|(?P<name>[^\s<>"'()\[\];,#^@]*:[^\s<>"'()\[\];,#^@]*[^\s<>"'()\[\];,#^@.]|[^\s<>"'()\[\];,#^@]*:)"""
    r"""|(?P<word>[A-Za-z]+)|(?P<mark>[;,.\[\]()])|(?P<skip>\s+|\#[^\n]*)""",
    re.S,
)
_ESCAPE = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def _text(s: str) -> str:
    s = s[3:-3] if s[:3] in ('"""', "'''") else s[1:-1]
    return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _ESCAPE.get(m[1], m[1]), s)


def parse_turtle(text: str, strict: bool = True) -> Iterator[tuple[str, str, str, str]]:
    """(s, p, o, kind) with kind iri, literal or bnode.

    Understands prefixes, base, ``a``, ``;`` and ``,``, typed and tagged
    literals, anonymous nodes in brackets, collections.  A character that starts
    no token raises ValueError if ``strict``, else it is passed over.
    """
    tokens: list[tuple[str, str]] = []
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m and not strict:
            at += 1
            continue
        if not m:
            raise ValueError(f"unreadable at {at}: {text[at : at + 40]!r}")
        at = m.end()
        if m.lastgroup != "skip":
            tokens.append((m.lastgroup, m.group()))
    prefixes: dict[str, str] = {}
    base, k, fresh = "", 0, 0

    def iri(kind: str, t: str) -> tuple[str, str]:
        if kind == "iri":
            t = t[1:-1]
            return (t if re.match(r"[A-Za-z][\w+.-]*:", t) else base + t), "iri"
        if t.startswith("_:"):
            return t, "bnode"
        head, _, tail = t.partition(":")
        return prefixes.get(head, head + ":") + re.sub(r"\\(.)", r"\1", tail), "iri"

    out: list[tuple[str, str, str, str]] = []

    def node() -> tuple[str, str]:
        nonlocal k, fresh
        kind, t = tokens[k]
        k += 1
        if t == "[":
            fresh += 1
            name = f"_:b{fresh}"
            if tokens[k][1] != "]":
                pairs(name, "]")
            k += 1
            return name, "bnode"
        if t == "(":
            cells = []
            while tokens[k][1] != ")":
                cells.append(node())
            k += 1
            names = [f"_:b{fresh + i + 1}" for i in range(len(cells))]
            fresh += len(cells)
            for name, after, (o, what) in zip(names, [*names[1:], RDF + "nil"], cells):
                out.extend([(name, RDF + "first", o, what), (name, RDF + "rest", after, "bnode" if after.startswith("_:") else "iri")])
            return (names[0], "bnode") if names else (RDF + "nil", "iri")
        if kind == "str":
            if k < len(tokens) and tokens[k][0] == "tag":
                k += 1
            elif k < len(tokens) and tokens[k][0] == "cast":
                k += 2
            return _text(t), "literal"
        if kind == "num" or (kind == "word" and t in ("true", "false")):
            return t, "literal"
        return iri(kind, t)

    def pairs(s: str, end: str) -> None:
        nonlocal k
        while tokens[k][1] != end:
            kind, t = tokens[k]
            if t == ";":
                k += 1
                continue
            k += 1
            p = TYPE if t == "a" else iri(kind, t)[0]
            while True:
                o, what = node()
                out.append((s, p, o, what))
                if tokens[k][1] != ",":
                    break
                k += 1

    while k < len(tokens):
        kind, t = tokens[k]
        if t.lower() in ("@prefix", "prefix"):
            prefixes[tokens[k + 1][1].rstrip(":")] = tokens[k + 2][1][1:-1]
            k += 3 + (t[0] == "@")
        elif t.lower() in ("@base", "base"):
            base = tokens[k + 1][1][1:-1]
            k += 2 + (t[0] == "@")
        else:
            s, _ = node()
            pairs(s, ".")
            k += 1
    yield from out


def _files(strict: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for file, text in zip(df["file"], df["value"]):
                rows = [(f"{file}{s}" if s.startswith("_:") else s, p, f"{file}{o}" if k == "bnode" else o, k) for s, p, o, k in parse_turtle(text, strict)]
                yield pd.DataFrame(rows, columns=["s", "p", "o", "o_kind"])

    return run


def turtle(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(s, p, o, o_kind) of all Turtle files; blank nodes are kept apart per file."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return t.mapInPandas(_files(strict), "s string, p string, o string, o_kind string")


def ntriples(spark: SparkSession, path: str) -> DataFrame:
    """(s, p, o, o_kind) of N-Triples, read by columns alone."""
    pat = r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(<[^>]*>|_:\S+|".*"\S*)\s*\.\s*$'
    t = spark.read.text(path).where(F.col("value").rlike(pat))
    o = F.regexp_extract("value", pat, 3)
    bare = lambda c: F.regexp_replace(c, r"^<|>$", "")
    return t.select(
        bare(F.regexp_extract("value", pat, 1)).alias("s"), F.regexp_extract("value", pat, 2).alias("p"),
        F.when(o.startswith('"'), F.regexp_extract(o, r'^"(.*)"', 1)).otherwise(bare(o)).alias("o"),
        F.when(o.startswith('"'), "literal").when(o.startswith("_:"), "bnode").otherwise("iri").alias("o_kind"),
    )


def _of(t: DataFrame, kind: str) -> DataFrame:
    return t.where((F.col("p") == TYPE) & (F.col("o") == CRM + kind)).select("s").distinct()


def _values(t: DataFrame, *preds: str) -> DataFrame:
    return t.where(F.col("p").isin(*[p if ":" in p else CRM + p for p in preds])).select("s", "o")


def _first(t: DataFrame, name: str, *preds: str) -> DataFrame:
    """One value per subject; several: the smallest, so that the result is fixed."""
    return _values(t, *preds).groupBy("s").agg(F.min("o").alias(name))


def person_key(uri: Column) -> Column:
    """Prefixed id by the authority in the URI; other URIs stay whole."""
    last = F.regexp_extract(F.regexp_replace(uri, "/+$", ""), r"([^/]*)$", 1)
    return F.when(uri.contains("viaf.org"), F.concat(F.lit("viaf:"), last)).when(uri.contains("wikidata.org"), F.concat(F.lit("wd:"), last)).when(uri.contains("lincs"), F.concat(F.lit("lincs:"), last)).otherwise(uri)


def _kind(uri: Column) -> Column:
    return F.when(uri.contains("viaf.org"), "VIAF").when(uri.contains("wikidata.org"), "Wikidata").when(uri.contains("lincs"), "LINCS").otherwise("Other")


def _spans(t: DataFrame) -> DataFrame:
    s = _of(t, "E52_Time-Span")
    for name, pred in (("date", "P82_at_some_time_within"), ("dateBegin", "P82a_begin_of_the_begin"), ("dateEnd", "P82b_end_of_the_end")):
        s = s.join(_first(t, name, pred), "s", "left")
    return s.withColumnRenamed("s", "span")


def _events(t: DataFrame, kind: str, who: str, people: DataFrame) -> DataFrame:
    """(person, event struct) of births or deaths; events of unknown persons are left out."""
    e = _of(t, kind).join(_first(t, "uri", who), "s").join(people.select("uri"), "uri", "left_semi")
    at = _values(t, "P7_took_place_at").select("s", F.struct(F.lit("geonames").alias("type"), url_number(F.col("o")).alias("id")).alias("place")).where("place.id is not null")
    e = e.join(at.groupBy("s").agg(F.sort_array(F.collect_set("place")).alias("places")), "s", "left")
    span = _first(t, "span", "P4_has_time-span", "P4_has_time_span").join(_spans(t), "span").drop("span")
    e = e.join(span, "s", "left")
    keys = people.select(F.col("uri").alias("o"), "personId")
    for name, pred in (("motherId", "P96_by_mother"), ("fatherId", "P97_from_father")):
        e = e.join(_values(t, pred).join(keys, "o").groupBy("s").agg(F.min("personId").alias(name)), "s", "left")
    fields = ["places", "date", "dateBegin", "dateEnd", "motherId", "fatherId"]
    return e.groupBy("uri").agg(F.min_by(F.struct(*fields), "s").alias("event"))


def persons(t: DataFrame) -> DataFrame:
    """Persons with names, identifiers, birth and death events and spouses."""
    p = _of(t, "E21_Person").select(F.col("s").alias("uri"), person_key(F.col("s")).alias("personId"), _kind(F.col("s")).alias("idType"))
    names = _values(t, LABEL).groupBy("s").agg(F.sort_array(F.collect_set("o")).alias("names")).withColumnRenamed("s", "uri")
    same = _values(t, SAME)
    wd = same.where(F.col("o").contains("wikidata.org")).groupBy("s").agg(F.min(ids.qid(F.col("o"))).alias("wikidataQid")).withColumnRenamed("s", "uri")
    vf = same.where(F.col("o").contains("viaf.org")).groupBy("s").agg(F.min(ids.number_id(F.col("o"))).alias("sameViaf")).withColumnRenamed("s", "uri")
    born = _events(t, "E67_Birth", "P98_brought_into_life", p).withColumnRenamed("event", "birthEvent")
    died = _events(t, "E69_Death", "P100_was_death_of", p).withColumnRenamed("event", "deathEvent")
    out = p.join(names, "uri", "left").join(wd, "uri", "left").join(vf, "uri", "left").join(born, "uri", "left").join(died, "uri", "left").join(spouses(t, p), "personId", "left")
    return out.select(
        "personId", "idType", F.coalesce(F.get("names", F.lit(0)), F.lit("Unknown")).alias("name"), F.when(F.size("names") > 1, F.slice("names", F.lit(2), F.size("names") - 1)).otherwise(F.array().cast("array<string>")).alias("alternateNames"),
        "wikidataQid", F.when(F.col("idType") == "VIAF", ids.number_id(F.col("uri"))).otherwise(F.col("sameViaf")).alias("viafId"), "birthEvent", F.col("deathEvent").dropFields("motherId", "fatherId").alias("deathEvent"), "relationships",
    )


def spouses(t: DataFrame, people: DataFrame) -> DataFrame:
    """(personId, relationships): the other persons of each joining, the latest date per pair."""
    joined = _of(t, "E85_Joining").join(_values(t, "P143_joined").withColumnRenamed("o", "uri"), "s").join(people.select("uri", "personId"), "uri").select("s", "personId")
    date = _first(t, "span", "P4_has_time-span", "P4_has_time_span").join(_spans(t), "span").select("s", "date")
    pairs = joined.join(joined.withColumnRenamed("personId", "other"), "s").where("personId <> other").join(date, "s", "left")
    one = pairs.groupBy("personId", "other").agg(F.max("date").alias("date"))
    return one.groupBy("personId").agg(F.sort_array(F.collect_list(F.struct(F.lit("spouse").alias("type"), F.col("other").alias("personId"), "date"))).alias("relationships"))


def plausible(people: DataFrame) -> DataFrame:
    """Persons with at least one event, identifier or relation."""
    return people.where("birthEvent is not null or deathEvent is not null or wikidataQid is not null or size(relationships) > 0")


# Fixed value: the agency where a record names none.
def agents(t: DataFrame, default_agency: str = "Department of Indian Affairs") -> DataFrame:
    """Persons with the activities they carried out: role, agency, start, place number."""
    p = _of(t, "E21_Person").withColumnRenamed("s", "uri")
    name = _first(t, "name", LABEL).withColumnRenamed("s", "uri")
    through = _values(t, "P1_is_identified_by").select(F.col("s").alias("uri"), F.col("o").alias("s")).join(_values(t, SAME), "s").select("uri", "o")
    same = _values(t, SAME).withColumnRenamed("s", "uri").unionByName(through)
    ext = same.groupBy("uri").agg(F.min(F.when(F.col("o").contains("viaf.org"), ids.number_id(F.col("o")))).alias("viafId"), F.min(F.when(F.col("o").contains("wikidata.org"), ids.qid(F.col("o")))).alias("wikidataQid"))
    a = _of(t, "E7_Activity").join(_first(t, "uri", "P14_carried_out_by"), "s").join(_first(t, "label", LABEL), "s", "left")
    spot = _values(t, "P7_took_place_at").where(F.col("o").contains("geonames.org")).groupBy("s").agg(F.min(url_number(F.col("o"))).alias("geonamesId"))
    start = _first(t, "span", "P4_has_time-span", "P4_has_time_span").join(_first(t, "startDate", "P82_at_some_time_within").withColumnRenamed("s", "span"), "span").select("s", "startDate")
    agency = _first(t, "by", "P11_had_participant").join(_first(t, "agency", LABEL).withColumnRenamed("s", "by"), "by").select("s", "agency")
    a = a.join(spot, "s", "left").join(start, "s", "left").join(agency, "s", "left")
    row = F.struct(occupation_role(F.coalesce("label", F.lit(""))).alias("role"), F.coalesce("agency", F.lit(default_agency)).alias("agency"), "startDate", "geonamesId")
    jobs = a.groupBy("uri").agg(F.sort_array(F.collect_list(row)).alias("occupations"))
    return p.join(name, "uri", "left").join(ext, "uri", "left").join(jobs, "uri", "left").select(person_key(F.col("uri")).alias("lincsId"), "name", "viafId", "wikidataQid", "occupations")
