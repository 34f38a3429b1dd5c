"""Clean views of the domain tables, and the registry of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import geo, ids
from geoweave.functions.text import non_empty
from geoweave.runtime import _FROM, _TO, in_force, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query; ``sql`` is its equivalent over the same tables."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return add


_PLACE = "name asciiName alternateNames wikidataAlternateNames featureClass featureCode countryCode admin1Code admin2Code admin3Code admin4Code population elevation timezone modifiedDate wikidataId lat lon"
_ENTITY = "name description alternateNames officialNames label geonamesId population inceptionDate dissolvedDate replacesQid replacedByQid countryQid lat lon"
_PERSON = "idType name alternateNames wikidataQid viafId occupations birthDate deathDate motherId fatherId bornIn diedIn"
#: Stored columns that a clean column is made of, where not the one of its name.
_MADE_OF = {
    "place": {"lat": ["location", "latitude", "longitude"], "lon": ["location", "latitude", "longitude"]},
    "wikidataplace": {"lat": ["latitude", "longitude"], "lon": ["latitude", "longitude"], "label": ["instanceOfLabel"]},
    "historicalperson": {"birthDate": ["birthEvent"], "deathDate": ["deathEvent"], "motherId": ["birthEvent"], "fatherId": ["birthEvent"], "bornIn": ["birthEvent"], "diedIn": ["deathEvent"]},
}


def _clean(spark: SparkSession, d: str, name: str, key: str, wanted: list[str], make: dict) -> DataFrame:
    """Rows in force with the wanted clean columns; only what they are made of is read."""
    made = _MADE_OF[name]
    stored = list(dict.fromkeys(c for w in wanted for c in made.get(w, [w])))
    t = table(spark, d, name)
    if not stored:  # only the keys
        return t.where(F.col(key).isNotNull()).select(key).distinct()
    return in_force(t, key, stored).select(key, *[make[w]().alias(w) if w in make else F.col(w) for w in wanted])


def places(spark: SparkSession, d: str, columns: str = _PLACE) -> DataFrame:
    """Places in force: empty codes as null, country codes in upper case, position as lat and lon."""
    code = {c: lambda c=c: non_empty(F.col(c)) for c in ("featureClass", "featureCode", "admin1Code", "admin2Code", "admin3Code", "admin4Code")}
    at = lambda: geo.position(F.col("location"), F.col("latitude"), F.col("longitude"))
    make = code | {"countryCode": lambda: F.upper(non_empty(F.col("countryCode"))), "wikidataId": lambda: ids.qid(F.col("wikidataId")), "lat": lambda: at()["lat"], "lon": lambda: at()["lon"]}
    return _clean(spark, d, "place", "geonameId", columns.split(), make)


def entities(spark: SparkSession, d: str, columns: str = _ENTITY) -> DataFrame:
    """Wikidata places in force: usable position as lat and lon, links as bare QIDs."""
    ok = lambda: geo.valid_position(F.col("latitude"), F.col("longitude"))
    make = {c: lambda c=c: ids.qid(F.col(c)) for c in ("replacesQid", "replacedByQid", "countryQid")}
    make |= {"lat": lambda: F.when(ok(), F.col("latitude")), "lon": lambda: F.when(ok(), F.col("longitude")), "label": lambda: F.lower(non_empty(F.col("instanceOfLabel")))}
    return _clean(spark, d, "wikidataplace", "qid", columns.split(), make)


def persons(spark: SparkSession, d: str, columns: str = _PERSON) -> DataFrame:
    """Persons in force: bare identifiers, parents, birth and death place numbers."""
    numbers = lambda c: F.array_compact(F.transform(F.col(c), lambda x: x["geonamesId"]))
    make = {
        "wikidataQid": lambda: ids.qid(F.col("wikidataQid")), "viafId": lambda: ids.number_id(F.col("viafId")), "birthDate": lambda: F.col("birthEvent.date"), "deathDate": lambda: F.col("deathEvent.date"),
        "motherId": lambda: ids.person_id(F.col("birthEvent.motherId")), "fatherId": lambda: ids.person_id(F.col("birthEvent.fatherId")), "bornIn": lambda: numbers("birthEvent.places"), "diedIn": lambda: numbers("deathEvent.places"),
    }
    return _clean(spark, d, "historicalperson", "personId", columns.split(), make)


_POINT = r"(?i)point\s*z?\s*\(\s*([-+]?[0-9.]+)[\s,]+([-+]?[0-9.]+)"
_FORCE = "(select * exclude(_rn) from (select *, row_number() over (partition by {k} order by loadedAt desc nulls last) _rn from {t} where {k} is not null) where _rn = 1)"


def _bare(x: str) -> str:
    return rf"""regexp_replace({x}, '[<>\[\](){{}}"\s]', '', 'g')"""


def _qid(x: str) -> str:
    got = f"regexp_extract({_bare(x)}, '(?i)(?:^|[:/])Q([1-9][0-9]*)$', 1)"
    return f"(case when {got} <> '' then 'Q' || {got} end)"


def _pid(x: str) -> str:
    kind, tail = f"lower(regexp_extract({_bare(x)}, '(?i)(?:^|/)([a-z]+)[:/][^:/]+$', 1))", f"regexp_extract({_bare(x)}, '([^:/]+)$', 1)"
    return f"(case when {kind} = 'wd' then 'wd:' || upper({tail}) when {kind} <> '' then {kind} || ':' || lower({tail}) end)"


def _number(x: str) -> str:
    return f"try_cast(nullif(regexp_extract(regexp_replace(regexp_replace({_bare(x)}, '/+$', ''), '\\.0+$', ''), '(?:^|[^0-9])0*([1-9][0-9]*)$', 1), '') as bigint)"


def fold_sql(x: str) -> str:
    return f"translate(lower({x}), '{_FROM}', '{_TO}')"


def km_sql(a: str, b: str) -> str:
    return (
        f"round(2 * 6371 * asin(sqrt(least(1, sin(radians({b}.lat - {a}.lat) / 2) ** 2 + cos(radians({a}.lat)) * cos(radians({b}.lat)) * sin(radians({b}.lon - {a}.lon) / 2) ** 2))), 3)"
    )


_VIEWS = {
    "p": f"""select geonameId, name, asciiName, alternateNames, wikidataAlternateNames, nullif(trim(featureClass), '') featureClass, nullif(trim(featureCode), '') featureCode,
 nullif(upper(trim(countryCode)), '') countryCode, nullif(trim(admin1Code), '') admin1Code, nullif(trim(admin2Code), '') admin2Code, nullif(trim(admin3Code), '') admin3Code,
 nullif(trim(admin4Code), '') admin4Code, population, elevation, timezone, modifiedDate, {_qid('wikidataId')} wikidataId,
 case when py between -90 and 90 and px between -180 and 180 then py when own then latitude end lat,
 case when py between -90 and 90 and px between -180 and 180 then px when own then longitude end lon
 from (select *, try_cast(regexp_extract(location, '{_POINT}', 1) as double) px, try_cast(regexp_extract(location, '{_POINT}', 2) as double) py,
 (latitude between -90 and 90 and longitude between -180 and 180) own from {_FORCE.format(k='geonameId', t='place')})""",
    "w": f"""select qid, name, description, case when ok then latitude end lat, case when ok then longitude end lon, alternateNames, officialNames,
 nullif(lower(trim(instanceOfLabel)), '') as label, geonamesId, {_number('geonamesId')} gid, population, inceptionDate, dissolvedDate,
 {_qid('replacesQid')} replacesQid, {_qid('replacedByQid')} replacedByQid, {_qid('countryQid')} countryQid
 from (select *, (latitude between -90 and 90 and longitude between -180 and 180) ok from {_FORCE.format(k='qid', t='wikidataplace')})""",
    "h": f"""select personId, idType, name, alternateNames, {_qid('wikidataQid')} wikidataQid, occupations, birthEvent.date birthDate, deathEvent.date deathDate,
 {_pid('birthEvent.motherId')} motherId, {_pid('birthEvent.fatherId')} fatherId,
 list_filter(list_transform(birthEvent.places, lambda x: x.geonamesId), lambda x: x is not null) bornIn,
 list_filter(list_transform(deathEvent.places, lambda x: x.geonamesId), lambda x: x is not null) diedIn from {_FORCE.format(k='personId', t='historicalperson')}""",
    "born": "select personId, unnest(bornIn) place from h",
    "died": "select personId, unnest(diedIn) place from h",
    "parent": "select personId child, motherId parent, 'mother' kind from h where motherId is not null union all select personId, fatherId, 'father' from h where fatherId is not null",
    "idlink": "select distinct w.qid src, w.gid dst from w join p on p.geonameId = w.gid",
    "pair": "select least(l, r) a, greatest(l, r) b, verdict, confidence, judgedAt, matchId from (select *, " + _pid("leftPersonId") + " l, " + _pid("rightPersonId") + " r from personmatch) where l <> r",
    "flow": "select bp.countryCode birth, dp.countryCode death, count(*)::bigint n from born b join died d using (personId) join p bp on bp.geonameId = b.place join p dp on dp.geonameId = d.place"
    " where bp.countryCode is not null and dp.countryCode is not null group by all",
}
_NEEDS = {"born": ["h"], "died": ["h"], "parent": ["h"], "idlink": ["w", "p"], "flow": ["h", "born", "died", "p"]}


def with_views(sql: str) -> str:
    """Prefixes the clean views that the statement names with ``{view}`` marks."""
    import re

    used: list[str] = []
    for v in re.findall(r"\{(\w+)\}", sql):
        for x in [*_NEEDS.get(v, []), v]:
            if x not in used:
                used.append(x)
    body = re.sub(r"\{(\w+)\}", r"\1", sql)
    head = ", ".join(f"{v} as materialized ({_VIEWS[v]})" for v in used)
    extra = re.match(r"\s*with\s+(recursive\s+)?", body, re.I)
    if extra:
        body = body[extra.end() :]
        return f"with {extra.group(1) or ''}{head}, {body}" if head else f"with {extra.group(1) or ''}{body}"
    return f"with {head} {body}" if head else body
