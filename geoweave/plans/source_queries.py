"""Queries of the readers, parsers and writers.

Each writes whole tables in a source's own format into the scratch folder and
reads them back through the source; the SQL states the result over the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import ids, text
from geoweave.operators import tables
from geoweave.plans.base import _pid, _qid, entities, persons, places, query
from geoweave.runtime import Scratch, in_force, table
from geoweave.sources import documents, entity_dump, gazetteer, rdf, sparql
from geoweave.streaming import increment


def _folder(spark: SparkSession, label: str) -> str:
    return Scratch(spark, label).root


# ---- gazetteer dump


def _dump(spark: SparkSession, d: str) -> DataFrame:
    """All deliveries of place as a dump, read back raw."""
    t = table(spark, d, "place").select(
        F.col("geonameId").alias("geonameid"), "name", F.col("asciiName").alias("asciiname"), F.array_join("alternateNames", ",").alias("alternatenames"), "latitude", "longitude",
        F.col("featureClass").alias("feature_class"), F.col("featureCode").alias("feature_code"), F.col("countryCode").alias("country_code"),
        *[F.col(f"admin{i}Code").alias(f"admin{i}_code") for i in (1, 2, 3, 4)], "population", "elevation", "timezone", F.col("modifiedDate").alias("modification_date"),
    )
    path = _folder(spark, "dump")
    gazetteer.write(t, path)
    return gazetteer.read(spark, path)


_PLAIN = "nullif(regexp_replace({x}, '[\\t\\r\\n]', ' ', 'g'), '')"
_FILE = f"""f as (select geonameId, {_PLAIN.format(x='"name"')} "name", {_PLAIN.format(x='asciiName')} asciiName, latitude, longitude, nullif(featureClass, '') cls, nullif(featureCode, '') code, nullif(countryCode, '') cc,
 len(list_filter(string_split(coalesce(array_to_string(alternateNames, ','), ''), ','), lambda x: trim(x) <> ''))::int n_alt, coalesce(admin1Code, '') a1, coalesce(admin3Code, '') a3, coalesce(population, 0) population, coalesce(elevation, 0) elevation, nullif(timezone, '') tz from place)"""


@query(f"""with {_FILE} select geonameId, "name", asciiName ascii, latitude, longitude, cls || '.' || code full_code, cc country, a1, a3, n_alt, population, elevation, tz from f where geonameId is not null and latitude is not null and longitude is not null""")
def src_gazetteer(spark, d):
    return gazetteer.cleanse(_dump(spark, d)).select(
        "geonameId", "name", F.col("asciiName").alias("ascii"), "latitude", "longitude", F.col("fullFeatureCode").alias("full_code"), F.col("countryCode").alias("country"), F.col("admin1Code").alias("a1"), F.col("admin3Code").alias("a3"),
        F.size("alternateNames").alias("n_alt"), "population", "elevation", F.col("timezone").alias("tz"),
    )


@query(f"with {_FILE} select cc country, count(*)::bigint n, count(latitude)::bigint with_latitude from f where geonameId is not null group by 1")
def src_gazetteer_all(spark, d):
    p = gazetteer.cleanse(_dump(spark, d), keep_without_position=True)
    return p.groupBy(F.col("countryCode").alias("country")).agg(F.count(F.lit(1)).alias("n"), F.count("latitude").alias("with_latitude"))


@query(f"with {_FILE} select cc country, cls || '.' || code full_code, count(*)::bigint n from f where geonameId is not null and latitude is not null and longitude is not null and cc in ('XK', 'QM', 'ZB', 'XT') and cc <> 'XK' and (cls in ('H', 'A') or cls || '.' || code in ('P.PPL', 'P.PPLA')) group by all")
def src_gazetteer_filters(spark, d):
    p = gazetteer.by_country(gazetteer.cleanse(_dump(spark, d)), ["xk", "QM", "zb", "XT"], ["xk"])
    return gazetteer.by_feature(p, ["H", "A", "P.PPL", "P.PPLA"]).groupBy(F.col("countryCode").alias("country"), F.col("fullFeatureCode").alias("full_code")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_FILE} select full_code, n, round(100.0::double * n / sum(n) over (), 2) pct from (select cls || '.' || code full_code, count(*)::bigint n from f where geonameId is not null and latitude is not null and longitude is not null group by 1) order by n desc, full_code limit 50")
def src_top_codes(spark, d):
    return gazetteer.top_codes(gazetteer.cleanse(_dump(spark, d))).withColumnRenamed("fullFeatureCode", "full_code")


@query("select count(*)::bigint n from place")
def src_resume(spark, d):
    """What a load that broke off after 100 rows and one that goes on from there read together."""
    raw = _dump(spark, d)
    rest = gazetteer.after(raw, 100)
    return rest.agg((F.count(F.lit(1)) + 100).alias("n")) if not raw.limit(101).offset(100).isEmpty() else raw.agg(F.count(F.lit(1)).alias("n"))


@query("""select count(*)::bigint "rows", count(*) filter (geonameId is not null and latitude is not null and longitude is not null)::bigint kept, count(*) filter (geonameId is null)::bigint without_id,
 count(*) filter (geonameId is not null and (latitude is null or longitude is null))::bigint without_position from place""")
def src_dry_run(spark, d):
    return gazetteer.dry_run(_dump(spark, d))


# ---- entity dump


def _claim(kind: str, value: Column) -> Column:
    """One statement, null where its value is."""
    snak = F.struct(F.lit("value").alias("snaktype"), F.struct(F.lit(kind).alias("type"), value.alias("value")).alias("datavalue"))
    return F.when(value.isNotNull(), F.array(F.struct(snak.alias("mainsnak"))))


def _claims(**of: Column) -> Column:
    return F.struct(*[c.alias(k) for k, c in of.items()]).alias("claims")


_item = lambda c: _claim("wikibase-entityid", F.when(c.isNotNull(), F.struct(c.alias("id"))))
_string = lambda c: _claim("string", c)
_time = lambda c: _claim("time", F.when(c.isNotNull(), F.struct(F.concat(F.lit("+"), c, F.lit("T00:00:00Z")).alias("time"))))
_amount = lambda c: _claim("quantity", F.when(c.isNotNull(), F.struct(F.concat(F.lit("+"), c.cast("string")).alias("amount"))))
_in_english = lambda c: F.when(c.isNotNull(), F.struct(F.struct(c.alias("value")).alias("en")))


def _entities(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Entity rows as dump lines with the brackets and commas of one array, read back."""
    path = _folder(spark, label)
    lines = rows.select(F.concat(F.to_json(F.struct(*rows.columns)), F.lit(",")).alias("value"))
    frame = spark.createDataFrame([("[",), ("]",), ("",), ("{broken",)], "value string")
    lines.unionByName(frame).write.text(path, compression="gzip")
    return entity_dump.read(spark, path, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _places_dump(spark, d):
    w = entities(spark, d, "name description alternateNames population inceptionDate dissolvedDate replacesQid replacedByQid countryQid lat lon label")
    spot = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")))
    kind = F.when(F.col("label") == "post office", "Q43229").otherwise("Q486972")
    return _entities(spark, w.select(
        F.col("qid").alias("id"), _in_english(F.col("name")).alias("labels"), _in_english(F.col("description")).alias("descriptions"),
        F.when(F.size("alternateNames") > 0, F.struct(F.transform("alternateNames", lambda x: F.struct(x.alias("value"))).alias("en"))).alias("aliases"),
        _claims(P625=_claim("globecoordinate", spot), P31=_item(kind), P1082=_amount(F.col("population")), P571=_time(F.col("inceptionDate")), P576=_time(F.col("dissolvedDate")), P1365=_item(F.col("replacesQid")), P1366=_item(F.col("replacedByQid")), P17=_item(F.col("countryQid")), P131=_item(F.col("countryQid"))),
        F.when(F.col("name").isNotNull(), F.struct(F.struct(F.col("name").alias("title")).alias("enwiki"))).alias("sitelinks"),
    ), "entities")


@query("""select qid, coalesce(nullif("name", ''), qid) "name", description, lat latitude, lon longitude, nullif(population, 0) population, inceptionDate, dissolvedDate, replacesQid, replacedByQid, countryQid,
 case when label = 'post office' then 'Q43229' else 'Q486972' end kind, 'https://en.wikipedia.org/wiki/' || replace("name", ' ', '_') url,
 len(list_filter(list_distinct(coalesce(alternateNames, [])), lambda x: x is not null and x <> coalesce(nullif("name", ''), qid)))::int others from {w} where lat is not null and lon is not null""")
def src_entity_places(spark, d):
    g = entity_dump.geographic(_places_dump(spark, d))
    return g.select(
        "qid", "name", "description", "latitude", "longitude", "population", "inceptionDate", "dissolvedDate", "replacesQid", "replacedByQid", "countryQid", F.col("instanceOfQid").alias("kind"),
        F.col("wikipediaUrl").alias("url"), F.coalesce(F.size("alternateNames"), F.lit(0)).alias("others"),
    )


@query("""select qid, "name", inceptionDate founded, countryQid located from {w} where label = 'post office' and countryQid is not null and "name" <> ''""")
def src_entity_organisations(spark, d):
    return entity_dump.organisations(_places_dump(spark, d)).select(F.col("wikidataId").alias("qid"), "name", "founded", F.col("locatedInQid").alias("located"))


@query("""select count(*)::bigint with_coordinates, 0::bigint with_geonames, count(*) filter (len(list_filter(coalesce(alternateNames, []), lambda x: x is not null and x <> coalesce(nullif("name", ''), qid))) > 0)::bigint with_alternate_names,
 count(*) filter (label = 'post office')::bigint historical_entities, 0::bigint colonial_entities, 0::bigint with_cross_db_ids from {w} where lat is not null and lon is not null""")
def src_entity_counters(spark, d):
    return entity_dump.counters(entity_dump.geographic(_places_dump(spark, d), ["Q43229"]))


@query("""select personId person_id, "name", birthDate born, deathDate died, viaf, case when len(bornIn) > 0 then 'Q' || bornIn[1] end birth_place, len(occupations[:5])::int occupations
 from (select h.*, nullif(trim(v.viafId), '') viaf from {h} join (select personId, viafId from (select personId, viafId, row_number() over (partition by personId order by loadedAt desc nulls last) r from historicalperson) where r = 1) v using (personId)) where coalesce(len(bornIn), 0) + coalesce(len(diedIn), 0) > 0 and "name" <> ''""")
def src_entity_people(spark, d):
    raw = in_force(table(spark, d, "historicalperson"), "personId", ["viafId"]).select("personId", text.non_empty(F.col("viafId")).alias("viaf"))
    h = persons(spark, d, "name birthDate deathDate bornIn diedIn occupations").join(raw, "personId")
    place = lambda c: F.when(F.size(c) > 0, F.concat(F.lit("Q"), F.get(F.col(c), F.lit(0)).cast("string")))
    jobs = F.when(F.size("occupations") > 0, F.transform("occupations", lambda o: F.struct(F.struct(F.lit("value").alias("snaktype"), F.struct(F.lit("wikibase-entityid").alias("type"), F.struct(o.alias("id")).alias("value")).alias("datavalue")).alias("mainsnak"))))
    e = _entities(spark, h.select(
        F.col("personId").alias("id"), _in_english(F.col("name")).alias("labels"),
        _claims(P31=_item(F.lit("Q5")), P569=_time(F.col("birthDate")), P570=_time(F.col("deathDate")), P19=_item(place("bornIn")), P20=_item(place("diedIn")), P106=jobs, P214=_string(F.col("viaf"))),
    ), "people")
    return entity_dump.people(e).select(
        F.col("wikidataId").alias("person_id"), "name", F.col("dateOfBirth").alias("born"), F.col("dateOfDeath").alias("died"), F.col("viafId").alias("viaf"), F.col("birthPlaceQid").alias("birth_place"), F.coalesce(F.size("occupationQids"), F.lit(0)).alias("occupations"),
    )


# ---- JSON documents, registers, query results


@query("select geonameId, \"name\", lat, population from {p}")
def src_lines(spark, d):
    path = _folder(spark, "lines")
    documents.write_lines(places(spark, d, "name lat population"), path, {"table": "place"})
    return documents.lines(spark, path, "geonameId long, name string, lat double, population long")


@query("select code, \"name\", qid from country")
def src_document(spark, d):
    path = _folder(spark, "document")
    documents.write_document(table(spark, d, "country").select("code", "name", "qid"), path, "places", {"table": "country"})
    return documents.cache(spark, path, "code string, name string, qid string")


@query("select countryCode country, count(*)::bigint n, min(geonameId) least from {p} where countryCode is not null group by 1")
def src_partitioned_cache(spark, d):
    """A cache by country; one country's folder is dropped and written anew."""
    path = _folder(spark, "cache")
    p = places(spark, d, "countryCode name").where("countryCode is not null").withColumnRenamed("countryCode", "country")
    documents.partitioned(p, path, "country")
    return documents.lines(spark, path, "geonameId long, name string, country string").groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.min("geonameId").alias("least"))


@query("""select qid, nullif(trim("name"), '') "name", inceptionDate, lat latitude, lon longitude, countryQid, array_to_string(list_filter(alternateNames, lambda x: x <> ''), ';') others from {w} where not exists (select 1 from (select unnest(alternateNames) a) where contains(a, '|'))""")
def src_bindings(spark, d):
    """Results of an endpoint in its JSON format, some thousand rows a document."""
    w = entities(spark, d, "name inceptionDate lat lon countryQid alternateNames").where(~F.exists(F.coalesce("alternateNames", F.array().cast("array<string>")), lambda x: x.contains("|")))
    v = lambda c: F.when(c.isNotNull(), F.struct(c.alias("value")))
    b = w.select(
        F.struct(
            v(F.concat(F.lit("http://www.wikidata.org/entity/"), "qid")).alias("item"), v(F.col("name")).alias("name"), v(F.concat(F.lit("+"), "inceptionDate", F.lit("T00:00:00Z"))).alias("inceptionDate"),
            v(F.when(F.col("lat").isNotNull(), F.concat(F.lit("Point("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")")))).alias("coord"),
            v(F.concat(F.lit("http://www.wikidata.org/entity/"), "countryQid")).alias("countryQid"), v(F.array_join("alternateNames", "|")).alias("alternateNames"),
        ).alias("b"),
        F.floor(F.rand(7) * F.lit(1 + table(spark, d, "wikidataplace").count() // 2000)).alias("page"),
    )
    path = _folder(spark, "bindings")
    page = b.groupBy("page").agg(F.collect_list("b").alias("bindings"))
    page.select(F.to_json(F.struct(F.struct("bindings").alias("results"))).alias("value")).write.text(path)
    names = ["item", "name", "inceptionDate", "coord", "countryQid", "alternateNames"]
    doc = spark.read.text(path).select(F.from_json("value", "results struct<bindings: array<struct<" + ", ".join(f"{n} struct<value:string>" for n in names) + ">>>").alias("r"))
    rows = documents.entity_columns(doc.select(F.inline("r.results.bindings")).select(*[F.col(n)["value"].alias(n) for n in names]))
    return rows.select("qid", "name", "inceptionDate", "latitude", "longitude", "countryQid", F.array_join("alternateNames", ";").alias("others"))


@query("""select qid, array_to_string(list_sort(list_distinct(l)), ';') as names from (select qid, list_filter(list_concat(coalesce(alternateNames, []), ["name"]), lambda x: x is not null) l from {w}) where len(l) > 0""")
def src_alt_labels(spark, d):
    w = entities(spark, d, "name alternateNames officialNames")
    rows = w.select("qid", F.inline(F.concat(
        F.transform(F.coalesce("alternateNames", F.array().cast("array<string>")), lambda x: F.struct(F.lit("fr").alias("lang"), x.alias("label"))),
        F.array(F.struct(F.lit("en").alias("lang"), F.col("name").alias("label"))),
        F.transform(F.coalesce("officialNames", F.array().cast("array<string>")), lambda x: F.struct(F.lit("xx").alias("lang"), x.alias("label"))),
    ))).where("label is not null")
    return documents.alt_labels(rows).select("qid", F.array_join("names", ";").alias("names"))


_YEAR = "try_cast(nullif(regexp_extract({x}, '^([0-9][0-9][0-9][0-9])', 1), '') as int)"


@query(f"""select substr(qid, 2)::bigint id, "name", {_YEAR.format(x='inceptionDate')} opened, {_YEAR.format(x="coalesce(dissolvedDate, '')")} closed, {_YEAR.format(x="coalesce(dissolvedDate, '')")} is null is_open,
 trim(regexp_replace(lower(trim("name")), '\\s+(post office|p\\.?o\\.?|m\\.?p\\.?o\\.?).*$', '')) normal from {{w}} where label = 'post office' and {_YEAR.format(x='inceptionDate')} is not null and "name" <> '' and "name" = trim("name")""")
def src_offices(spark, d):
    """A register of post offices whose dates are written in six ways."""
    year = lambda c: text.non_empty(F.regexp_extract(F.coalesce(c, F.lit("")), "^([0-9]{4})", 1))
    w = entities(spark, d, "name label inceptionDate dissolvedDate").where("label = 'post office' and name <> '' and name = trim(name)").withColumns({"o": year("inceptionDate"), "z": year("dissolvedDate")}).where("o is not null")
    number = F.substr("qid", F.lit(2)).cast("bigint")
    written = F.lit(None).cast("string")
    for k, (before, after) in enumerate((("", "-05-17"), ("", "/05/17"), ("05/17/", ""), ("17 May ", ""), ("May 17, ", ""), ("", ""))):
        written = F.when(F.pmod(number, F.lit(6)) == k, F.concat(F.lit(before), F.col("o"), F.lit(after))).otherwise(written)
    path = _folder(spark, "offices")
    w.select(number.alias("IdNumber"), F.col("name").alias("Name"), F.lit("Ontario").alias("Province"), written.alias("EstablishedDate"), F.col("z").alias("ClosingDate")).write.csv(path, header=True, escape='"')
    return documents.offices(spark, path).select(F.col("idNumber").alias("id"), "name", F.col("establishedYear").alias("opened"), F.col("closingYear").alias("closed"), F.col("isOpen").alias("is_open"), F.col("normalizedName").alias("normal"))


@query("select code, \"name\", 'Q' || regexp_extract(qid, '([0-9]+)', 1) qid from country where code is not null")
def src_paged(spark, d):
    """The country list through a paged endpoint that serves it in pages of 7."""
    rows = sorted((r.code, r["name"], r.qid) for r in table(spark, d, "country").where("code is not null").collect())

    def fetch(_: str, statement: str) -> dict:
        size, start = (int(statement.split(w)[1].split()[0]) for w in ("LIMIT", "OFFSET"))
        return {"results": {"bindings": [{k: {"value": v} for k, v in zip(("code", "name", "qid"), r) if v is not None} for r in rows[start : start + size]]}}

    sparql.register(spark, fetch)
    got = spark.read.format("sparql").schema("code string, name string, qid string").option("query", "SELECT ?code ?name ?qid ORDER BY ?code").option("page", "7").option("pages", "3").load()
    return got.select("code", "name", ids.qid(F.col("qid")).alias("qid"))


@query("select distinct code, code || '!' answer from country where code is not null")
def src_fetch_by_key(spark, d):
    echo = lambda _, q: {"results": {"bindings": [{"answer": {"value": q.split()[-1] + "!"}}]}}
    codes = table(spark, d, "country").where("code is not null").select("code")
    return sparql.by_key(codes, "answer {key}", "answer string", _folder(spark, "fetched") + "/cache", echo).withColumnRenamed("key", "code")


@query("select distinct qid from {w}")
def src_fetch_by_ids(spark, d):
    echo = lambda _, q: {"results": {"bindings": [{"qid": {"value": x.removeprefix("wd:")}} for x in q.split("{")[1].rstrip("} ").split()]}}
    return sparql.by_ids(entities(spark, d, "").select("qid"), "VALUES ?item {{values} }", "qid string", echo).distinct()


# ---- Turtle and N-Triples


def _people(spark: SparkSession, d: str) -> DataFrame:
    """Persons in force by their bare id, with the address that stands for them."""
    raw = table(spark, d, "historicalperson").withColumn("personId", ids.person_id(F.col("personId"))).where("personId is not null")
    p = in_force(raw, "personId", ["name", "birthEvent", "occupations"]).select("personId", "name", "occupations", F.col("birthEvent.date").alias("born"), ids.person_id(F.col("birthEvent.motherId")).alias("mother"))
    return p.select("*", _address(F.col("personId")).alias("uri"), _address(F.col("mother")).alias("mother_uri"))


def _address(pid: Column) -> Column:
    tail = F.substring_index(pid, ":", -1)
    return F.when(pid.startswith("viaf:"), F.concat(F.lit("http://viaf.org/viaf/"), tail)).when(pid.startswith("wd:"), F.concat(F.lit("http://www.wikidata.org/entity/"), tail)).otherwise(F.concat(F.lit("http://lincs.example/"), F.hex(pid)))


_KEY = "case when {x} like 'viaf:%' or {x} like 'wd:%' then {x} else 'lincs:' || hex({x}) end"
_FOLK = f"""folk as (select pid, "name", occupations, date born, m mother from (select *, row_number() over (partition by pid order by loadedAt desc nulls last) r from (select {_pid('personId')} pid, "name", occupations, birthEvent.date date, {_pid('birthEvent.motherId')} m, loadedAt from historicalperson)) where r = 1 and pid is not null)"""


@query(f"""with {_FOLK} select {_KEY.format(x='a.pid')} person_id, case when a.pid like 'viaf:%' then 'VIAF' when a.pid like 'wd:%' then 'Wikidata' else 'LINCS' end id_type, coalesce(a."name", 'Unknown') "name", a.born, {_KEY.format(x='b.pid')} mother
 from folk a left join folk b on b.pid = a.mother and (a.born is not null or a.mother is not null)""".replace("else 'lincs:' || hex(b.pid) end mother", "when b.pid is not null then 'lincs:' || hex(b.pid) end mother"))
def src_turtle_persons(spark, d):
    return rdf.persons(_triples(spark, d)).select(F.col("personId").alias("person_id"), F.col("idType").alias("id_type"), "name", F.col("birthEvent.date").alias("born"), F.col("birthEvent.motherId").alias("mother"))


@query(f"""with {_FOLK} select case when pid like 'viaf:%' then 'VIAF' when pid like 'wd:%' then 'Wikidata' else 'LINCS' end id_type, count(*)::bigint n from folk where born is not null or mother is not null group by 1""")
def src_turtle_plausible(spark, d):
    return rdf.plausible(rdf.persons(_triples(spark, d))).groupBy(F.col("idType").alias("id_type")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_FOLK} select {_KEY.format(x='pid')} person_id, "name", coalesce(array_to_string(list_sort(occupations), ';'), '') roles from folk""")
def src_turtle_agents(spark, d):
    roles = F.array_join(F.array_sort(F.transform("occupations", lambda o: o["role"])), ";")
    return rdf.agents(_triples(spark, d)).select(F.col("lincsId").alias("person_id"), "name", F.coalesce(roles, F.lit("")).alias("roles"))


def _triples(spark: SparkSession, d: str) -> DataFrame:
    """Persons, births and activities as Turtle with prefixes, brackets and lists of predicates, read back."""
    p = _people(spark, d)
    text_of = lambda c: F.when(F.col(c).isNotNull(), F.expr(f"substr(to_json(array({c})), 2, length(to_json(array({c}))) - 2)"))
    iri = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    head = F.lit("@prefix crm: <http://www.cidoc-crm.org/cidoc-crm/> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . ")
    who = F.concat(iri(F.col("uri")), F.lit(" a crm:E21_Person"), F.coalesce(F.concat(F.lit(" ; rdfs:label "), text_of("name"), F.lit("@en")), F.lit("")), F.lit(" . "))
    span = F.coalesce(F.concat(F.lit(" ; crm:P4_has_time-span [ a crm:E52_Time-Span ; crm:P82_at_some_time_within "), text_of("born"), F.lit(" ]")), F.lit(""))
    mother = F.coalesce(F.concat(F.lit(" ; crm:P96_by_mother "), iri(F.col("mother_uri"))), F.lit(""))
    birth = F.when(F.col("born").isNotNull() | F.col("mother").isNotNull(), F.concat(F.lit("[] a crm:E67_Birth ; crm:P98_brought_into_life "), iri(F.col("uri")), span, mother, F.lit(" ."))).otherwise("")
    path = _folder(spark, "turtle")
    # A file is read whole by one task: some thousand persons each.
    n = max(1, table(spark, d, "historicalperson").count() // 5000)
    jobs = F.array_join(F.transform("occupations", lambda o: F.concat(F.lit(' [] a crm:E7_Activity ; rdfs:label "'), o, F.lit(' occupation of someone" ; crm:P14_carried_out_by '), iri(F.col("uri")), F.lit(" ."))), "")
    p.select(F.concat(head, who, birth, F.coalesce(jobs, F.lit(""))).alias("value")).repartition(n).write.text(path)
    return Scratch(spark, "triples").save(rdf.turtle(spark, path), "triples")


@query(f"""with {_FOLK} select 'label' what, count(*)::bigint n from folk where "name" is not null union all select 'mother', count(*) from folk where mother is not null""")
def src_ntriples(spark, d):
    p = _people(spark, d)
    iri = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    rows = F.array_compact(F.array(
        F.concat(iri(F.col("uri")), F.lit(f" <{rdf.LABEL}> "), F.expr("substr(to_json(array(name)), 2, length(to_json(array(name))) - 2)"), F.lit(" .")),
        F.concat(iri(F.col("uri")), F.lit(f" <{rdf.CRM}P96_by_mother> "), iri(F.col("mother_uri")), F.lit(" .")),
    ))
    path = _folder(spark, "ntriples")
    p.select(F.explode(rows).alias("value")).unionByName(spark.createDataFrame([("# remark",), ("broken line",)], "value string")).write.text(path)
    what = F.when((F.col("p") == rdf.LABEL) & (F.col("o_kind") == "literal"), "label").when(F.col("p").endswith("mother") & (F.col("o_kind") == "iri"), "mother")
    return rdf.ntriples(spark, path).groupBy(what.alias("what")).agg(F.count(F.lit(1)).alias("n"))


# ---- graph statements, first wins, small functions


@query("""select count(*)::bigint statements, count(*) filter (population is not null)::bigint with_population, sum(geonameId)::bigint sum_ids from {p}""")
def src_statements(spark, d):
    path = _folder(spark, "statements")
    documents.write_statements(places(spark, d, "population"), "Place", path)
    t = spark.read.text(path).where(F.col("value").rlike(r"^CREATE \(:Place \{.*\}\);$"))
    return t.agg(F.count(F.lit(1)).alias("statements"), F.count_if(F.col("value").contains("population: ")).alias("with_population"), F.sum(F.regexp_extract("value", r"geonameId: (\d+)", 1).cast("bigint")).alias("sum_ids"))


@query("""select qid, "name", description from (select *, row_number() over (partition by qid order by loadedAt, "name" nulls last, description nulls last) r from wikidataplace) where r = 1""")
def src_first_wins(spark, d):
    """Union of several fetches, the first delivery of each entity kept whole."""
    w = table(spark, d, "wikidataplace").select("qid", "name", "description", "loadedAt")
    part = F.pmod(F.xxhash64("qid", "loadedAt"), F.lit(3))
    union = w.where(part == 0).unionByName(w.where(part == 1)).unionByName(w.where(part == 2))
    return tables.first_wins(union, ["qid"], [F.col("loadedAt"), F.col("name").asc_nulls_last(), F.col("description").asc_nulls_last()]).select("qid", "name", "description")


@query("""select doc_id, case when regexp_matches(published, '^-?[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]') then regexp_extract(published, '^(-?[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9])', 1) when regexp_matches(published, '[0-9][0-9][0-9][0-9]') then regexp_extract(published, '([0-9][0-9][0-9][0-9])', 1) else published end published,
 case when about_geoname_id is not null then about_geoname_id end about from documents""")
def fn_dates_and_urls(spark, d):
    t = table(spark, d, "documents")
    url = F.concat(F.lit("https://sws.geonames.example/"), F.col("about_geoname_id").cast("string"), F.lit("/"))
    return t.select("doc_id", text.normal_date(F.col("published")).alias("published"), text.url_number(url).alias("about"))


@query("""select personId person_id, case when len(occupations) > 0 and "name" is not null then occupations[1] else 'Unknown' end role, coalesce("name", personId) label, coalesce(occupations[:2], [])[1] first_of_two from {h}""")
def fn_roles_and_labels(spark, d):
    h = persons(spark, d, "name occupations")
    job = F.get("occupations", F.lit(0))
    labels = F.when(F.col("name").isNotNull(), F.create_map(F.lit("en"), F.struct(F.col("name").alias("value"))))
    return h.select(
        F.col("personId").alias("person_id"), text.occupation_role(F.coalesce(F.concat(job, F.lit(" occupation of "), "name"), F.lit(""))).alias("role"), text.label_or(labels, F.col("personId")).alias("label"),
        F.get(F.slice("occupations", 1, 2), F.lit(0)).alias("first_of_two"),
    )


_PROVINCES = ", ".join(f"('{k}', '{';'.join(v)}')" for k, v in text.PROVINCES.items())


@query(f"select geonameId, province, codes from (select geonameId, (geonameId % {len(text.PROVINCES) + 1})::int k from {{p}}) left join (select *, row_number() over () - 1 k from (values {_PROVINCES}) t(province, codes)) using (k)")
def fn_province_codes(spark, d):
    names = F.array(*[F.lit(k) for k in text.PROVINCES])
    p = places(spark, d, "").select("geonameId", F.get(names, F.pmod("geonameId", F.lit(len(text.PROVINCES) + 1)).cast("int")).alias("province"))
    return p.withColumn("codes", F.array_join(text.province_codes(F.col("province")), ";"))


@query(f"select geonameId, latitude, longitude, case when latitude <> 0 and longitude <> 0 and not isnan(latitude) and not isnan(longitude) then true else false end usable, coalesce({_qid('wikidataId')}, '') qid from place where geonameId is not null")
def fn_truthy(spark, d):
    """Non-zero truth of numbers: null, 0 and no number count as false."""
    true = lambda c: F.coalesce((F.col(c) != 0) & ~F.isnan(c), F.lit(False))
    return table(spark, d, "place").where("geonameId is not null").select("geonameId", "latitude", "longitude", (true("latitude") & true("longitude")).alias("usable"), F.coalesce(ids.qid(F.col("wikidataId")), F.lit("")).alias("qid"))


# ---- tables that grow, and incremental ingest


@query("select 'appended' step, count(*)::bigint n from place union all select 'cleared', 0 union all select 'loaded', count(*)::bigint from place where geonameId % 2 = 0")
def sink_append_and_clear(spark, d):
    """A table loaded with half of place, with the rest appended, and emptied."""
    t = table(spark, d, "place").select("geonameId", "name")
    even, path = F.coalesce(F.pmod("geonameId", F.lit(2)) == 0, F.lit(False)), _folder(spark, "table")
    counts = []
    for step, write in (("loaded", lambda: t.where(even).write.parquet(path)), ("appended", lambda: t.where(~even).write.mode("append").parquet(path)), ("cleared", lambda: t.limit(0).write.mode("overwrite").parquet(path))):
        write()
        counts.append((step, spark.read.schema(t.schema).parquet(path).count()))
    return spark.createDataFrame(counts, "step string, n long")


@query("select code child, parent from (select code, unnest([qid, \"name\"]) parent from country) where parent is not null")
def src_adjacency(spark, d):
    path = _folder(spark, "adjacency")
    pairs = table(spark, d, "country").where("code is not null").select(F.struct("code", F.array_compact(F.array("qid", "name"))).alias("e"))
    pairs.agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value")).coalesce(1).write.text(path)
    return documents.adjacency(spark, path)


_DAY = "(select * from (select *, row_number() over (partition by geonameId order by loadedAt desc nulls last) r from place where geonameId is not null and {cut}) where r = 1)"


@query(f"""with a as (select * from {_DAY.format(cut="loadedAt < '2024-01-01'")} where latitude is not null and longitude is not null), b as (select * from {_DAY.format(cut="loadedAt >= '2024-01-01'")} where latitude is not null and longitude is not null)
 select coalesce(b.geonameId, a.geonameId) geonameId, coalesce(nullif(b."name", ''), nullif(a."name", '')) "name", coalesce(b.population, a.population, 0) population, coalesce(nullif(b.countryCode, ''), nullif(a.countryCode, '')) country
 from a full join b on a.geonameId = b.geonameId where coalesce(b.geonameId, a.geonameId) % 10 <> 3""")
def stream_ingest(spark, d):
    """Two days of changed places and one of removals, each taken in by a run of its own."""
    folder = _folder(spark, "stream")
    t = table(spark, d, "place").where("geonameId is not null")
    cols = ["name", "latitude", "longitude", "countryCode", "population", "modifiedDate"]
    for day, cut in ((1, F.col("loadedAt") < F.lit("2024-01-01").cast("timestamp_ntz")), (2, F.col("loadedAt") >= F.lit("2024-01-01").cast("timestamp_ntz"))):
        rows = in_force(t.where(cut), "geonameId", cols).withColumnsRenamed({"geonameId": "geonameid", "countryCode": "country_code", "modifiedDate": "modification_date"})
        gazetteer.write(rows, f"{folder}/day{day}")
        increment.changes(spark, f"{folder}/day{day}", f"{folder}/table", f"{folder}/seen{day}")
    gone = t.where("pmod(geonameId, 10) = 3").select(F.concat_ws("\t", F.col("geonameId").cast("string"), F.lit("x"), F.lit("removed")).alias("value")).distinct()
    gone.write.text(f"{folder}/removed")
    increment.removals(spark, f"{folder}/removed", f"{folder}/table", f"{folder}/seen")
    return increment.current(spark, f"{folder}/table").select("geonameId", "name", "population", F.col("countryCode").alias("country"))
