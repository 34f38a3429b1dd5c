import gzip
import json

import pytest
from pyspark.sql import functions as F

from geoweave.sources import documents, entity_dump, gazetteer, rdf, sparql
from geoweave.streaming import increment
from tests.test_core_problems import rows


def line(i, name="N", alt="", lat="1.5", lon="2.5", cls="P", code="PPL", cc="CA", a1="01", pop="5", elev="", date="2020-01-01"):
    return "\t".join([str(i), name, name, alt, lat, lon, cls, code, cc, "", a1, "", "", "", pop, elev, "", "Z", date])


def test_gazetteer(spark, tmp_path):
    f = tmp_path / "g.txt"
    f.write_text("\n".join([line(1, '"Quoted', " a, ,b "), line("x"), line(3, lat=""), line(4, cls="A", code="ADM1", cc="US", pop="", elev="-3"), line(5, cls="H", code="LK")]), encoding="utf-8")
    raw = gazetteer.read(spark, str(f))
    p = gazetteer.cleanse(raw)
    got = {r.geonameId: r for r in p.collect()}
    assert set(got) == {1, 4, 5} and got[1].name == '"Quoted' and got[1].alternateNames == ["a", "b"] and (got[4].population, got[4].elevation) == (0, -3) and got[4].admin2Code == ""
    assert gazetteer.cleanse(raw, keep_without_position=True).count() == 4
    assert rows(gazetteer.by_country(p, ["ca", "us"], ["us"]).select("geonameId")) == [(1,), (5,)]
    assert rows(gazetteer.by_feature(p, ["H", "P.PPL"]).select("geonameId")) == [(1,), (5,)]
    assert gazetteer.top_codes(p, 1).first().n == 1 and gazetteer.after(raw, 3).count() == 2


def claim(kind, value, snak="value"):
    return {"mainsnak": {"snaktype": snak, "datavalue": {"type": kind, "value": value}}}


def test_entity_dump(spark, tmp_path):
    item = lambda q: claim("wikibase-entityid", {"id": q})
    es = [
        {"id": "Q1", "labels": {"fr": {"value": "Lieu"}}, "aliases": {"en": [{"value": "Alias"}, {"value": "Lieu"}]}, "claims": {"P625": [claim("globecoordinate", {}, "novalue"), claim("globecoordinate", {"latitude": 1, "longitude": 2})], "P31": [item("Q9")], "P1082": [claim("quantity", {"amount": "+1234.9"})], "P571": [claim("time", {"time": "-0044-03-15T00:00:00Z"})], "P1566": [claim("string", "55")], "P112": [item("Q7")], "P127": [item("Q8")]}, "sitelinks": {"enwiki": {"title": "A b"}}},
        {"id": "Q2", "labels": {"en": {"value": "Ann"}}, "claims": {"P31": [item("Q5")], "P19": [item("Q1")], "P106": [item("Q10"), claim("x", {}, "novalue"), *[item(f"Q{i}") for i in range(20, 30)]]}},
        {"id": "Q3", "labels": {"fr": {"value": "Sans"}}, "claims": {"P31": [item("Q5")], "P19": [item("Q1")]}},
        {"id": "Q4", "labels": {"en": {"value": "Firm"}}, "claims": {"P31": [item("Q783794")], "P159": [item("Q1")], "P1448": [claim("monolingualtext", {"text": "Firm Ltd", "language": "en"})]}},
        {"id": "Q6", "labels": {}, "claims": {}},
    ]
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        f.write("[\n" + ",\n".join(json.dumps(e) for e in es) + ",\n\n{broken\n]\n")
    e = entity_dump.read(spark, str(tmp_path / "d.json.gz"), 2)
    assert e.where("not ok").count() == 1
    geo = entity_dump.geographic(e, ["Q9"])
    g = geo.collect()
    assert len(g) == 1 and (g[0].qid, g[0].name, g[0].latitude, g[0].population, g[0].inceptionDate, g[0].alternateNames, g[0].isHistorical, g[0].wikipediaUrl) == ("Q1", "Lieu", 1.0, 1234, "-0044-03-15", ["Alias"], True, "https://en.wikipedia.org/wiki/A_b")
    p = entity_dump.people(e).collect()
    assert [(x.wikidataId, x.birthPlaceQid, x.occupationQids) for x in p] == [("Q2", "Q1", ["Q10", "Q20", "Q21", "Q22"])]
    o = entity_dump.organisations(e).collect()
    assert [(x.wikidataId, x.headquartersQid, x.officialName) for x in o] == [("Q4", "Q1", "Firm Ltd")]
    assert entity_dump.counters(geo).first().colonial_entities == 2


def test_json_documents(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"metadata": {"n": "1"}, "places": [{"qid": "Q1", "population": "5"}]}, indent=1))
    assert rows(documents.cache(spark, str(tmp_path / "c.json"), "qid string, population string")) == [("Q1", "5")]
    (tmp_path / "l.json").write_text('{"metadata": {"n": 1}}\n{"qid": "Q1"}\n{"qid": "Q2"}\n')
    assert rows(documents.lines(spark, str(tmp_path / "l.json"), "qid string")) == [("Q1",), ("Q2",)]
    (tmp_path / "a.json").write_text('[{"code": "CA", "name": "x"}]')
    assert documents.array(spark, str(tmp_path / "a.json"), "code string, name string").count() == 1
    (tmp_path / "p.json").write_text('{"Q1": ["Q2", "Q3"], "Q4": []}')
    assert rows(documents.adjacency(spark, str(tmp_path / "p.json"))) == [("Q1", "Q2"), ("Q1", "Q3")]
    b = {"results": {"bindings": [{"item": {"value": "http://e.example/Q5"}, "coord": {"value": "Point(2.5 1.5)"}, "inceptionDate": {"value": "1867-07-01T00:00:00Z"}, "altNames": {"value": "a|b"}}, {"item": {"value": "http://e.example/Q6"}}]}}
    (tmp_path / "b.json").write_text(json.dumps(b))
    got = documents.entity_columns(documents.bindings(spark, str(tmp_path / "b.json"), ["item", "coord", "inceptionDate", "altNames"])).orderBy("qid").collect()
    assert tuple(got[0]) == ("Q5", 1.5, 2.5, "1867-07-01", ["a", "b"]) and got[1].latitude is None
    (tmp_path / "o.csv").write_text("IdNumber,Name,Province,EstablishedDate,ClosingDate\n1,Regina Post Office,Saskatchewan,1883-01-02,\n2,X P.O.,Nowhere,1/2/1900,bad\n")
    o = documents.offices(spark, str(tmp_path / "o.csv")).orderBy("idNumber").collect()
    assert [(x.establishedYear, x.closingYear, x.isOpen, x.normalizedName) for x in o] == [(1883, None, True, "regina"), (None, None, False, "x")]
    lab = spark.createDataFrame([("Q1", "b", "en"), ("Q1", "a", "fr"), ("Q1", "c", "de"), ("Q1", "a", "")], "qid string, label string, lang string")
    assert documents.alt_labels(lab).first().names == ["a", "b"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "x"', ["a", "b"]), (2, None, [])], "id int, name string, alt array<string>")
    documents.write_lines(df, str(tmp_path / "l"), {"rows": 2})
    assert documents.lines(spark, str(tmp_path / "l"), "id int, name string, alt array<string>").count() == 2
    documents.write_document(df, str(tmp_path / "d"), "places", {"rows": 2})
    assert documents.cache(spark, str(tmp_path / "d"), "id int, name string").count() == 2
    documents.write_statements(df, "Place", str(tmp_path / "s"))
    s = sorted(r[0] for r in spark.read.text(str(tmp_path / "s")).collect())
    assert s[0] == 'CREATE (:Place {id: 1, name: "say \\"x\\"", alt: ["a","b"]});' and s[1] == "CREATE (:Place {id: 2, alt: []});"
    documents.partitioned(df.withColumn("cc", F.lit("CA")), str(tmp_path / "p"), "cc")
    flows = spark.createDataFrame([("GB", "CA", 9), ("CA", "CA", 4)], "birth string, death string, n long")
    m = documents.migration_summary(flows, spark.createDataFrame([("p2",), ("p1",)], "personId string")).first()
    assert (m.total, m.cross_border_pairs, m.domestic_people, m.sample_people, m.top_flows[0].n) == (13, 1, 4, ["p1", "p2"], 9)


TTL = """@prefix crm: <http://www.cidoc-crm.org/cidoc-crm/> . @prefix ex: <http://lincs.example/> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . @prefix owl: <http://www.w3.org/2002/07/owl#> . # comment
ex:a a crm:E21_Person ; rdfs:label "Ann \\"A\\""@en, "Anna" ; owl:sameAs <http://www.wikidata.org/entity/Q5> .
ex:m a crm:E21_Person ; rdfs:label "Mother" . <http://viaf.org/viaf/77/> a crm:E21_Person .
ex:b a crm:E67_Birth ; crm:P98_brought_into_life ex:a ; crm:P96_by_mother ex:m ; crm:P7_took_place_at <https://sws.geonames.org/6098717/> ; crm:P4_has_time-span ex:ts .
ex:ts a crm:E52_Time-Span ; crm:P82_at_some_time_within "1850" ; crm:P82a_begin_of_the_begin "1850-01-01"^^<http://x/date> .
ex:j a crm:E85_Joining ; crm:P143_joined ex:a, ex:m ; crm:P4_has_time-span ex:ts .
ex:act a crm:E7_Activity ; crm:P14_carried_out_by ex:a ; rdfs:label "Indian Agent occupation of Ann" ; crm:P4_has_time_span ex:ts ; crm:P7_took_place_at <https://sws.geonames.org/12l> ; crm:P11_had_participant [ rdfs:label "Office" ; ex:n 5, true ] .
"""


def test_rdf(spark, tmp_path):
    (tmp_path / "x.ttl").write_text(TTL)
    t = rdf.turtle(spark, str(tmp_path / "x.ttl"))
    p = {r.personId: r for r in rdf.persons(t).collect()}
    a = p["lincs:a"]
    assert (a.name, a.alternateNames, a.wikidataQid, a.birthEvent.motherId, a.birthEvent.places[0].id, a.birthEvent.date, a.birthEvent.dateBegin) == ('Ann "A"', ["Anna"], "Q5", "lincs:m", 6098717, "1850", "1850-01-01")
    assert (a.relationships[0].personId, a.relationships[0].date) == ("lincs:m", "1850") and p["viaf:77"].viafId == "77" and p["viaf:77"].name == "Unknown"
    assert {r.personId for r in rdf.plausible(rdf.persons(t)).collect()} == {"lincs:a", "lincs:m"}
    ag = {r.lincsId: r for r in rdf.agents(t).collect()}["lincs:a"]
    assert tuple(ag.occupations[0]) == ("Indian Agent", "Office", "1850", 12)
    (tmp_path / "x.nt").write_text('<http://a> <http://b> "text"@en .\n<http://a> <http://b> <http://c> .\nbad line\n')
    assert rows(rdf.ntriples(spark, str(tmp_path / "x.nt"))) == [("http://a", "http://b", "http://c", "iri"), ("http://a", "http://b", "text", "literal")]
    with pytest.raises(ValueError):
        list(rdf.parse_turtle("ex:a \x01"))
    assert list(rdf.parse_turtle("<a> \x01 <b> <c> .", strict=False)) == [("a", "b", "c", "iri")]
    assert list(rdf.parse_turtle("<a> <b> ( 1 <c> ) , () .")) == [
        ("_:b1", rdf.RDF + "first", "1", "literal"), ("_:b1", rdf.RDF + "rest", "_:b2", "bnode"), ("_:b2", rdf.RDF + "first", "c", "iri"), ("_:b2", rdf.RDF + "rest", rdf.RDF + "nil", "iri"),
        ("a", "b", "_:b1", "bnode"), ("a", "b", rdf.RDF + "nil", "iri"),
    ]


def _fake(endpoint, statement):
    limit, offset = int(statement.split("LIMIT ")[1].split()[0]), int(statement.split("OFFSET ")[1])
    return {"results": {"bindings": [{"item": {"value": f"Q{i}"}} for i in range(offset, min(offset + limit, 7))]}}


def test_paged_source(spark):
    sparql.register(spark, _fake)
    got = spark.read.format("sparql").schema("item string, label string").option("query", "SELECT ORDER BY ?item").option("page", "2").option("pages", "2").load()
    assert sorted(r.item for r in got.collect()) == [f"Q{i}" for i in range(7)]
    with pytest.raises(Exception, match="ORDER BY"):
        spark.read.format("sparql").schema("item string").option("query", "SELECT").load().collect()


def test_fetch_by_ids_and_by_key(spark, tmp_path):
    echo = lambda _, q: {"results": {"bindings": [{"item": {"value": x}} for x in q.split("|")[1].split()]}}
    ids = spark.createDataFrame([(f"Q{i}",) for i in range(250)] + [(None,)], "qid string").coalesce(1)
    got = sparql.by_ids(ids, "VALUES |{values}|", "item string", echo)
    assert sorted(r.item for r in got.collect()) == sorted(f"wd:Q{i}" for i in range(250))
    keys = spark.createDataFrame([("CA",), ("FR",), ("none",)], "k string")
    some = lambda _, q: {"results": {"bindings": [] if "none" in q else [{"item": {"value": q[-2:]}}]}}
    cache = str(tmp_path / "cache")
    assert rows(sparql.by_key(keys, "in {key}", "item string", cache, some)) == [("CA", "CA"), ("FR", "FR")]

    def never(_, q):
        if not q.endswith("DE"):
            raise ValueError(q)
        return {"results": {"bindings": [{"item": {"value": "new"}}]}}

    more = keys.union(spark.createDataFrame([("DE",)], "k string"))
    assert rows(sparql.by_key(more, "in {key}", "item string", cache, never)) == [("CA", "CA"), ("DE", "new"), ("FR", "FR")]


def test_incremental_ingest(spark, tmp_path):
    inbox, gone, table = tmp_path / "in", tmp_path / "del", str(tmp_path / "t")
    inbox.mkdir()
    gone.mkdir()
    (inbox / "1.txt").write_text("\n".join([line(1, "A"), line(2, "B")]))
    increment.changes(spark, str(inbox), table, str(tmp_path / "c1"))
    (inbox / "2.txt").write_text("\n".join([line(2, "B2", date="2021-01-01"), line(3, "C")]))
    increment.changes(spark, str(inbox), table, str(tmp_path / "c1"))
    increment.changes(spark, str(inbox), table, str(tmp_path / "c1"))
    assert rows(increment.current(spark, table).select("geonameId", "name")) == [(1, "A"), (2, "B2"), (3, "C")]
    (gone / "1.txt").write_text("1\tA\tdup\n")
    increment.removals(spark, str(gone), table, str(tmp_path / "c2"))
    assert rows(increment.current(spark, table).select("geonameId")) == [(2,), (3,)]
    (inbox / "3.txt").write_text(line(2, "B3", pop="", date="2022-01-01"))
    increment.changes(spark, str(inbox), table, str(tmp_path / "c1"))
    assert rows(increment.current(spark, table).select("geonameId", "name", "population")) == [(2, "B3", 5), (3, "C", 5)]
