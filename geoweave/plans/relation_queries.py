"""Queries of hierarchy rows, walks with names, flows between places, lists, and index look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave import linking
from geoweave.functions import geo
from geoweave.functions.text import PROVINCES
from geoweave.operators import graph, inverted
from geoweave.plans.base import entities, persons, places, query
from geoweave.plans.graph_queries import _succession, _SUCC
from geoweave.runtime import Scratch, table

# ---- divisions: the tables hold few of them, so codes are derived from the ids on both sides


def _coded(spark, d) -> DataFrame:
    p = places(spark, d, "featureClass featureCode countryCode")
    n = F.col("geonameId")
    for c, k in zip(graph.ADMIN, (7, 11, 13, 17)):
        p = p.withColumn(c, F.pmod(F.floor(n / k), F.lit(2)).cast("string"))
    return p.withColumn("featureCode", F.when(F.col("featureClass") == "A", F.concat(F.lit("ADM"), (1 + F.pmod(n, F.lit(4))).cast("string"))).otherwise(F.col("featureCode")))


_CODED = """c as (select geonameId, featureClass, case when featureClass = 'A' then 'ADM' || (1 + geonameId % 4) else featureCode end featureCode, countryCode cc,
 (geonameId // 7 % 2)::varchar a1, (geonameId // 11 % 2)::varchar a2, (geonameId // 13 % 2)::varchar a3, (geonameId // 17 % 2)::varchar a4 from {p} where countryCode is not null)"""
_SAME = ["a.cc = b.cc", "a.a1 = b.a1", "a.a2 = b.a2", "a.a3 = b.a3", "a.a4 = b.a4"]
_LOCATED = " union all ".join(f"select distinct {n} as level, a.geonameId src, b.geonameId dst from c a join c b on {' and '.join(_SAME[: n + 1])} where a.featureClass <> 'A' and b.featureCode = 'ADM{n}'" for n in (1, 2, 3, 4))


@query(f"with {_CODED} {_LOCATED}")
def hier_located_in(spark, d):
    """Every place in its divisions of level 1 to 4."""
    return graph.located(_coded(spark, d))


@query(f"with {_CODED} select distinct a.geonameId src, b.geonameId dst from c a join c b on a.cc = b.cc and a.a2 = b.a2 where a.featureClass <> 'A' and b.featureCode = 'ADM2'")
def hier_adm2_by_country(spark, d):
    return graph.located_by_country_and_code(_coded(spark, d))


@query(f"""with {_CODED} select geonameId src, 1 as level, null::bigint dst, cc dst_country from c where featureCode = 'ADM1'
 union all select distinct a.geonameId, 2, b.geonameId, null from c a join c b on {' and '.join(_SAME[:2])} where a.featureCode = 'ADM2' and b.featureCode = 'ADM1'
 union all select distinct a.geonameId, 3, b.geonameId, null from c a join c b on {' and '.join(_SAME[:3])} where a.featureCode = 'ADM3' and b.featureCode = 'ADM2'
 union all select distinct a.geonameId, 4, b.geonameId, null from c a join c b on {' and '.join(_SAME[:4])} where a.featureCode = 'ADM4' and b.featureCode = 'ADM3'""")
def hier_division_parents(spark, d):
    return graph.part_of(_coded(spark, d))


@query("select geonameId, c.code, c.\"name\" country from {p} join country c on c.code = countryCode")
def hier_place_country(spark, d):
    c = table(spark, d, "country").select(F.col("code"), F.col("name").alias("country"))
    return places(spark, d, "countryCode").withColumnRenamed("countryCode", "code").join(c, "code").select("geonameId", "code", "country")


@query("with " + _SUCC + """, r as (select s.src "start", s.dst node, 1 hops, s.src || ' > ' || s.dst path, s.src a, s.dst b from s
 union all select s.src, t.dst, 2, s.src || ' > ' || s.dst || ' > ' || t.dst, t.src, t.dst from s join s t on t.src = s.dst where (s.src, s.dst) <> (t.src, t.dst)
 union all select s.src, u.dst, 3, s.src || ' > ' || s.dst || ' > ' || t.dst || ' > ' || u.dst, u.src, u.dst from s join s t on t.src = s.dst join s u on u.src = t.dst where (s.src, s.dst) <> (t.src, t.dst) and (u.src, u.dst) not in ((s.src, s.dst), (t.src, t.dst)))
 select "start", node, hops, path, w."name" node_name from r left join w on w.qid = node --{w}""")
def hier_path_names(spark, d):
    """Walks of one to three hops with the ids on their way and the name they end at."""
    s = _succession(spark, d)
    w = graph.walk(s, s.select(F.col("src").alias("node")).distinct(), 3)
    names = entities(spark, d, "name").select(F.col("qid").alias("node"), F.col("name").alias("node_name"))
    return w.join(names, "node", "left").select("start", "node", "hops", F.array_join("path", " > ").alias("path"), "node_name")


@query("""with e as (select child, parent, row_number() over (order by child, kind, parent) id from {parent}), u as (select child a, parent b, id from e union all select parent, child, id from e)
 select x.a "start", y.b node, count(*)::bigint walks from u x join u y on y.a = x.b where x.id <> y.id group by all""")
def walk_undirected(spark, d):
    """Two steps over family links in either direction; the link just used is not taken back."""
    h = persons(spark, d, "motherId fatherId")
    e = h.select(F.inline(F.array(*[F.struct(F.col("personId").alias("child"), F.col(f"{k}Id").alias("parent"), F.concat_ws("/", F.lit(k), "personId").alias("edge")) for k in ("mother", "father")]))).where("parent is not null")
    both = e.select(F.col("child").alias("src"), F.col("parent").alias("dst"), "edge").unionByName(e.select(F.col("parent").alias("src"), F.col("child").alias("dst"), "edge"))
    w = graph.walk(both, both.select(F.col("src").alias("node")).distinct(), 2, 2)
    return w.groupBy("start", "node").agg(F.count(F.lit(1)).alias("walks"))


# ---- flows, lists, maps


def _edge(h: DataFrame, c: str, to: str) -> DataFrame:
    return h.select("personId", F.explode(c).alias(to))


_PEOPLE = "string_agg(distinct {x}, ';' order by {x})"


@query(f"""select b.place born_in, x.place died_in, count(distinct b.personId)::bigint people, {_PEOPLE.format(x='b.personId')} persons from {{born}} b join {{died}} x using (personId) where b.place <> x.place group by all""")
def migration_city_flows(spark, d):
    """Flows between single places with the people they are made of."""
    h = persons(spark, d, "bornIn diedIn")
    j = _edge(h, "bornIn", "born_in").join(_edge(h, "diedIn", "died_in"), "personId").where("born_in <> died_in")
    return j.groupBy("born_in", "died_in").agg(F.countDistinct("personId").alias("people"), F.array_join(F.sort_array(F.collect_set("personId")), ";").alias("persons"))


@query("""select birth, death, n, coalesce(b."name", birth) birth_name, coalesce(x."name", death) death_name, case when n >= 10 then 4 when n >= 5 then 3 when n >= 2 then 2 else 1 end width
 from {flow} left join country b on b.code = birth left join country x on x.code = death""")
def flow_names_and_widths(spark, d):
    """Country flows for a drawing: names where the list has them, widths by bins."""
    from geoweave.plans.graph_queries import _flows

    c = table(spark, d, "country").where("code is not null")
    name = lambda to: c.select(F.col("code").alias(to), F.col("name").alias(f"{to}_name"))
    f = _flows(spark, d).join(name("birth"), "birth", "left").join(name("death"), "death", "left")
    n = F.col("n")
    width = F.when(n >= 10, 4).when(n >= 5, 3).when(n >= 2, 2).otherwise(1)
    return f.select("birth", "death", "n", F.coalesce("birth_name", "birth").alias("birth_name"), F.coalesce("death_name", "death").alias("death_name"), width.alias("width"))


@query(f"""select coalesce(b.place, x.place) place, coalesce(b.l, '') born_here, coalesce(x.l, '') died_here from (select place, {_PEOPLE.format(x='personId')} l, count(distinct personId) n from {{born}} group by 1) b
 full join (select place, {_PEOPLE.format(x='personId')} l, count(distinct personId) n from {{died}} group by 1) x on b.place = x.place where coalesce(b.n, 0) + coalesce(x.n, 0) > 1""")
def hub_lists(spark, d):
    """Places of two or more births and deaths with both lists of people."""
    h = persons(spark, d, "bornIn diedIn")
    lists = lambda c, to: _edge(h, c, "place").groupBy("place").agg(F.sort_array(F.collect_set("personId")).alias(to))
    j = lists("bornIn", "born_here").join(lists("diedIn", "died_here"), "place", "full")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return j.where(size("born_here") + size("died_here") > 1).select("place", *[F.coalesce(F.array_join(c, ";"), F.lit("")).alias(c) for c in ("born_here", "died_here")])


@query("""select country, n, largest from (select country, n, largest, row_number() over (order by n desc, country) r from (select countryCode country, count(*)::int n, string_agg(geonameId::varchar || '=' || population::varchar, ';' order by geonameId) largest
 from {p} where population > 100000 and countryCode is not null group by 1)) where r <= 20""")
def collect_maps_by_size(spark, d):
    """Per country the list of its large places as maps; the twenty longest lists."""
    p = places(spark, d, "countryCode population").where("population > 100000 and countryCode is not null")
    g = p.groupBy(F.col("countryCode").alias("country")).agg(F.sort_array(F.collect_list(F.struct("geonameId", "population"))).alias("large"))
    top = g.where(F.size("large") > 0).orderBy(F.size("large").desc(), "country").limit(20)
    pair = lambda x: F.concat_ws("=", x["geonameId"].cast("string"), x["population"].cast("string"))
    return top.select("country", F.size("large").alias("n"), F.array_join(F.transform("large", pair), ";").alias("largest"))


@query("""select coalesce(wikidataQid, personId) agent, count(distinct personId)::bigint ids, string_agg(distinct personId, ';' order by personId) id_list from {h} group by 1 having count(distinct personId) > 1""")
def agent_ids(spark, d):
    h = persons(spark, d, "wikidataQid").select(F.coalesce("wikidataQid", "personId").alias("agent"), "personId")
    return h.groupBy("agent").agg(F.sort_array(F.collect_set("personId")).alias("l")).where(F.size("l") > 1).select("agent", F.size("l").cast("bigint").alias("ids"), F.array_join("l", ";").alias("id_list"))


@query("""select p.geonameId, w.qid, w.label kind from {p} p join {w} w on w.qid = p.wikidataId""")
def property_join(spark, d):
    """Places and entities that carry the same QID, without an edge between them."""
    w = entities(spark, d, "label").select(F.col("qid"), F.col("label").alias("kind"))
    return places(spark, d, "wikidataId").withColumnRenamed("wikidataId", "qid").join(w, "qid").select("geonameId", "qid", "kind")


_NAMES = "[" + ", ".join(f"'{k}'" for k in PROVINCES) + "]"
_CODE_ROWS = ", ".join(f"('{k}', '{c}')" for k, v in PROVINCES.items() for c in [*v, k])


@query(f"""with o as (select qid, {_NAMES}[(substr(qid, 2)::bigint % {len(PROVINCES)} + 1)::int] province, trim(regexp_replace(lower(trim("name")), '\\s+(post office|p\\.?o\\.?|m\\.?p\\.?o\\.?).*$', '')) key from {{w}}),
 j as (select distinct qid office, geonameId place from o join (values {_CODE_ROWS}) t(province, code) using (province) join {{p}} on lower("name") = key and admin1Code = code)
 select office, place from (select *, count(*) over (partition by office) n from j) where n = 1""")
def office_by_province(spark, d):
    """Conservative match by name and province, whose many codes come from the province table."""
    number = F.pmod(F.substr("qid", F.lit(2)).cast("bigint"), F.lit(len(PROVINCES))).cast("int")
    offices = entities(spark, d, "name").select(F.col("qid").alias("id"), "name", F.get(F.array(*[F.lit(k) for k in PROVINCES]), number).alias("province"))
    return linking.by_name_and_province(offices, places(spark, d, "name admin1Code").select(F.col("geonameId").alias("id"), "name", F.col("admin1Code").alias("admin1")))


@query("""select qid, loadedAt::varchar loaded_at, case when ok then latitude else longitude end lat, case when ok then longitude else latitude end lon, case when ok then 'kept' else 'swapped' end outcome
 from (select *, latitude between -90 and 90 and longitude between -180 and 180 ok from wikidataplace where latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude)) where ok or (longitude between -90 and 90 and latitude between -180 and 180)""")
def coord_repair(spark, d):
    """Positions of all deliveries, exchanged numbers put right; unusable ones are left out."""
    w = table(spark, d, "wikidataplace").select("qid", F.col("loadedAt").cast("string").alias("loaded_at"), geo.repaired(F.col("latitude"), F.col("longitude")).alias("at"))
    return w.where("at is not null").select("qid", "loaded_at", "at.lat", "at.lon", "at.outcome")


# ---- look-ups on an inverted index of words


@query("""with w as (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')) term from documents), q as (select unnest(['school', 'chapelle', 'straße', 'lighthouse']) term),
 n as (select count(distinct doc_id) n from documents), f as (select term, count(*) df from w join q using (term) group by 1)
 select doc_id, count(*)::int terms, round(sum(ln(1 + n.n::double / df)), 6) score from w join f using (term), n group by doc_id having count(*) >= 2""")
def fulltext_search(spark, d):
    """Documents with two or more of the words sought, scored by how rare these are."""
    index = inverted.word_index(table(spark, d, "documents"), "doc_id", "text", Scratch(spark, "words"))
    return inverted.search_words(index, ["school", "chapelle", "straße", "lighthouse"], least=2)
