"""Queries of the general problems: heavy keys, near points, hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import geo, ids
from geoweave.operators import dualtree, heavy
from geoweave.operators.hierarchy_tour import Hierarchy
from geoweave.plans import base
from geoweave.runtime import Scratch, in_force, table

#: Smallest share of all rows that makes a country heavy in p2_found.
HEAVY_SHARE = 0.04
NEAR_KM = 2.0


def places_in_force(spark: SparkSession, d: str, columns: list[str]) -> DataFrame:
    return in_force(table(spark, d, "place"), "geonameId", columns)


def positions(spark: SparkSession, d: str) -> DataFrame:
    """(id, lat, lon) of the places in force that have a position."""
    at = geo.position(F.col("location"), F.col("latitude"), F.col("longitude"))
    p = table(spark, d, "place").select("geonameId", "loadedAt", at.alias("at")).select("geonameId", "loadedAt", "at.lat", "at.lon")
    return in_force(p, "geonameId", ["lat", "lon"]).where("lat is not null and lon is not null").select(F.col("geonameId").alias("id"), "lat", "lon")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Countries that at least 4 % of all rows of place carry, as stored."""
    return heavy.heavy_keys(table(spark, d, "place"), "countryCode", HEAVY_SHARE).select(F.col("countryCode").alias("country_code"))


def p2_country_profile(spark: SparkSession, d: str) -> DataFrame:
    """Per country: places in force, population, and how many lie above the country's mean.

    The mean goes back to every place row, which is where heavy countries would
    pile up: those rows meet it by broadcast, the others by shuffle.  The null
    country is left out; a null population counts as unknown.
    """
    p = places_in_force(spark, d, ["countryCode", "population"]).where(F.col("countryCode").isNotNull())
    p = Scratch(spark, "p2").save(p, "places")
    stat = p.groupBy("countryCode").agg(
        F.count(F.lit(1)).alias("n_places"), F.sum("population").alias("sum_population"), F.avg("population").alias("mean_population"), F.max("population").alias("max_population")
    )
    joined = heavy.join_skewed(p, stat, "countryCode")
    return joined.groupBy(F.col("countryCode").alias("country_code")).agg(
        F.max("n_places").alias("n_places"), F.max("sum_population").alias("sum_population"), F.max("max_population").alias("max_population"),
        F.count_if(F.col("population") > F.col("mean_population")).alias("n_above_mean"),
        F.min(F.when(F.col("population") == F.col("max_population"), F.col("geonameId"))).alias("top_place"),
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Places within 2 km of each other, and zones with the places inside."""
    scratch = Scratch(spark, "p3")
    pts = dualtree.PointTree(positions(spark, d), scratch)
    near = dualtree.near_pairs(pts, NEAR_KM, scratch)
    zones = table(spark, d, "surveyzone").select(F.col("zoneId").alias("region_id"), geo.polygon_edges(F.col("boundary")).alias("edges"))
    inside = dualtree.points_in_regions(pts, zones, scratch)
    return near.select(F.lit("near").alias("kind"), "left_id", "right_id").unionByName(
        inside.select(F.lit("zone").alias("kind"), F.col("region_id").alias("left_id"), F.col("point_id").alias("right_id"))
    )


def hierarchy_edges(spark: SparkSession, d: str) -> DataFrame:
    """(line, node, parent) of the mother, father and succession lines, rows in force."""
    person = in_force(table(spark, d, "historicalperson"), "personId", ["birthEvent"])
    node = ids.person_id(F.col("personId"))
    lines = person.select(F.inline(F.array(*[
        F.struct(F.lit(line).alias("line"), node.alias("node"), ids.person_id(F.col(f"birthEvent.{field}")).alias("parent"))
        for line, field in (("mother", "motherId"), ("father", "fatherId"))
    ])))
    place = in_force(table(spark, d, "wikidataplace"), "qid", ["replacesQid", "replacedByQid"])
    me, old, new = ids.qid(F.col("qid")), ids.qid(F.col("replacesQid")), ids.qid(F.col("replacedByQid"))
    links = place.select(F.inline(F.array(
        F.struct(F.lit("succession").alias("line"), me.alias("node"), new.alias("parent")),
        F.struct(F.lit("succession").alias("line"), old.alias("node"), me.alias("parent")),
    )))
    return lines.unionByName(links).where("node is not null and parent is not null")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Root and depth of every node with a parent, per line."""
    return Hierarchy(hierarchy_edges(spark, d), Scratch(spark, "p4")).depths()


def p4_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """Full hierarchies: path, depth, root, number of descendants, cycle membership."""
    full = Hierarchy(hierarchy_edges(spark, d), Scratch(spark, "p4h")).full()
    return full.withColumn("path", F.array_join("path", " > "))


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    """The descendants of every node, a row for each; a node on a circle is below itself."""
    return Hierarchy(hierarchy_edges(spark, d), Scratch(spark, "p4d"), tails=True).descendants()


QUERIES = {
    "p2_found": p2_found,
    "p2_country_profile": p2_country_profile,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_hierarchy": p4_hierarchy,
    "p4_descendants": p4_descendants,
}

_POLYGON = """e as (select zoneId, v[i] a, v[i % len(v) + 1] b from (select zoneId, v, unnest(range(1, len(v) + 1)) i from (select zoneId, list_transform(string_split(regexp_extract(boundary, '\\(\\(([^()]*)\\)\\)', 1), ','),
 lambda x: list_transform(string_split(trim(x), ' '), lambda y: y::double)) v from surveyzone)))"""
_UP = """k as (select line, node, min(parent) parent from (select kind line, child node, parent from {parent} union all select 'succession', qid, replacedByQid from {w} union all select 'succession', replacesQid, qid from w)
 where node is not null and parent is not null group by 1, 2),
 r as (select line, node, parent top, 1 depth from k union all select r.line, r.node, k.parent, depth + 1 from r join k on k.line = r.line and k.node = r.top where depth < 400)"""

ORACLES: dict[str, str] = {
    "p2_found": "select countryCode country_code from place where countryCode is not null group by 1 having count(*) >= 0.04 * (select count(*) from place)",
    "p2_country_profile": base.with_views("""with f as (select * from (select geonameId, countryCode cc, population, row_number() over (partition by geonameId order by loadedAt desc) r from place where geonameId is not null) where r = 1 and cc is not null),
 g as (select cc, count(*) n, sum(population) s, avg(population) m, max(population) x from f group by 1)
 select cc country_code, max(n)::bigint n_places, max(s)::bigint sum_population, max(x) max_population, count(*) filter (population > m)::bigint n_above_mean, min(case when population = x then geonameId end) top_place from f join g using (cc) group by 1"""),
    "p3_found": base.with_views(f"""with {_POLYGON} select 'near' kind, a.geonameId left_id, b.geonameId right_id from {{p}} a join p b on a.geonameId < b.geonameId and abs(a.lat - b.lat) < 0.02
 where 2 * 6371 * asin(sqrt(least(1, sin(radians(b.lat - a.lat) / 2) ** 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) ** 2))) <= 2
 union all select 'zone', zoneId, geonameId from (select zoneId, geonameId, count(*) filter ((e.a[2] > p.lat) <> (e.b[2] > p.lat) and p.lon < (e.b[1] - e.a[1]) * (p.lat - e.a[2]) / nullif(e.b[2] - e.a[2], 0) + e.a[1]) hits
 from e, p where p.lat is not null group by 1, 2) where hits % 2 = 1"""),
    "p4_found": base.with_views("with recursive " + _UP + """ select line, node node_id, case when max(depth) = 400 then '' else max_by(top, depth) end root_id, case when max(depth) = 400 then -1 else max(depth) end::int depth from r group by 1, 2"""),
    "p4_hierarchy": base.with_views("with recursive " + _UP.replace("parent top, 1 depth from k", "parent top, 1 depth, parent || ' > ' || node path from k").replace("k.parent, depth + 1 from", "k.parent, depth + 1, k.parent || ' > ' || r.path from") + """,
 fin as (select line, node, max(depth) dm, max_by(top, depth) root, max_by(path, depth) path from r group by 1, 2), own as (select distinct line, node from r where top = node),
 below as (select r.line, r.top node, count(*)::bigint n from r join fin using (line, node) where dm < 400 group by 1, 2)
 select fin.line, fin.node node_id, case when dm = 400 then '' else root end root_id, case when dm = 400 then -1 else dm end::int depth, case when dm < 400 then path end path,
 case when dm < 400 then coalesce(n, 0) end descendants, own.node is not null in_cycle from fin left join below using (line, node) left join own using (line, node)
 union all select line, node, node, 0, node, n, false from below where (line, node) not in (select (line, node) from k)"""),
    "p4_descendants": base.with_views("with recursive " + _UP + " select distinct line, top ancestor_id, node descendant_id from r"),
}
