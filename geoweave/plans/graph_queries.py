"""Queries of the knowledge graph's own operators, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweave import linking, reconcile
from geoweave.functions import geo, ids, scores
from geoweave.operators import cells, graph, tables
from geoweave.operators.edits import within_edits
from geoweave.plans.base import QUERIES, entities, km_sql, persons, places, query  # noqa: F401
from geoweave.runtime import _FROM, Scratch, table
from geoweave.sources import gazetteer

_CUT = "2024-01-01"
#: Query vectors compared with all rows at a time.
QUERY_BLOCK = 2_000


def _joined(c, sep: str = ";"):
    """A collected list as one string in a fixed order."""
    return F.array_join(F.sort_array(c), sep)


# ---- gazetteer: cleansing, filters, frequencies


@query("""select geonameId, array_to_string(list_sort(list_filter(list_transform(coalesce(alternateNames, []), lambda x: trim(x)), lambda x: x <> '')), ';') alt_names,
 coalesce(population, 0) population, coalesce(elevation, 0) elevation, concat_ws('.', featureClass, featureCode) full_code from {p} where lat is not null""")
def gaz_cleanse(spark, d):
    alt = F.filter(F.transform(F.coalesce("alternateNames", F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    return places(spark, d, "alternateNames population elevation featureClass featureCode lat").where("lat is not null").select(
        "geonameId", _joined(alt).alias("alt_names"), F.coalesce("population", F.lit(0)).alias("population"), F.coalesce("elevation", F.lit(0)).alias("elevation"), F.concat_ws(".", "featureClass", "featureCode").alias("full_code")
    )


@query("select countryCode country_code, count(*)::bigint n from {p} where countryCode in ('XK', 'QM', 'ZB', 'XT') and countryCode not in ('XK') group by 1")
def gaz_country_filter(spark, d):
    p = gazetteer.by_country(places(spark, d, "countryCode"), ["XK", "QM", "ZB", "XT"], ["XK"])
    return p.groupBy(F.col("countryCode").alias("country_code")).agg(F.count(F.lit(1)).alias("n"))


@query("select geonameId, featureClass feature_class, featureCode feature_code from {p} where featureClass in ('H', 'A') or featureClass || '.' || featureCode in ('P.PPL', 'P.PPLA')")
def gaz_feature_filter(spark, d):
    p = places(spark, d, "featureClass featureCode").withColumn("fullFeatureCode", F.concat("featureClass", F.lit("."), "featureCode"))
    return gazetteer.by_feature(p, ["H", "A", "P.PPL", "P.PPLA"]).select("geonameId", F.col("featureClass").alias("feature_class"), F.col("featureCode").alias("feature_code"))


@query("""select full_code, n, round(100.0::double * n / sum(n) over (), 3) pct from (select concat_ws('.', featureClass, featureCode) full_code, count(*)::bigint n from {p} group by 1) order by n desc, full_code limit 50""")
def gaz_feature_top50(spark, d):
    g = places(spark, d, "featureClass featureCode").groupBy(F.concat_ws(".", "featureClass", "featureCode").alias("full_code")).agg(F.count(F.lit(1)).alias("n"))
    whole = g.agg(F.sum("n").alias("all"))
    return g.join(F.broadcast(whole)).select("full_code", "n", F.round(F.lit(100.0).cast("double") * F.col("n") / F.col("all"), 3).alias("pct")).orderBy(F.col("n").desc(), "full_code").limit(50)


@query("""select case when isnan(latitude) or isnan(longitude) or latitude is null or longitude is null then 'missing' when abs(latitude) <= 90 and abs(longitude) <= 180 then 'kept'
 when abs(longitude) <= 90 and abs(latitude) <= 180 then 'swapped' else 'dropped' end outcome, count(*)::bigint n from place group by 1""")
def coord_validate_swap(spark, d):
    la, lo = F.col("latitude"), F.col("longitude")
    gone = la.isNull() | lo.isNull() | F.isnan(la) | F.isnan(lo)
    out = F.when(gone, "missing").when(geo.valid_position(la, lo), "kept").when(geo.valid_position(lo, la), "swapped").otherwise("dropped")
    return table(spark, d, "place").groupBy(out.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


# ---- upserts and merges


def _deliveries(spark, d):
    """Early and late deliveries of place, the newest of each key."""
    t = table(spark, d, "place").select("geonameId", "name", "population", "loadedAt").where("geonameId is not null")
    early, late = t.where(F.col("loadedAt") < F.lit(_CUT).cast("timestamp_ntz")), t.where(F.col("loadedAt") >= F.lit(_CUT).cast("timestamp_ntz"))
    old = tables.last_per_key(early, ["geonameId"], [F.col("loadedAt")]).drop("loadedAt")
    return old, late


_OLD_NEW = f"""with o as (select geonameId, name, population from (select *, row_number() over (partition by geonameId order by loadedAt desc) r from place where loadedAt < '{_CUT}' and geonameId is not null) where r = 1),
 n as (select geonameId, name, population from (select *, row_number() over (partition by geonameId order by loadedAt desc) r from place where loadedAt >= '{_CUT}' and geonameId is not null) where r = 1) """


@query(_OLD_NEW + "select coalesce(o.geonameId, n.geonameId) geonameId, coalesce(n.name, o.name) \"name\", coalesce(n.population, o.population) population from o full join n on o.geonameId = n.geonameId")
def upsert_node(spark, d):
    old, late = _deliveries(spark, d)
    return tables.upsert(old, late, "geonameId", [F.col("loadedAt")]).select("geonameId", "name", "population")


@query(_OLD_NEW + "select coalesce(o.geonameId, n.geonameId) geonameId, coalesce(n.name, o.name) \"name\", case when o.geonameId is null then n.population else o.population end population from o full join n on o.geonameId = n.geonameId")
def upsert_on_create(spark, d):
    old, late = _deliveries(spark, d)
    return tables.upsert(old, late, "geonameId", [F.col("loadedAt")], on_create=("population",)).select("geonameId", "name", "population")


@query(_OLD_NEW + "select o.geonameId, coalesce(n.name, o.name) \"name\", coalesce(n.population, o.population) population from o left join n on o.geonameId = n.geonameId")
def upsert_match_only(spark, d):
    old, late = _deliveries(spark, d)
    return tables.upsert(old, late, "geonameId", [F.col("loadedAt")], only_if_exists=True).select("geonameId", "name", "population")


def _pairs(spark, d):
    l, r = ids.person_id(F.col("leftPersonId")), ids.person_id(F.col("rightPersonId"))
    return table(spark, d, "personmatch").select(F.least(l, r).alias("src"), F.greatest(l, r).alias("dst"), "verdict", "confidence", "judgedAt", "matchId").where("src <> dst")


@query("select a src, b dst, confidence, matchId match_id from (select *, row_number() over (partition by a, b order by judgedAt desc, matchId desc) r from {pair}) where r = 1")
def upsert_edge(spark, d):
    e = _pairs(spark, d).select("src", "dst", "confidence", "judgedAt", "matchId")
    cut = F.lit("2023-10-01").cast("timestamp_ntz")
    old = tables.last_per_key(e.where(F.col("judgedAt") < cut), ["src", "dst"], [F.col("judgedAt"), F.col("matchId")])
    new = e.where(F.col("judgedAt") >= cut)
    return tables.upsert_edges(old, new, [F.col("judgedAt"), F.col("matchId")]).select("src", "dst", "confidence", F.col("matchId").alias("match_id"))


@query("select geonameId, \"name\" from {p} union all select geonameId, \"name\" from placeref where geonameId not in (select geonameId from p)")
def merge_if_absent(spark, d):
    return tables.add_if_absent(places(spark, d, "name").select("geonameId", "name"), table(spark, d, "placeref").select("geonameId", "name"), "geonameId")


@query("select qid, min(loadedAt)::varchar first_loaded from wikidataplace group by 1")
def consolidate_first_wins(spark, d):
    w = table(spark, d, "wikidataplace").select("qid", "loadedAt")
    return tables.first_wins(w, ["qid"], [F.col("loadedAt").asc_nulls_last()]).select("qid", F.col("loadedAt").cast("string").alias("first_loaded"))


# ---- JSON claims, arrays, predicates


@query("select event_type, count(*)::bigint n, count(k)::bigint with_k, sum(k)::bigint sum_k, max(k) max_k from (select event_type, try_cast(json_extract_string(props, '$.k') as bigint) k from events) group by 1")
def claims_extract(spark, d):
    e = table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("with_k"), F.sum("k").alias("sum_k"), F.max("k").alias("max_k"))


@query("""select countryCode country_code, count(*)::bigint n, count(*) filter (list_contains(alternateNames, asciiName))::bigint own_ascii,
 count(*) filter (len(list_filter(coalesce(alternateNames, []), lambda x: contains(x, 'grad'))) > 0)::bigint any_grad from {p} where countryCode is not null group by 1""")
def array_predicates(spark, d):
    alt = F.coalesce("alternateNames", F.array().cast("array<string>"))
    p = places(spark, d, "countryCode alternateNames asciiName").where("countryCode is not null")
    return p.groupBy(F.col("countryCode").alias("country_code")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains(alt, F.col("asciiName"))).alias("own_ascii"), F.count_if(F.exists(alt, lambda x: x.contains("grad"))).alias("any_grad")
    )


@query("""select qid, array_to_string(list_sort(list_filter(list_distinct(list_concat(coalesce(alternateNames, []), coalesce(officialNames, []))), lambda x: x is not null and x <> coalesce("name", ''))), ';') others from {w}""")
def label_alias_union(spark, d):
    none = F.array().cast("array<string>")
    every = F.array_except(F.array_compact(F.array_union(F.coalesce("alternateNames", none), F.coalesce("officialNames", none))), F.array(F.coalesce("name", F.lit(""))))
    return entities(spark, d, "name alternateNames officialNames").select("qid", _joined(every).alias("others"))


@query("""select count(*) filter (starts_with("name", 'Old '))::bigint starts, count(*) filter (contains("name", 'grad'))::bigint holds, count(*) filter (regexp_full_match("name", '(?i).*school.*'))::bigint whole_regex,
 count(*) filter (modifiedDate between '2010-01-01' and '2015-12-31')::bigint lexical_range, count(*) filter (population > 0 and elevation is not null)::bigint both_known,
 count(*) filter (featureClass <> 'A')::bigint not_a, count(*) filter (admin2Code is null or admin2Code = '017')::bigint null_or_equal, count(*) filter (lat between 0 and 10 and lon between 0 and 90)::bigint in_box from {p}""")
def predicates_pack(spark, d):
    c = F.col
    tests = {
        "starts": c("name").startswith("Old "), "holds": c("name").contains("grad"), "whole_regex": c("name").rlike("(?i)^.*school.*$"), "lexical_range": c("modifiedDate").between("2010-01-01", "2015-12-31"),
        "both_known": (c("population") > 0) & c("elevation").isNotNull(), "not_a": c("featureClass") != "A", "null_or_equal": c("admin2Code").isNull() | (c("admin2Code") == "017"), "in_box": c("lat").between(0, 10) & c("lon").between(0, 90),
    }
    return places(spark, d, "name modifiedDate population elevation featureClass admin2Code lat lon").agg(*[F.count_if(t).alias(n) for n, t in tests.items()])


# ---- hierarchy


@query("select src, dst from {idlink}")
def link_by_id(spark, d):
    return linking.by_id(entities(spark, d, "geonamesId").select(F.col("qid").alias("id"), F.col("geonamesId").alias("ref")), places(spark, d, "").select(F.col("geonameId").alias("id")))


_CODES = """(select distinct c.code, c.parent, c.level, c.cc "countryCode" from (select unnest([
 {code: countryCode || '.' || admin1Code, parent: countryCode, level: 1, cc: countryCode},
 {code: countryCode || '.' || admin1Code || '.' || admin2Code, parent: countryCode || '.' || admin1Code, level: 2, cc: countryCode},
 {code: countryCode || '.' || admin1Code || '.' || admin2Code || '.' || admin3Code, parent: countryCode || '.' || admin1Code || '.' || admin2Code, level: 3, cc: countryCode},
 {code: countryCode || '.' || admin1Code || '.' || admin2Code || '.' || admin3Code || '.' || admin4Code, parent: countryCode || '.' || admin1Code || '.' || admin2Code || '.' || admin3Code, level: 4, cc: countryCode}]) c from p) where c.code is not null)"""


@query("select code, parent, level, \"countryCode\" country_code from " + _CODES + " --{p}")
def hier_part_of(spark, d):
    return graph.code_divisions(places(spark, d, "countryCode admin1Code admin2Code admin3Code admin4Code")).select("code", "parent", "level", F.col("countryCode").alias("country_code"))


@query("select countryCode country_code, admin1Code admin1_code, count(*)::bigint n, count(distinct admin2Code)::bigint n_admin2 from {p} where countryCode is not null and admin1Code is not null group by 1, 2")
def hier_place_adm1(spark, d):
    p = places(spark, d, "countryCode admin1Code admin2Code admin3Code admin4Code")
    div = graph.code_divisions(p).where("level = 1")
    j = p.where("countryCode is not null and admin1Code is not null").withColumn("code", F.concat_ws(".", "countryCode", "admin1Code")).join(div.select("code"), "code")
    return j.groupBy(F.col("countryCode").alias("country_code"), F.col("admin1Code").alias("admin1_code")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("admin2Code").alias("n_admin2"))


@query("""select distinct a.geonameId src, b.geonameId dst from {p} a join p b on a.countryCode = b.countryCode and a.admin1Code = b.admin1Code and a.admin2Code = b.admin2Code and a.admin3Code = b.admin3Code
 where b.featureCode = 'ADM3' and a.featureClass <> 'A'""")
def hier_composite_keys(spark, d):
    return graph.located_in(places(spark, d, "featureClass featureCode countryCode admin1Code admin2Code admin3Code admin4Code"), 3)


@query("""select geonameId, countryCode country, (case when admin1Code is null then 0 when admin2Code is null then 1 when admin3Code is null then 2 when admin4Code is null then 3 else 4 end) + 1 hops from {p} where countryCode is not null""")
def hier_paths(spark, d):
    p = places(spark, d, "countryCode admin1Code admin2Code admin3Code admin4Code").where("countryCode is not null")
    full, deepest = F.col("countryCode").isNotNull(), F.col("countryCode")
    code = F.col("countryCode")
    for c in graph.ADMIN:
        full, code = full & F.col(c).isNotNull(), F.concat_ws(".", code, F.col(c))
        deepest = F.when(full, code).otherwise(deepest)
    up = p.select(F.col("geonameId").cast("string").alias("src"), deepest.alias("dst"))
    edges = up.unionByName(graph.code_divisions(p).select(F.col("code").alias("src"), F.col("parent").alias("dst")))
    w = graph.walk(edges, p.select(F.col("geonameId").cast("string").alias("node")), 5)
    return w.where(~F.col("node").contains(".")).select(F.col("start").cast("bigint").alias("geonameId"), F.col("node").alias("country"), "hops")


def _succession(spark, d):
    w = entities(spark, d, "replacesQid replacedByQid")
    return w.select(F.col("replacedByQid").alias("dst"), F.col("qid").alias("src")).unionByName(w.select(F.col("qid").alias("dst"), F.col("replacesQid").alias("src"))).where("src is not null and dst is not null").distinct()


_SUCC = "s as (select distinct src, dst from (select qid src, replacedByQid dst from w union all select replacesQid, qid from w) where src is not null and dst is not null)"


@query("select src old_qid, dst new_qid from (with " + _SUCC + " select * from s) --{w}")
def succession_pairs(spark, d):
    return _succession(spark, d).select(F.col("src").alias("old_qid"), F.col("dst").alias("new_qid"))


@query("with recursive " + _SUCC + ", r as (select src, dst from s union select r.src, s.dst from r join s on r.dst = s.src) select src, dst from r --{w}")
def hier_closure(spark, d):
    return graph.closure(_succession(spark, d), Scratch(spark, "closure"))


@query("with " + _SUCC + """ select qid "start", qid node, 0 hops from w union all select w.qid, s.dst, 1 from w join s on s.src = w.qid
 union all select w.qid, t.dst, 2 from w join s on s.src = w.qid join s t on t.src = s.dst where (s.src, s.dst) <> (t.src, t.dst) --{w}""")
def hier_zero_to_two(spark, d):
    return graph.walk(_succession(spark, d), entities(spark, d, "").select(F.col("qid").alias("node")), 2, 0).select("start", "node", "hops")


# ---- spatial joins and links


def _src(spark, d):
    return entities(spark, d, "name label lat lon").select(F.col("qid").alias("id"), "name", "label", "lat", "lon")


def _dst(spark, d):
    return places(spark, d, "name featureCode featureClass population lat lon").select(F.col("geonameId").alias("id"), "name", F.col("featureCode").alias("code"), F.col("featureClass").alias("class"), "population", "lat", "lon")


def _near(km: float) -> str:
    return f"near as (select * from (select w.qid src, p.geonameId dst, {km_sql('w', 'p')} km from {{w}} join {{p}} on abs(w.lat - p.lat) <= {km / 111.0}) where km <= {km})"


@query("with " + _near(10) + " select src src_id, dst dst_id, km from near")
def radius_join(spark, d):
    return cells.radius_join(_src(spark, d), _dst(spark, d), 10.0)


@query("with " + _near(5) + " select src src_id, dst dst_id, km from near")
def bbox_join(spark, d):
    return cells.box_join(_src(spark, d), _dst(spark, d), 5.0)


@query("with " + _near(10) + " select src src_id, dst dst_id, km, r as rank from (select *, row_number() over (partition by src order by km, dst)::int r from near) where r <= 10")
def knn_10(spark, d):
    return cells.knn(_src(spark, d), _dst(spark, d), 10.0, 10)


@query("with " + _near(10) + " select src src_id, dst dst_id, km from (select *, row_number() over (partition by src order by km, dst) r from near) where r = 1")
def nn_1(spark, d):
    return cells.knn(_src(spark, d), _dst(spark, d), 10.0, 1).drop("rank")


@query(f"with a as (select lat, lon from {{p}} where lat is not null order by population desc nulls last, geonameId limit 1) select geonameId, {km_sql('a', 'p')} km from p, a where {km_sql('a', 'p')} <= 50")
def anchor_radius(spark, d):
    p = places(spark, d, "population lat lon")
    anchor = p.where("lat is not null").orderBy(F.col("population").desc_nulls_last(), "geonameId").limit(1).select(F.lit(0).alias("id"), "lat", "lon")
    return cells.radius_join(anchor, p.select(F.col("geonameId").alias("id"), "lat", "lon"), 50.0).select(F.col("dst_id").alias("geonameId"), "km")


_NAME = """(case when coalesce(a, '') = '' or coalesce(b, '') = '' then 0.0::double when lower(a) = lower(b) then 1.0 when contains(lower(a), lower(b)) or contains(lower(b), lower(a)) then 0.8
 else coalesce(0.5::double * len(list_intersect(list_distinct(list_filter(regexp_split_to_array(trim(lower(a)), '\\s+'), lambda x: x <> '')), list_distinct(list_filter(regexp_split_to_array(trim(lower(b)), '\\s+'), lambda x: x <> ''))))
 / nullif(greatest(len(list_distinct(list_filter(regexp_split_to_array(trim(lower(a)), '\\s+'), lambda x: x <> ''))), len(list_distinct(list_filter(regexp_split_to_array(trim(lower(b)), '\\s+'), lambda x: x <> '')))), 0), 0) end)"""
_DIST = "(case when km <= 0.1 then 1.0::double when km <= 1 then 0.9 when km <= 5 then 0.7 when km <= 10 then 0.5 else 0.3 end)"
_WDPRIO = "(case when regexp_matches(coalesce(label, ''), 'county|township|municipality|division') then 85 when regexp_matches(coalesce(label, ''), 'city|town|village|settlement') then 70 when regexp_matches(coalesce(label, ''), 'neighbourhood|neighborhood|district') then 40 else 50 end)"
_GNPRIO = "(case when starts_with(code, 'ADM') then 85 when starts_with(code, 'PPLA') then 80 when code = 'PPL' then 70 when code = 'AREA' then 75 when code = 'PPLX' then 40 else 50 end)"


def _scored(k: int, mine: str, kind: str, least: float, rel: str) -> str:
    """SQL of one linking profile."""
    return f"""with {_near(10)}, c as (select * from (select near.*, row_number() over (partition by src order by km, dst) r from near) where r <= {k}),
 j as (select c.src, c.dst, c.km, w."name" a, p."name" b, w.label, upper(coalesce(p.featureCode, '')) code from c join w on w.qid = c.src join p on p.geonameId = c.dst),
 q as (select *, {mine} mine, {_GNPRIO} theirs from j),
 s as (select *, round(least(1.0::double, {_DIST} * 0.3::double + {_NAME} * 0.5::double + ({kind}) * 0.2::double), 3) confidence from q)
 select src, dst, km, confidence, {rel} relation from s where confidence >= {least}"""


_KIND = "case when mine >= 70 and theirs >= 70 then least((mine + theirs) / 200.0::double * 1.2::double, 1.0::double) else (mine + theirs) / 200.0::double end"
_CANADA = "case when mine < 60 and theirs >= 60 and km <= 5 then 'LOCATED_IN' else 'NEAR' end"
_GLOBAL = "case when mine < 60 and theirs >= 60 and km <= 5 then 'LOCATED_IN' when confidence >= 0.85 and km <= 1 then 'SAME_AS' else 'NEAR' end"
_NEAREST = "case when confidence >= 0.85 and km <= 1 then 'SAME_AS' when km <= 5 then 'NEAR' else 'LOCATED_IN' end"


@query(_scored(10, _WDPRIO, _KIND, 0.5, _CANADA))
def confidence_canada(spark, d):
    return linking.spatial(_src(spark, d), _dst(spark, d), "canada")


@query(_scored(10, "70", _KIND, 0.5, _GLOBAL))
def confidence_global(spark, d):
    return linking.spatial(_src(spark, d), _dst(spark, d), "global")


@query(_scored(1, "70", "0.7::double", 0.7, _NEAREST))
def confidence_nearest(spark, d):
    return linking.spatial(_src(spark, d), _dst(spark, d), "nearest")


@query(_scored(10, _WDPRIO, _KIND, 0.5, _CANADA).replace("select src, dst, km, confidence,", ", e as (select src, dst, km, confidence,") + ") select relation, count(*)::bigint n from (select * from e union all select src, dst, km, confidence, 'SAME_AS' from e where relation = 'NEAR' and confidence >= 0.85 and km <= 1) group by 1")
def same_as_second_pass(spark, d):
    return linking.same_as_too(linking.spatial(_src(spark, d), _dst(spark, d), "canada")).groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


def _case(col: str, d: dict, op: str) -> str:
    return " ".join(f"when {op.format(c=col, k=k)} then {v}" for k, v in d.items())


# A label for all places but one in 33, so that every word of the table is met.
_LABELS = list(scores.LABELS_HISTORICAL)
_LABEL_SQL = "'Former ' || [" + ", ".join(f"'{k}'" for k in _LABELS) + f"][(p.geonameId % {len(_LABELS) + 1} + 1)::int]"

_HIST = (
    f"""with {_near(25)}, c as (select * from (select near.*, row_number() over (partition by src order by km, dst) r from near) where r <= 50),
 j as (select c.*, w."name" b, p."name" a, p.population, upper(p.featureCode) code, upper(p.featureClass) cls, {_LABEL_SQL} as label from c join w on w.qid = c.src join p on p.geonameId = c.dst),
 s as (select *, (case when km <= 0.5 then 1.0::double when km <= 2 then 0.9 when km <= 5 then 0.75 when km <= 10 then 0.5 when km <= 25 then 0.3 else 0.1 end) ds,
 coalesce(case {_case('label', scores.LABELS_HISTORICAL, "contains(lower({c}), '{k}')")} end, case {_case('code', scores.CODES_HISTORICAL, "{c} = '{k}'")} end, case {_case('cls', scores.CLASSES_HISTORICAL, "{c} = '{k}'")} end, 30) pr,
 (case when coalesce(b, '') = '' then 0.5::double else """
    + _NAME.replace("greatest(len(list_distinct(list_filter(regexp_split_to_array(trim(lower(a)), '\\s+'), lambda x: x <> ''))), ", "(").replace("), 0), 0) end)", "), 0), 0) end)")
    + """ end) ns, (case when population >= 100000 then 1.3::double when population >= 10000 then 1.2 when population >= 1000 then 1.1 else 1.0 end) pw from j),
 t as (select src, dst, km, round(least(1.0::double, ds * 0.4::double + pr / 100.0::double * 0.35::double + ns * 0.15::double + (pw - 1.0::double) * 0.1::double), 3) score from s)
 select src point, dst place, km, score, rk as rank from (select *, row_number() over (partition by src order by score desc, km, dst)::int rk from t where score >= 0.6) where rk <= 5"""
)


@query(_HIST)
def hgis_top5(spark, d):
    pts = _src(spark, d).select("id", "name", "lat", "lon")
    label = F.concat(F.lit("Former "), F.get(F.array(*[F.lit(k) for k in _LABELS]), F.pmod("id", F.lit(len(_LABELS) + 1)).cast("int")))
    return linking.historical(pts, _dst(spark, d).withColumn("label", label)).where("rank <= 5")


_OFFICE = "trim(regexp_replace(lower(trim(w.\"name\")), '\\s+(post office|p\\.?o\\.?|m\\.?p\\.?o\\.?).*$', ''))"


@query(f"""with c as (select "code", {'upper(trim(qid))'} q from country), j as (select distinct w.qid office, p.geonameId place from {{w}} join c on c.q = w.countryQid join {{p}} on p.countryCode = c.code and lower(p."name") = {_OFFICE} where w.label = 'post office')
 select office, place from (select *, count(*) over (partition by office) n from j) where n = 1""")
def name_province_unique(spark, d):
    c = table(spark, d, "country").select(F.upper(F.trim("qid")).alias("countryQid"), F.col("code").alias("province"))
    offices = entities(spark, d, "name label countryQid").where("label = 'post office'").join(c, "countryQid").select(F.col("qid").alias("id"), "name", "province")
    return linking.by_name_and_province(offices, places(spark, d, "name countryCode").select(F.col("geonameId").alias("id"), "name", F.col("countryCode").alias("admin1")))


# ---- reconciliation


def _requests(spark, d):
    number = F.substr("qid", F.lit(2)).cast("bigint")
    c = table(spark, d, "country").select(F.upper(F.trim("qid")).alias("countryQid"), F.col("code").alias("country"))
    return entities(spark, d, "name label countryQid lat lon").join(c, "countryQid", "left").select(
        number.alias("mention_id"), "name", "country", F.lpad((number % 20).cast("string"), 2, "0").alias("admin1"), "lat", "lon", (20 + number % 50).cast("double").alias("radius_km"), (F.col("label") == "ghost town").alias("historical")
    )


def _gazetteer(spark, d):
    return places(spark, d, "name alternateNames wikidataAlternateNames countryCode admin1Code featureCode population wikidataId lat lon").withColumn("dissolvedDate", F.lit(None).cast("string"))


_ROWS = """req as (select substr(w.qid, 2)::bigint mention_id, w."name" wanted, c.code country, lpad((substr(w.qid, 2)::bigint % 20)::varchar, 2, '0') admin1, (20 + substr(w.qid, 2)::bigint % 50)::double radius,
 w.lat, w.lon, w.label = 'ghost town' hist from {w} left join country c on upper(trim(c.qid)) = w.countryQid)"""
_REQ = _ROWS + """,
 nm as (select distinct geonameId, unnest(list_concat(["name"], coalesce(alternateNames, []), coalesce(wikidataAlternateNames, []))) wanted from {p}),
 nm2 as (select distinct geonameId, unnest(list_concat(["name"], coalesce(alternateNames, []))) wanted from p)"""


@query("with " + _REQ + """ select mention_id, geonameId, 1.0::double confidence, r as place_rank from (select req.mention_id, p.geonameId, row_number() over (partition by mention_id order by p.population desc nulls last, p.geonameId)::int r
 from req join nm using (wanted) join p using (geonameId) where req.country is null or p.countryCode = req.country) where r <= 20""")
def recon_exact(spark, d):
    return reconcile.exact(_requests(spark, d), _gazetteer(spark, d)).select("mention_id", "geonameId", "confidence", "place_rank")


@query("with " + _REQ + """ select mention_id, geonameId, 0.95::double confidence, r as place_rank from (select req.mention_id, p.geonameId, row_number() over (partition by mention_id order by p.population desc nulls last, p.geonameId)::int r
 from req join nm2 using (wanted) join p using (geonameId) where p.countryCode = coalesce(req.country, 'CA') and contains(p.countryCode || '.' || p.admin1Code, req.admin1)) where r <= 20""")
def recon_admin(spark, d):
    p = _gazetteer(spark, d)
    return reconcile.administrative(_requests(spark, d), p, _located(p)).select("mention_id", "geonameId", "confidence", "place_rank")


def _located(p):
    return p.where("countryCode is not null and admin1Code is not null").select(F.col("geonameId").alias("src"), F.concat_ws(".", "countryCode", "admin1Code").alias("division"))


@query("with " + _REQ + f""", k as (select req.mention_id, p.geonameId, radius, {km_sql('req', 'p')} km from req join nm2 using (wanted) join p using (geonameId))
 select mention_id, geonameId, round(1 - km / radius, 3) confidence, r as place_rank from (select *, row_number() over (partition by mention_id order by km, geonameId)::int r from k where km <= radius) where r <= 20""")
def recon_geo(spark, d):
    return reconcile.geographic(_requests(spark, d), _gazetteer(spark, d)).select("mention_id", "geonameId", "confidence", "place_rank")


@query("with " + _REQ + """ select mention_id, geonameId, 0.9::double confidence, r as place_rank from (select req.mention_id, p.geonameId, row_number() over (partition by mention_id order by p.geonameId)::int r
 from req join nm using (wanted) join p using (geonameId) where req.hist and p.countryCode = coalesce(req.country, 'CA') and p.featureCode in ('PPLH', 'PPLQ', 'PPLW')) where r <= 20""")
def recon_historical(spark, d):
    return reconcile.historical(_requests(spark, d), _gazetteer(spark, d)).select("mention_id", "geonameId", "confidence", "place_rank")


# The other engine counts edits in bytes: there every letter beyond ASCII stands as a sign that no name holds.
_SIGNS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&*+/:;<=>?@[]^_`|~"
_ODD = ("¥©³¶áãåèéíñóöøúł" + "".join(c for c in _FROM if c not in "áãåèéíñóöøúł"))[: len(_SIGNS)]


def _one_byte(x: str) -> str:
    return f"translate(lower({x}), '{_ODD}', '{_SIGNS}')"


@query(f"""with a as (select distinct lower("name") a from {{w}}), b as (select distinct lower("name") b from {{p}}), j as (select a, b, levenshtein({_one_byte('a')}, {_one_byte('b')})::int distance from a join b on abs(length(a) - length(b)) <= 2)
 select a, b, distance from j where distance <= 2""")
def recon_fuzzy_names(spark, d):
    low = lambda df, to: df.select(F.lower("name").alias(to))
    return within_edits(low(entities(spark, d, "name"), "a"), low(places(spark, d, "name"), "b"), 2)


_SMART = f"""{_ROWS}, pp as (select * from {{p}}),
 nm as (select distinct geonameId, unnest(list_concat(["name"], coalesce(alternateNames, []), coalesce(wikidataAlternateNames, []))) wanted from pp),
 nm2 as (select distinct geonameId, unnest(list_concat(["name"], coalesce(alternateNames, []))) wanted from pp),
 fz as (select mention_id, geonameId, round(1 - dist::double / nullif(length(wanted), 0), 3) confidence, row_number() over (partition by mention_id order by dist, population desc nulls last, geonameId)::int r from
 (select req.mention_id, wanted, pp.geonameId, population, levenshtein({_one_byte('wanted')}, {_one_byte('"name"')}) dist from req join pp on abs(length(wanted) - length("name")) <= 2 and (country is null or countryCode = country)) where dist <= 2)"""


@query("with " + _SMART + " select mention_id, geonameId, confidence, r as place_rank from fz where r <= 20")
def recon_fuzzy(spark, d):
    return reconcile.fuzzy(_requests(spark, d), places(spark, d, "name countryCode population wikidataId")).select("mention_id", "geonameId", "confidence", "place_rank")


@query("with " + _SMART + f""", hits as (
 select req.mention_id, geonameId, 1.0::double confidence, 'exact' strategy, 1 sr, row_number() over (partition by mention_id order by population desc nulls last, geonameId) r from req join nm using (wanted) join pp using (geonameId) where country is null or countryCode = country
 union all select mention_id, geonameId, 0.95, 'administrative', 2, row_number() over (partition by mention_id order by population desc nulls last, geonameId) from req join nm2 using (wanted) join pp using (geonameId)
 where countryCode = coalesce(country, 'CA') and contains(countryCode || '.' || admin1Code, admin1)
 union all select mention_id, geonameId, round(1 - km / radius, 3), 'geographic', 3, row_number() over (partition by mention_id order by km, geonameId) from (select req.mention_id, pp.geonameId, radius, {km_sql('req', 'pp')} km from req join nm2 using (wanted) join pp using (geonameId)) where km <= radius
 union all select mention_id, geonameId, 0.9, 'historical', 4, row_number() over (partition by mention_id order by geonameId) from req join nm using (wanted) join pp using (geonameId) where hist and countryCode = coalesce(country, 'CA') and featureCode in ('PPLH', 'PPLQ', 'PPLW')),
 found as (select * from (select *, row_number() over (partition by mention_id, geonameId order by sr, r) k from hits where r <= 20) where k = 1),
 every as (select mention_id, geonameId, confidence, strategy, sr, r from found union all select mention_id, geonameId, confidence, 'fuzzy', 5, r from fz where r <= 20 and mention_id not in (select mention_id from found group by 1 having count(*) >= 5)),
 one as (select *, row_number() over (partition by mention_id, geonameId order by sr, r) k from every)
 select mention_id, geonameId, strategy, confidence, rk as rank from (select *, row_number() over (partition by mention_id order by confidence desc, sr, r, geonameId)::int rk from one where k = 1 and confidence >= 0.7) where rk <= 10""")
def recon_smart(spark, d):
    p = _gazetteer(spark, d)
    return reconcile.smart(_requests(spark, d), p, _located(p))


# ---- people


def _edge(df: DataFrame, c: str) -> DataFrame:
    return df.select("personId", F.explode(c).alias("place"))


@query("select distinct personId person_id, p.geonameId place, 'BORN_IN' kind from {born} join {p} on p.geonameId = place union all select distinct personId, p.geonameId, 'DIED_IN' from {died} join p on p.geonameId = place")
def explode_join(spark, d):
    h, p = persons(spark, d, "bornIn diedIn"), places(spark, d, "").select(F.col("geonameId").alias("place"))
    one = lambda c, kind: _edge(h, c).join(p, "place", "left_semi").distinct().select(F.col("personId").alias("person_id"), "place", F.lit(kind).alias("kind"))
    return one("bornIn", "BORN_IN").unionByName(one("diedIn", "DIED_IN"))


@query("select role, count(*)::bigint n from (select unnest(occupations) role from {h}) group by 1")
def role_frequency(spark, d):
    return persons(spark, d, "occupations").select(F.explode("occupations").alias("role")).groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@query("""select coalesce(wikidataQid, personId) agent, count(*)::bigint records, count(distinct o)::bigint roles, min(birthDate) first_date, coalesce(string_agg(distinct o, ';' order by o), '') role_list
 from (select wikidataQid, personId, birthDate, unnest(case when len(occupations) > 0 then occupations else [null] end) o from {h}) group by 1""")
def agent_rollup(spark, d):
    h = persons(spark, d, "wikidataQid birthDate occupations").select(F.coalesce("wikidataQid", "personId").alias("agent"), "birthDate", F.explode_outer("occupations").alias("o"))
    return h.groupBy("agent").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("o").alias("roles"), F.min("birthDate").alias("first_date"), _joined(F.collect_set("o")).alias("role_list"))


@query("select l.src qid, l.dst place, c.code stated, p.countryCode found from {idlink} l join {w} on w.qid = l.src join {p} on p.geonameId = l.dst join country c on upper(trim(c.qid)) = w.countryQid where p.countryCode <> c.code")
def admin_vs_geo_parent(spark, d):
    c = table(spark, d, "country").select(F.upper(F.trim("qid")).alias("countryQid"), F.col("code").alias("stated"))
    j = link_by_id(spark, d).join(entities(spark, d, "countryQid").select(F.col("qid").alias("src"), "countryQid"), "src").join(places(spark, d, "countryCode").select(F.col("geonameId").alias("dst"), F.col("countryCode").alias("found")), "dst")
    return j.join(c, "countryQid").where(F.col("found") != F.col("stated")).select(F.col("src").alias("qid"), F.col("dst").alias("place"), "stated", "found")


@query("select place, n::bigint persons, (n * (n - 1) // 2)::bigint pairs, lowest from (select place, count(distinct personId) n, min(personId) lowest from {born} group by 1) where n > 1")
def shared_place_groups(spark, d):
    g = _edge(persons(spark, d, "bornIn"), "bornIn").groupBy("place").agg(F.countDistinct("personId").alias("persons"), F.min("personId").alias("lowest")).where("persons > 1")
    return g.select("place", "persons", F.expr("persons * (persons - 1) div 2").alias("pairs"), "lowest")


def _parents(h: DataFrame) -> DataFrame:
    return h.select(F.inline(F.array(F.struct(F.col("personId").alias("child"), F.col("motherId").alias("parent"), F.lit("mother").alias("kind")), F.struct(F.col("personId").alias("child"), F.col("fatherId").alias("parent"), F.lit("father").alias("kind"))))).where("parent is not null")


@query("select x person_id, count(distinct y)::bigint relatives from (select child x, parent y from {parent} union all select parent, child from parent) group by 1")
def family_links(spark, d):
    e = graph.undirected(_parents(persons(spark, d, "motherId fatherId")).select(F.col("child").alias("src"), F.col("parent").alias("dst")))
    return e.groupBy(F.col("src").alias("person_id")).agg(F.count(F.lit(1)).alias("relatives"))


@query("select distinct a, b from {pair}")
def unordered_pair_set(spark, d):
    return tables.unordered_pairs(_pairs(spark, d).select(F.col("dst").alias("a"), F.col("src").alias("b")), "a", "b")


@query("select parent, count(distinct child)::bigint children from {parent} group by 1 having count(distinct child) > 1")
def parent_children_gt1(spark, d):
    return _parents(persons(spark, d, "motherId fatherId")).groupBy("parent").agg(F.countDistinct("child").alias("children")).where("children > 1")


@query("select c.code country, count(distinct b.personId)::bigint born from country c left join (select personId, countryCode from {born} join {p} on p.geonameId = place) b on b.countryCode = c.code group by 1")
def born_left(spark, d):
    b = _edge(persons(spark, d, "bornIn"), "bornIn").join(places(spark, d, "countryCode").select(F.col("geonameId").alias("place"), F.col("countryCode").alias("country")), "place")
    return table(spark, d, "country").select(F.col("code").alias("country")).join(b, "country", "left").groupBy("country").agg(F.countDistinct("personId").alias("born"))


@query("select idType id_type, count(*)::bigint n from {h} where exists (select 1 from {born} b join {p} on p.geonameId = b.place where b.personId = h.personId) group by 1")
def semi_exists(spark, d):
    h = persons(spark, d, "idType bornIn")
    known = _edge(h, "bornIn").join(places(spark, d, "").select(F.col("geonameId").alias("place")), "place", "left_semi")
    return h.join(known, "personId", "left_semi").groupBy(F.col("idType").alias("id_type")).agg(F.count(F.lit(1)).alias("n"))


@query("select countryQid country_qid, count(*)::bigint unlinked from {w} where qid not in (select src from {idlink}) group by 1")
def unlinked_by_country(spark, d):
    w = entities(spark, d, "countryQid")
    return w.join(link_by_id(spark, d).select(F.col("src").alias("qid")), "qid", "left_anti").groupBy(F.col("countryQid").alias("country_qid")).agg(F.count(F.lit(1)).alias("unlinked"))


def _flows(spark, d):
    h, p = persons(spark, d, "bornIn diedIn"), places(spark, d, "countryCode").where("countryCode is not null")
    b = _edge(h, "bornIn").join(p.select(F.col("geonameId").alias("place"), F.col("countryCode").alias("birth")), "place").drop("place")
    e = _edge(h, "diedIn").join(p.select(F.col("geonameId").alias("place"), F.col("countryCode").alias("death")), "place").drop("place")
    return b.join(e, "personId").groupBy("birth", "death").agg(F.count(F.lit(1)).alias("n"))


@query("select birth, death, n from {flow}")
def migration_flows(spark, d):
    return _flows(spark, d)


@query("select birth, death, n from {flow} where birth <> death order by n desc, birth, death limit 20")
def cross_border_top(spark, d):
    return _flows(spark, d).where("birth <> death").orderBy(F.col("n").desc(), "birth", "death").limit(20)


@query("select n as flow_size, count(*)::bigint flows, sum(n)::bigint people from {flow} group by 1")
def flow_distribution(spark, d):
    return _flows(spark, d).groupBy(F.col("n").alias("flow_size")).agg(F.count(F.lit(1)).alias("flows"), F.sum("n").alias("people"))


@query("select t as threshold, count(*) filter (n >= t)::bigint flows, coalesce(sum(n) filter (n >= t), 0)::bigint people from {flow}, (select unnest([1, 2, 3, 5, 10]) t) group by 1")
def threshold_sweep(spark, d):
    f = _flows(spark, d).withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in (1, 2, 3, 5, 10)])))
    ok = F.col("n") >= F.col("threshold")
    return f.groupBy("threshold").agg(F.count_if(ok).alias("flows"), F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("people"))


@query("select country, max(n)::bigint largest from (select birth country, n from {flow} union all select death, n from flow) group by 1 having max(n) < 3")
def weak_countries(spark, d):
    f = _flows(spark, d)
    both = f.select(F.col("birth").alias("country"), "n").unionByName(f.select(F.col("death").alias("country"), "n"))
    return both.groupBy("country").agg(F.max("n").alias("largest")).where("largest < 3")


@query("""select coalesce(b.place, x.place) place, coalesce(b.n, 0)::bigint born_here, coalesce(x.n, 0)::bigint died_here from (select place, count(distinct personId) n from {born} group by 1) b
 full join (select place, count(distinct personId) n from {died} group by 1) x on b.place = x.place where coalesce(b.n, 0) + coalesce(x.n, 0) > 1""")
def hub_places(spark, d):
    h = persons(spark, d, "bornIn diedIn")
    n = lambda c, to: _edge(h, c).groupBy("place").agg(F.countDistinct("personId").alias(to))
    return n("bornIn", "born_here").join(n("diedIn", "died_here"), "place", "full").fillna(0, ["born_here", "died_here"]).where("born_here + died_here > 1")


@query("select h.personId person_id, l.dst place, l.src qid from {born} b join {h} on h.personId = b.personId join {idlink} l on l.dst = b.place")
def person_place_chain(spark, d):
    l = link_by_id(spark, d).select(F.col("dst").alias("place"), F.col("src").alias("qid"))
    return _edge(persons(spark, d, "bornIn"), "bornIn").join(l, "place").select(F.col("personId").alias("person_id"), "place", "qid")


# ---- statistics


@query("""select label, n from (select 'Place' as label, count(*)::bigint n from {p} union all select 'WikidataPlace', count(*) from {w} union all select 'HistoricalPerson', count(*) from {h}
 union all select 'BORN_IN', count(*) from {born} union all select 'DIED_IN', count(*) from {died} union all select 'PARENT_OF', count(*) from {parent} union all select 'SAME_AS', count(*) from {idlink})""")
def label_histogram(spark, d):
    h = persons(spark, d, "bornIn diedIn motherId fatherId")
    parts = {"Place": places(spark, d, "").select("geonameId"), "WikidataPlace": entities(spark, d, "").select("qid"), "HistoricalPerson": h.select("personId"), "BORN_IN": _edge(h, "bornIn"), "DIED_IN": _edge(h, "diedIn"), "PARENT_OF": _parents(h), "SAME_AS": link_by_id(spark, d)}
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("label"), "n") for k, df in parts.items()])


@query("""select countryCode country_code, count(*)::bigint n, count(wikidataId)::bigint with_qid, round(count(wikidataId)::double / count(*), 4) qid_share, round(count(lat)::double / count(*), 4) position_share, round(count(admin1Code)::double / count(*), 4) admin1_share from {p} group by 1""")
def coverage_stats(spark, d):
    n = F.count(F.lit(1))
    return places(spark, d, "countryCode wikidataId admin1Code lat").groupBy(F.col("countryCode").alias("country_code")).agg(
        n.alias("n"), F.count("wikidataId").alias("with_qid"), graph.share(F.count("wikidataId"), n).alias("qid_share"), graph.share(F.count("lat"), n).alias("position_share"), graph.share(F.count("admin1Code"), n).alias("admin1_share")
    )


@query("select featureClass feature_class, min(population) least, max(population) most, round(avg(population), 4) mean, sum(population)::bigint total, count(distinct countryCode)::bigint countries from {p} where population > 0 group by 1 having count(*) > 1")
def pop_stats(spark, d):
    g = places(spark, d, "featureClass population countryCode").where("population > 0").groupBy(F.col("featureClass").alias("feature_class"))
    out = g.agg(F.min("population").alias("least"), F.max("population").alias("most"), F.round(F.avg("population"), 4).alias("mean"), F.sum("population").alias("total"), F.countDistinct("countryCode").alias("countries"), F.count(F.lit(1)).alias("c"))
    return out.where("c > 1").drop("c")


@query("select lower(\"name\") key, countryCode country_code, count(*)::bigint n, string_agg(geonameId::varchar, ';' order by geonameId::varchar) ids from {p} group by 1, 2 having count(*) > 1")
def duplicate_keys(spark, d):
    g = places(spark, d, "name countryCode").groupBy(F.lower("name").alias("key"), F.col("countryCode").alias("country_code"))
    return g.agg(F.count(F.lit(1)).alias("n"), _joined(F.collect_list(F.col("geonameId").cast("string"))).alias("ids")).where("n > 1")


@query("select countryCode country_code, string_agg(distinct timezone, '|' order by timezone) zones from {p} where timezone is not null group by 1")
def group_concat(spark, d):
    return places(spark, d, "countryCode timezone").where("timezone is not null").groupBy(F.col("countryCode").alias("country_code")).agg(_joined(F.collect_set("timezone"), "|").alias("zones"))


@query("select code from country where code not in (select countryCode from {p} where countryCode is not null) union all select code || '+' from country where code in (select countryCode from p) and upper(trim(qid)) in (select countryQid from {w})")
def set_operations(spark, d):
    c = table(spark, d, "country").select("code", F.upper(F.trim("qid")).alias("q"))
    codes = places(spark, d, "countryCode").select(F.col("countryCode").alias("code")).where("code is not null").distinct()
    absent = c.select("code").subtract(codes)
    both = c.select("code").intersect(codes).join(c.join(entities(spark, d, "countryQid").select(F.col("countryQid").alias("q")), "q", "left_semi"), "code", "left_semi")
    return absent.unionByName(both.select(F.concat("code", F.lit("+")).alias("code")))


@query("""select * from (select 'last' rule, geonameId, population, row_number() over (order by population desc nulls last, geonameId)::int r from {p} union all
 select 'first', geonameId, population, row_number() over (order by population desc nulls first, geonameId)::int from p) where r <= 10""")
def null_orders(spark, d):
    p = places(spark, d, "population").select("geonameId", "population")

    def top(rule: str, order) -> DataFrame:
        ten = p.orderBy(order, "geonameId").limit(10)
        return ten.withColumn("r", F.row_number().over(Window.orderBy(order, "geonameId"))).select(F.lit(rule).alias("rule"), "geonameId", "population", "r")

    return top("last", F.col("population").desc_nulls_last()).unionByName(top("first", F.col("population").desc_nulls_first()))


@query("""select y as year, count(*)::bigint active from (select try_cast(regexp_extract(inceptionDate, '^(-?[0-9]+)', 1) as int) a, try_cast(nullif(regexp_extract(coalesce(dissolvedDate, ''), '^(-?[0-9]+)', 1), '') as int) z from {w} where inceptionDate is not null),
 (select unnest([1700, 1750, 1800, 1850, 1900, 1912, 1950]) y) where a <= y and (z is null or z >= y) group by 1""")
def active_in_year(spark, d):
    year = lambda c: F.regexp_extract(F.coalesce(c, F.lit("")), r"^(-?[0-9]+)", 1).try_cast("int")
    w = entities(spark, d, "inceptionDate dissolvedDate").select(year("inceptionDate").alias("a"), year("dissolvedDate").alias("z"), F.explode(F.array(*[F.lit(y) for y in (1700, 1750, 1800, 1850, 1900, 1912, 1950)])).alias("year"))
    return w.where("a <= year and (z is null or z >= year)").groupBy("year").agg(F.count(F.lit(1)).alias("active"))


@query("select term, count(distinct doc_id)::bigint documents, count(*)::bigint occurrences from (select doc_id, unnest(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')) term from documents) where term <> '' group by 1")
def fulltext_terms(spark, d):
    """Words of every length and script in whole texts."""
    t = table(spark, d, "documents").select("doc_id", F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("term")).where("term <> ''")
    # Occurrences of a document are counted before documents are: each (term, document) travels once.
    n = t.groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("term").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("occurrences"))


@query("""with q as (select vec_id, embedding::double[] e from embeddings where vec_id % 100 = 0), s as (select q.vec_id query_id, b.vec_id, round(list_cosine_similarity(q.e, b.embedding::double[]), 6) similarity from q join embeddings b on b.vec_id <> q.vec_id)
 select query_id, vec_id, similarity from (select *, row_number() over (partition by query_id order by similarity desc, vec_id) r from s) where r <= 10""")
def cosine_topk(spark, d):
    """Ten nearest vectors of the stated query set, every id divisible by 100, against all rows."""
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    norm = F.sqrt(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x))
    v = v.withColumn("e", F.transform("e", lambda x: F.try_divide(x, norm)))
    q = v.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), F.col("e").alias("qe"))
    # Every block of queries meets all rows; a block is small whatever the table's size.
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    best = []
    for b in range(blocks):
        part = q if blocks == 1 else q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        s = v.join(F.broadcast(part), F.col("vec_id") != F.col("query_id"))
        s = s.select("query_id", "vec_id", F.round(F.aggregate(F.zip_with("e", "qe", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x), 6).alias("similarity"))
        w = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "vec_id")
        best.append(s.withColumn("r", F.row_number().over(w)).where("r <= 10").drop("r"))
    return reduce(DataFrame.unionByName, best)
