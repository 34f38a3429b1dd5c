"""Entity dumps: one JSON entity per line inside an array, usually compressed.

The dump is parsed once to typed rows; geographic entities, people and
organisations are three projections of the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import claims as c
from geoweave.functions.text import article_url, label_or

SCHEMA = (
    "id string, labels map<string,struct<value:string>>, descriptions map<string,struct<value:string>>, aliases map<string,array<struct<value:string>>>,"
    " claims map<string,array<struct<mainsnak:struct<snaktype:string,datavalue:struct<type:string,value:string>>>>>, sitelinks map<string,struct<title:string>>"
)
# Types of organisations, places a person or organisation is tied to.
ORGANISATIONS = ["Q43229", "Q4830453", "Q783794", "Q6881511", "Q891723", "Q166280", "Q7210356", "Q16917", "Q1664720", "Q31855", "Q2659904"]
PERSON_PLACES = ["P19", "P20", "P551", "P937", "P27"]
ORGANISATION_PLACES = ["P740", "P159", "P2541", "P131"]


def read(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Entities plus ``ok``: false for lines that are no entity.

    Array brackets and blank lines are skipped, a closing comma is cut.  A
    compressed file is one split, so its rows are spread right after the scan.
    """
    t = spark.read.text(path)
    if partitions:
        t = t.repartition(partitions)
    line = F.regexp_replace(F.trim("value"), ",+$", "")
    t = t.select(line.alias("line")).where(~F.col("line").isin("", "[", "]"))
    e = t.select(F.from_json("line", SCHEMA, {"mode": "PERMISSIVE"}).alias("e"))
    return e.select("e.*", F.coalesce(F.col("e.id").isNotNull(), F.lit(False)).alias("ok"))


def _labels(e: DataFrame):
    return F.transform(F.coalesce(F.map_values("labels"), F.array().cast("array<struct<value:string>>")), lambda x: x["value"])


def geographic(e: DataFrame, historical_types: list[str] = ()) -> DataFrame:
    """Entities with a usable position; the first usable of several counts."""
    k = F.col("claims")
    alias = F.transform(F.flatten(F.coalesce(F.map_values("aliases"), F.array().cast("array<array<struct<value:string>>>"))), lambda x: x["value"])
    name = label_or(F.col("labels"), F.col("id"))
    e = e.where("ok").withColumn("at", c.first_usable(k, "P625", c.spot)).where("at is not null").withColumn("name", name)
    others = F.array_except(F.array_compact(F.array_union(_labels(e), alias)), F.array("name"))
    kinds = F.filter(F.transform(c.statements(k, "P31"), c.item), lambda x: x.isNotNull())
    one = lambda p, f, to: c.first(k, p, f).alias(to)
    return e.select(
        F.col("id").alias("qid"), "name", F.try_element_at("descriptions", F.lit("en"))["value"].alias("description"), F.col("at.lat").alias("latitude"), F.col("at.lon").alias("longitude"),
        F.when(F.size(others) > 0, F.sort_array(others)).alias("alternateNames"), c.several(k, "P1448", c.string).alias("officialNames"), F.get(kinds, F.lit(0)).alias("instanceOfQid"),
        F.arrays_overlap(kinds, F.array(*[F.lit(t) for t in historical_types]).cast("array<string>")).alias("isHistorical"), one("P1566", c.string, "geonamesId"),
        one("P1705", c.string, "nativeLabel"), one("P1449", c.string, "nickname"), one("P1082", c.quantity, "population"),
        one("P571", c.time, "inceptionDate"), one("P576", c.time, "dissolvedDate"), one("P576", c.time, "abolishedDate"),
        one("P1365", c.item, "replacesQid"), one("P1366", c.item, "replacedByQid"), one("P155", c.item, "followsQid"), one("P156", c.item, "followedByQid"),
        one("P112", c.item, "foundedByQid"), one("P127", c.item, "ownedByQid"), one("P1376", c.item, "capitalOfQid"), one("P17", c.item, "countryQid"),
        one("P227", c.string, "gndId"), one("P214", c.string, "viafId"), one("P244", c.string, "locId"), one("P1667", c.string, "tgnId"), one("P402", c.string, "osmId"), one("P6766", c.string, "wofId"),
        one("P7959", c.item, "historicCountyQid"), one("P856", c.string, "officialWebsite"), article_url(F.try_element_at("sitelinks", F.lit("enwiki"))["title"]).alias("wikipediaUrl"),
    )


def _typed(e: DataFrame, types: list[str], places: list[str]) -> DataFrame:
    """Entities of one of the types, tied to a place, with an English label."""
    kinds = F.transform(c.statements(F.col("claims"), "P31"), c.item)
    name = F.try_element_at("labels", F.lit("en"))["value"]
    is_one = F.coalesce(F.arrays_overlap(F.array_compact(kinds), F.array(*[F.lit(t) for t in types])), F.lit(False))
    return e.where("ok").where(is_one & c.has_any(F.col("claims"), places)).withColumn("name", name).where("name is not null and name <> ''")


def people(e: DataFrame) -> DataFrame:
    k = F.col("claims")
    one = lambda p, f, to: c.first(k, p, f).alias(to)
    some = lambda p, to, n=5: c.several(k, p, c.item, n).alias(to)
    return _typed(e, ["Q5"], PERSON_PLACES).select(
        F.col("id").alias("wikidataId"), "name", one("P569", c.time, "dateOfBirth"), one("P570", c.time, "dateOfDeath"), one("P19", c.item, "birthPlaceQid"), one("P20", c.item, "deathPlaceQid"),
        one("P27", c.item, "citizenshipQid"), some("P551", "residenceQids"), some("P937", "workLocationQids"), some("P106", "occupationQids"), some("P39", "positionQids"), some("P108", "employerQids", 3),
        one("P214", c.string, "viafId"), one("P227", c.string, "gndId"), one("P244", c.string, "locId"),
    )


def organisations(e: DataFrame) -> DataFrame:
    k = F.col("claims")
    one = lambda p, f, to: c.first(k, p, f).alias(to)
    return _typed(e, ORGANISATIONS, ORGANISATION_PLACES).select(
        F.col("id").alias("wikidataId"), "name", one("P571", c.time, "founded"), one("P576", c.time, "dissolved"), one("P740", c.item, "foundedInQid"), one("P159", c.item, "headquartersQid"),
        one("P131", c.item, "locatedInQid"), one("P749", c.item, "parentOrgQid"), one("P452", c.item, "industryQid"), one("P1448", c.string, "officialName"),
        c.several(k, "P2541", c.item, 10).alias("operatingAreaQids"), c.several(k, "P112", c.item, 5).alias("founderQids"),
    )


def counters(geo: DataFrame) -> DataFrame:
    """Parse statistics of the geographic projection; an entity both founded and owned counts twice as colonial."""
    some = lambda *cs: F.count_if(F.coalesce(*[F.col(x) for x in cs]).isNotNull())
    return geo.agg(
        F.count(F.lit(1)).alias("with_coordinates"), some("geonamesId").alias("with_geonames"), some("alternateNames").alias("with_alternate_names"), F.count_if("isHistorical").alias("historical_entities"),
        (some("foundedByQid") + some("ownedByQid")).alias("colonial_entities"), some("gndId", "viafId", "locId", "tgnId", "osmId", "wofId").alias("with_cross_db_ids"),
    )
