"""Linkers: by stored identifier, by distance and name in three profiles, and for historical points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweave.functions import ids, scores
from geoweave.functions.text import office_name, province_codes
from geoweave.operators import cells

#: Radius in km, candidates scored per source, least confidence of each profile.
PROFILES = {"canada": (10.0, 10, 0.5), "global": (10.0, 10, 0.5), "nearest": (10.0, 1, 0.7)}


def by_id(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """(src, dst) where a source's stored gazetteer number, in any notation, is a target's id.

    ``sources`` has id and ref; ``targets`` has id.  Unreadable numbers link nothing.
    """
    s = sources.select(F.col("id").alias("src"), ids.gazetteer_id(F.regexp_replace("ref", r"\.0+$", "")).alias("dst")).where("dst is not null")
    return s.join(targets.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst").distinct()


def spatial(sources: DataFrame, targets: DataFrame, profile: str) -> DataFrame:
    """(src, dst, km, confidence, relation) of one profile; every source is linked in one pass.

    Both sides have id, name, lat, lon; sources label, targets code.  Distance
    and confidence are rounded to three places before they are compared.
    """
    km, k, least = PROFILES[profile]
    near = cells.knn(sources, targets, km, k)
    s = sources.select(F.col("id").alias("src_id"), F.col("name").alias("sname"), "label")
    t = targets.select(F.col("id").alias("dst_id"), F.col("name").alias("tname"), "code")
    j = near.join(s, "src_id").join(t, "dst_id")
    mine = scores.label_priority(F.col("label")) if profile == "canada" else F.lit(70)
    theirs = scores.code_priority(F.col("code"))
    kind = F.lit(0.7) if profile == "nearest" else scores.type_score(mine, theirs)
    conf = scores.confidence(scores.distance_score(F.col("km")), scores.name_score(F.col("sname"), F.col("tname")), kind)
    j = j.withColumn("confidence", F.round(conf, 3)).where(F.col("confidence") >= least)
    rel = scores.relation(profile, mine, theirs, F.col("km"), F.col("confidence"))
    return j.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "km", "confidence", rel.alias("relation"))


def same_as_too(links: DataFrame) -> DataFrame:
    """NEAR links that are certain and close are SAME_AS as well."""
    sure = (F.col("relation") == "NEAR") & (F.col("confidence") >= 0.85) & (F.col("km") <= 1)
    return links.unionByName(links.where(sure).withColumn("relation", F.lit("SAME_AS")))


def historical(points: DataFrame, places: DataFrame, km: float = 25.0, least: float = 0.6, candidates: int = 50) -> DataFrame:
    """Scored candidates of historical points: (point, place, km, score, rank), best first.

    ``points``: id, name, lat, lon.  ``places``: id, name, label, code, class,
    population, lat, lon.
    """
    near = cells.knn(points, places, km, candidates).drop("rank")
    p = points.select(F.col("id").alias("src_id"), F.col("name").alias("target_name"))
    c = places.select(F.col("id").alias("dst_id"), "name", "label", "code", "class", "population")
    j = near.join(p, "src_id").join(c, "dst_id")
    score = scores.historical_confidence(
        scores.distance_score(F.col("km"), historical=True), scores.historical_priority(F.col("label"), F.col("code"), F.col("class")),
        scores.name_score(F.col("name"), F.col("target_name"), by_target=True), scores.population_weight(F.col("population")),
    )
    j = j.withColumn("score", F.round(score, 3)).where(F.col("score") >= least)
    w = Window.partitionBy("src_id").orderBy(F.col("score").desc(), "km", "dst_id")
    return j.select(F.col("src_id").alias("point"), F.col("dst_id").alias("place"), "km", "score", F.row_number().over(w).alias("rank"))


def by_name_and_province(offices: DataFrame, places: DataFrame) -> DataFrame:
    """(office, place): a normalised name and province that lead to exactly one place.

    ``offices``: id, name, province.  ``places``: id, name, admin1.
    """
    o = offices.select(F.col("id").alias("office"), office_name(F.col("name")).alias("key"), F.explode(F.concat(F.coalesce(province_codes(F.col("province")), F.array().cast("array<string>")), F.array("province"))).alias("admin1"))
    p = places.select(F.col("id").alias("place"), F.lower("name").alias("key"), "admin1")
    j = o.join(p, ["key", "admin1"]).select("office", "place").distinct()
    return j.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("office"))).where("n = 1").drop("n")
