"""Name to ranked places: five strategies over a table of requests, merged.

Requests have mention_id, name, country, admin1, lat, lon, radius_km and
historical; a null switches the strategy that needs it off.  Places have
geonameId, wikidataId, name, alternateNames, wikidataAlternateNames,
countryCode, featureCode, population, lat, lon, dissolvedDate.  Each strategy
keeps its best 20 per request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoweave.functions import geo
from geoweave.operators.edits import within_edits
from geoweave.operators.tables import first_wins

_KEEP = ["mention_id", "geonameId", "wikidataId", "name", "population", "confidence"]
# Feature codes of places that are no more.
_GONE = ["PPLH", "PPLQ", "PPLW"]


def _best(df: DataFrame, order: list[Column], strategy: str, rank: int) -> DataFrame:
    w = Window.partitionBy("mention_id").orderBy(*order, "geonameId")
    df = df.withColumn("place_rank", F.row_number().over(w)).where("place_rank <= 20")
    return df.select(*_KEEP, F.lit(strategy).alias("strategy"), F.lit(rank).alias("strategy_rank"), "place_rank")


def _found(requests: DataFrame, places: DataFrame, strategies: list[str], located: DataFrame | None = None, default_country: str = "CA") -> DataFrame:
    """The best 20 places per request and strategy, of those that rest on equal names.

    Requests meet the index of main and alternate names once; every strategy is
    a condition on the pairs so found, with its own confidence and order.
    """
    none = F.array().cast("array<string>")
    main = F.array_compact(F.concat(F.array("name"), F.coalesce("alternateNames", none)))
    extra = F.array_except(F.array_compact(F.coalesce("wikidataAlternateNames", none)), main)
    tagged = lambda names, flag: F.transform(F.array_distinct(names), lambda x: F.struct(x.alias("wanted"), F.lit(flag).alias("extra")))
    index = places.select(*[c for c in places.columns if c not in ("alternateNames", "wikidataAlternateNames")], F.inline(F.concat(tagged(main, False), tagged(extra, True))))
    if located is not None:
        index = index.join(located.groupBy(F.col("src").alias("geonameId")).agg(F.collect_set("division").alias("divisions")), "geonameId", "left")
    j = requests.withColumnsRenamed({"name": "wanted", "lat": "at_lat", "lon": "at_lon"}).join(index, "wanted")
    here = F.col("countryCode") == F.coalesce("country", F.lit(default_country))
    radius = F.coalesce("radius_km", F.lit(50.0))
    j = j.withColumn("km", F.round(geo.haversine_km(F.col("lat"), F.col("lon"), F.col("at_lat"), F.col("at_lon")), 3))
    most = -F.col("population").cast("double")
    rules = {
        "exact": (1, _in_country(), F.lit(1.0), most, None),
        "administrative": (2, ~F.col("extra") & here & F.exists("divisions", lambda x: x.contains(F.col("admin1"))) if located is not None else None, F.lit(0.95), most, None),
        "geographic": (3, ~F.col("extra") & (F.col("km") <= radius), F.round(1 - F.col("km") / radius, 3), F.col("km"), None),
        "historical": (4, F.col("historical") & here & (F.col("featureCode").isin(_GONE) | F.col("dissolvedDate").isNotNull()), F.lit(0.9), None, F.col("dissolvedDate")),
    }
    rows = []
    for name in strategies:
        rank, holds, confidence, number, text = rules[name]
        number, text = F.lit(None) if number is None else number, F.lit(None) if text is None else text
        rows.append(F.when(F.coalesce(holds, F.lit(False)), F.struct(confidence.alias("confidence"), F.lit(name).alias("strategy"), F.lit(rank).alias("strategy_rank"), number.cast("double").alias("_n"), text.cast("string").alias("_t"))))
    hits = j.select(*[c for c in _KEEP if c not in ("confidence", "name")], F.col("name") if "name" in j.columns else F.lit(None).cast("string").alias("name"), F.inline(F.array_compact(F.array(*rows))))
    w = Window.partitionBy("mention_id", "strategy").orderBy(F.col("_n").asc_nulls_last(), F.col("_t").desc_nulls_last(), "geonameId")
    return hits.withColumn("place_rank", F.row_number().over(w)).where("place_rank <= 20").select(*_KEEP, "strategy", "strategy_rank", "place_rank")


def _in_country(c: str = "country") -> Column:
    return F.col(c).isNull() | (F.col("countryCode") == F.col(c))


def exact(requests: DataFrame, places: DataFrame) -> DataFrame:
    return _found(requests, places, ["exact"])


def administrative(requests: DataFrame, places: DataFrame, located: DataFrame, default_country: str = "CA") -> DataFrame:
    """``located``: (src place, division code or name)."""
    return _found(requests, places, ["administrative"], located, default_country)


def geographic(requests: DataFrame, places: DataFrame) -> DataFrame:
    return _found(requests, places, ["geographic"])


def historical(requests: DataFrame, places: DataFrame, default_country: str = "CA") -> DataFrame:
    return _found(requests, places, ["historical"], default_country=default_country)


def fuzzy(requests: DataFrame, places: DataFrame, edits: int = 2) -> DataFrame:
    """Distances are between distinct lower-case names; pieces shared by an equi-join name the candidates.

    The best places depend on name and country alone, so they are ranked once
    for all requests that share both; of the places of one name and country no
    more than the first 20 can be among them.  The joins are hinted, as sizes
    are not known before names have met.
    """
    r = requests.select("mention_id", F.col("country").alias("wanted"), F.lower("name").alias("a"), F.length("name").alias("size"))
    p = places.select("geonameId", "wikidataId", "name", "population", "countryCode", F.lower("name").alias("b"))
    near = within_edits(r, p, edits)
    first = lambda df, keys, *order: df.withColumn("place_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.col("population").desc_nulls_last(), "geonameId"))).where("place_rank <= 20")
    p = first(p.where("b is not null"), ["b", "countryCode"]).drop("place_rank")
    asked = r.select("a", "wanted").where("a is not null").distinct()
    j = asked.join(near.hint("merge"), "a").join(p.hint("merge"), "b").where(F.col("wanted").isNull() | (F.col("countryCode") == F.col("wanted")))
    best = first(j, ["a", "wanted"], F.col("distance")).select(F.col("a").alias("_a"), F.col("wanted").alias("_wanted"), *[c for c in _KEEP if c not in ("mention_id", "confidence")], "distance")
    j = r.join(best.hint("merge"), (F.col("a") == F.col("_a")) & F.col("wanted").eqNullSafe(F.col("_wanted")))
    j = j.withColumn("confidence", F.round(1 - F.try_divide(F.col("distance").cast("double"), F.col("size")), 3))
    return _best(j, [F.col("distance"), F.col("population").desc_nulls_last()], "fuzzy", 5)


def smart(requests: DataFrame, places: DataFrame, located: DataFrame, threshold: float = 0.7, limit: int = 10) -> DataFrame:
    """The merged answer: first strategy wins a place, fuzzy only where fewer than five were found.

    Result: mention_id, geonameId, strategy, confidence, rank.
    """
    found = _found(requests, places, ["exact", "administrative", "geographic", "historical"], located)
    order = [F.col("strategy_rank"), F.col("place_rank")]
    found = first_wins(found, ["mention_id", "geonameId", "wikidataId"], order)
    enough = found.groupBy("mention_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")
    more = fuzzy(requests.join(enough, "mention_id", "left_anti"), places)
    both = first_wins(found.unionByName(more), ["mention_id", "geonameId", "wikidataId"], order).where(F.col("confidence") >= threshold)
    w = Window.partitionBy("mention_id").orderBy(F.col("confidence").desc(), *order, "geonameId")
    return both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).select("mention_id", "geonameId", "strategy", "confidence", "rank")
