"""Gazetteer dumps: 19 tab-separated columns, no header, no quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoweave.functions.text import split_names

COLUMNS = (
    "geonameid name asciiname alternatenames latitude longitude feature_class feature_code country_code cc2 "
    "admin1_code admin2_code admin3_code admin4_code population elevation dem timezone modification_date"
).split()
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows, all text.  Quotes are ordinary characters; a row's tabs and line ends separate."""
    return spark.read.csv(path, sep="\t", quote="", header=False, schema=SCHEMA, encoding="UTF-8")


def cleanse(raw: DataFrame, keep_without_position: bool = False, missing_numbers: int | None = 0) -> DataFrame:
    """Typed places.  Rows whose id is no number are dropped, as are rows without
    a readable position unless asked for; missing numbers are ``missing_numbers``, missing codes ''."""
    num = lambda c, t: F.coalesce(F.col(c).try_cast(t), F.lit(missing_numbers).cast(t))
    text = lambda c: F.coalesce(c, F.lit(""))
    out = raw.select(
        F.col("geonameid").try_cast("bigint").alias("geonameId"), "name", F.col("asciiname").alias("asciiName"), split_names(F.col("alternatenames")).alias("alternateNames"),
        F.col("latitude").try_cast("double").alias("latitude"), F.col("longitude").try_cast("double").alias("longitude"),
        F.col("feature_class").alias("featureClass"), F.col("feature_code").alias("featureCode"),
        F.when(F.col("feature_class").isNotNull() & F.col("feature_code").isNotNull(), F.concat_ws(".", "feature_class", "feature_code")).alias("fullFeatureCode"),
        F.col("country_code").alias("countryCode"), *[text(f"admin{i}_code").alias(f"admin{i}Code") for i in (1, 2, 3, 4)],
        num("population", "bigint").alias("population"), num("elevation", "int").alias("elevation"), "timezone", F.col("modification_date").alias("modifiedDate"),
    ).where("geonameId is not null")
    return out if keep_without_position else out.where("latitude is not null and longitude is not null")


def by_country(places: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Upper-cased sets; a country in both is excluded."""
    if exclude:
        places = places.where(~F.coalesce(F.col("countryCode"), F.lit("")).isin([c.upper() for c in exclude]))
    return places.where(F.col("countryCode").isin([c.upper() for c in include])) if include else places


def by_feature(places: DataFrame, features: list[str]) -> DataFrame:
    """Entries with a dot are class.code, others classes; either suffices."""
    return places.where(F.col("featureClass").isin([f for f in features if "." not in f]) | F.col("fullFeatureCode").isin([f for f in features if "." in f]))


def after(raw: DataFrame, rows: int) -> DataFrame:
    """Without the first ``rows`` physical rows, files in the order of the scan, to resume a broken load.

    Row numbers are those of the scan's partitions plus the sizes of the ones
    before, one row per partition; no row leaves the JVM.
    """
    at = raw.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)).withColumn("_nth", F.col("_at").bitwiseAND((1 << 33) - 1))
    sizes = at.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return at.join(F.broadcast(before), "_part").where(F.col("_before") + F.col("_nth") >= rows).select(*raw.columns)


def dry_run(raw: DataFrame) -> DataFrame:
    """What a load would do, without doing it: one row with rows, kept, without_id, without_position."""
    p = raw.select(F.col("geonameid").try_cast("bigint").alias("i"), F.col("latitude").try_cast("double").alias("a"), F.col("longitude").try_cast("double").alias("o"))
    ok, at = F.col("i").isNotNull(), F.col("a").isNotNull() & F.col("o").isNotNull()
    return p.agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok & at).alias("kept"), F.count_if(~ok).alias("without_id"), F.count_if(ok & ~at).alias("without_position"))


def write(places: DataFrame, path: str) -> None:
    """A dump in the same 19 columns, from columns of their names; line ends and tabs in values become blanks."""
    text = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\t\r\n]", " ")
    places.select(F.concat_ws("\t", *[text(c) if c in places.columns else F.lit("") for c in COLUMNS]).alias("value")).write.mode("overwrite").text(path)


def top_codes(places: DataFrame, n: int = 50) -> DataFrame:
    g = places.groupBy("fullFeatureCode").agg(F.count(F.lit(1)).alias("n"))
    whole = g.agg(F.sum("n").alias("all"))
    return g.join(F.broadcast(whole)).select("fullFeatureCode", "n", F.round(100.0 * F.col("n") / F.col("all"), 2).alias("pct")).orderBy(F.col("n").desc(), "fullFeatureCode").limit(n)
