"""Inverted index of the words of a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.runtime import Scratch


def word_index(df: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """(term, key, times): the words of whole texts, letters and digits of any script in lower case.

    Postings are range-partitioned and sorted by term, so a look-up reads only
    the row groups whose bounds hold the words sought.  Null and empty texts
    have no words.  A word that very many rows hold spreads over partitions.
    """
    words = df.select(key, F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}]+")).alias("term")).where("term <> ''")
    postings = words.groupBy("term", key).agg(F.count(F.lit(1)).alias("times"))
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    index = scratch.save(postings.repartitionByRange(parts, "term", key).sortWithinPartitions("term", key), "postings")
    index._rows = df.select(key).distinct().count()
    return index


def search_words(index: DataFrame, words: list[str], least: int = 1) -> DataFrame:
    """(key, terms, score): rows with at least ``least`` of the words; each adds ln(1 + rows / rows that hold it)."""
    key = index.columns[1]
    hits = index.where(F.col("term").isin([w.lower() for w in words])).select("term", key)
    df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # One row per word sought.
    weighed = hits.join(F.broadcast(df), "term").withColumn("w", F.log(1 + F.lit(float(index._rows)) / F.col("df")))
    return weighed.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("terms"), F.round(F.sum("w"), 6).alias("score")).where(F.col("terms") >= least)
