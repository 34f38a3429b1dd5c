"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled (keyed hash) order; copy r of a
document finishes at (r x source size + tokens up to and with it) / weight in
virtual time.  Taking all documents of all sources by finish time until the
budget is full serves every source in proportion to its weight; a source whose
copies are used up drops out and the others share the rest.

The queue of all copies is range-sorted as a whole; running totals come from the
sorted partitions and the sums of those before, and the queue ends where a mix's
budget is full.  No window spans more than a slice of a source.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from geoweave.runtime import Scratch

#: Documents per slice of a two-level prefix sum.
SLICE = 50_000
#: Targets up to this many are broadcast.
FEW = 100_000


def token_frames(ranks: bytes, pattern: str):
    """mapInPandas function over (doc_id, source, text): (doc_id, source, tokens).

    ``ranks`` is the content of a public rank file (base64 token, rank per
    line).  A null text has no tokens; whole texts are counted.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for df in frames:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in df["text"]]
            yield pd.DataFrame({"doc_id": df["doc_id"], "source": df["source"], "tokens": n})

    return run


def source_name(c: Column) -> Column:
    """One name however written: lower case, blanks and hyphens as underscores; null if empty."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-]+", "_")
    return F.when(s != "", s)


def targets(raw: DataFrame, sizes: DataFrame) -> DataFrame:
    """(mix, source, stated, weight, copies, factor, size): weights of sources that have documents.

    Percentages become fractions; repeated rows of a source add up; the weights
    of a mix are scaled to 1 over the sources that have documents, others get
    weight 0.  Null or negative weights count as 0; a null max_repeats is 1.
    """
    stated = F.when(F.lower("unit") == "percent", F.col("weight") / 100).otherwise(F.col("weight"))
    t = raw.select("mix", source_name(F.col("source")).alias("source"), F.greatest(F.coalesce(F.when(F.isnan(stated), None).otherwise(stated), F.lit(0.0)), F.lit(0.0)).alias("stated"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("copies"), F.coalesce("size_factor", F.lit(1.0)).alias("factor"))
    t = t.where("mix is not null and source is not null").groupBy("mix", "source").agg(F.sum("stated").alias("stated"), F.max("copies").alias("copies"), F.max("factor").alias("factor"))
    t = t.join(sizes, "source", "left").withColumn("size", F.coalesce("size", F.lit(0)).cast("long"))
    usable = F.when((F.col("size") > 0) & (F.col("copies") > 0), F.col("stated")).otherwise(0.0)
    whole = F.sum(usable).over(Window.partitionBy("mix"))
    return t.withColumn("weight", F.when(whole > 0, usable / whole).otherwise(0.0))


def _last_time(t: DataFrame, total: DataFrame) -> DataFrame:
    """(mix, budget, horizon): virtual time by which the budget is full, with a margin; null if all copies fit.

    Windows run over one mix's sources, a handful of rows.
    """
    t = t.where("weight > 0").join(total)
    t = t.withColumn("budget", F.floor(F.col("factor") * F.col("total"))).withColumn("cap", F.col("size") * F.col("copies")).withColumn("end", F.col("cap") / F.col("weight"))
    w = Window.partitionBy("mix").orderBy("end", "source")
    before = F.coalesce(F.sum("cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # One document per source may stand beyond the fluid limit.
    spare = F.sum("longest").over(Window.partitionBy("mix"))
    at = (F.col("budget") + spare - before) / rest
    # The first source, by when it runs out, that has not run out when the budget is full.
    t = t.select("mix", "budget", "end", at.alias("at")).withColumn("open", F.when(F.col("at") <= F.col("end"), F.col("end")))
    return t.groupBy("mix").agg(F.max("budget").alias("budget"), F.min_by(F.when(F.col("open").isNotNull(), F.col("at")), "open").alias("horizon"))


def mix(docs: DataFrame, raw_targets: DataFrame, scratch: Scratch, seed: str = "mix") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chosen copies, targets, totals) for every mix.

    ``docs`` has doc_id, source, tokens.  The budget of a mix is its size factor
    times the tokens of all documents, also those without source or target.
    Documents without tokens or without a target are never chosen.  Chosen:
    (mix, source, doc_id, copy, tokens, finish, upto), one row per copy; ``upto``
    is the mix's running total in the order of finish times.
    """
    docs = scratch.save(docs.select("doc_id", "source", "tokens"), "tokens")
    total = scratch.save(docs.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("n")), "total")
    own = docs.where("source is not null and tokens > 0")
    sizes = own.groupBy("source").agg(F.sum("tokens").alias("size"), F.max("tokens").alias("longest"))
    t = scratch.save(targets(raw_targets, sizes), "targets")
    span = _last_time(t, total.select("total").hint("broadcast"))
    # Slices of a source: hash ranges, so that order is random and sums are local.
    order = F.xxhash64("doc_id", F.lit(seed))
    slices = F.greatest(F.lit(1), F.ceil(F.col("n") / SLICE))
    sliced = own.join(total.select("n").hint("broadcast")).withColumn("h", order).withColumn("slice", F.floor((F.col("h") / 2.0**64 + 0.5) * slices)).drop("n")
    part = sliced.groupBy("source", "slice").agg(F.sum("tokens").alias("part"))
    by = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("source", "slice", F.coalesce(F.sum("part").over(by), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "slice").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sliced.withColumn("upto", F.sum("tokens").over(inside)).join(part, ["source", "slice"]).select("source", "doc_id", "tokens", (F.col("base") + F.col("upto")).alias("upto"))
    goal = t.where("weight > 0").join(span, "mix").select("mix", "source", "weight", "copies", "size", "budget", "horizon")
    # The targets are a table of settings; a small one goes to the documents, a large one meets them by key.
    small = F.broadcast if t.count() <= FEW else lambda df: df
    rows = ranked.join(small(goal), "source")
    most = F.when(F.col("horizon").isNull(), F.col("copies")).otherwise(F.least(F.col("copies"), F.floor((F.col("horizon") * F.col("weight") - F.col("upto")) / F.col("size")) + 1)).cast("int")
    rows = rows.withColumn("most", most).where("most > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("most"))))
    rows = rows.withColumn("finish", ((F.col("copy") - 1) * F.col("size") + F.col("upto")) / F.col("weight"))
    # Global order: range partitions, sorted inside, with their own running totals.
    cols = ["mix", "source", "doc_id", "copy", "tokens", "finish"]
    order = ["mix", "finish", "source", "doc_id", "copy"]
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    queue = rows.select(*cols, "budget").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    queue = scratch.save(queue.mapInPandas(_running, StructType([*queue.schema.fields, StructField("part", IntegerType()), StructField("run", LongType())])), "queue")
    # Each mix stands in neighbouring partitions: a row per partition and mix.
    sums = queue.groupBy("mix", "part").agg(F.max("run").alias("here"))
    run = Window.partitionBy("mix").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("mix", "part", F.coalesce(F.sum("here").over(run), F.lit(0)).alias("before"))
    chosen = queue.join(sums, ["mix", "part"]).withColumn("upto", F.col("before") + F.col("run")).where(F.col("upto") <= F.col("budget"))
    return chosen.select(*cols, "upto"), t, total


def _running(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the partition's number and its running total of tokens per mix; rows come sorted by mix."""
    from pyspark import TaskContext

    part, last, base = TaskContext.get().partitionId(), None, 0
    for df in frames:
        if not len(df):
            continue
        run = df.groupby("mix", sort=False)["tokens"].cumsum()
        run += (df["mix"] == last) * base
        last, base = df["mix"].iloc[-1], int(run.iloc[-1])
        yield df.assign(part=part, run=run).astype({"part": "int32", "run": "int64"})


def shares(chosen: DataFrame, t: DataFrame) -> DataFrame:
    """Per mix and source: target and actual share of the tokens, documents, copies.

    Sources without documents stay in the report with share 0.
    """
    got = chosen.groupBy("mix", "source").agg(F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("copies_used"), F.max("copy").alias("most_repeats"))
    out = t.select("mix", "source", F.col("stated").alias("stated_weight"), F.col("weight").alias("target_share"), F.col("copies").alias("max_repeats")).join(got, ["mix", "source"], "left")
    whole = F.sum("tokens").over(Window.partitionBy("mix"))
    out = out.withColumn("actual_share", F.coalesce(F.try_divide(F.col("tokens"), whole), F.lit(0.0)))
    return out.fillna(0, ["tokens", "documents", "copies_used", "most_repeats"])
