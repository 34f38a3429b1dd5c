"""Per-key work over keys of very uneven weight.

Heavy keys are found with a mergeable frequent-items sketch, their rows meet a
broadcast of the (provably few) matching right rows, all other rows take the
ordinary shuffle join, and both parts are unioned.  No key is ever gathered in
one task, no row is dropped or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters the sketch keeps; its error stays under 3.5 / TRACKED of all rows.
TRACKED = 10_000


def heavy_candidates(df: DataFrame, key: str, min_share: float) -> DataFrame:
    """Every non-null key that may hold ``min_share`` of all rows: (key, est, total).

    At most ``1 / (min_share - error)`` rows.  Each key with at least
    ``min_share`` of the rows is among them; a few lighter ones may be too.
    An empty table has no candidates.
    """
    floor = max(min_share - 3.5 / TRACKED, min_share / 2)
    k = min(int(1 / floor) + 2, TRACKED)
    one = df.select(key).agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {TRACKED})").alias("_top"),
        F.count(F.lit(1)).alias("total"),
    )
    return (
        one.select(F.explode("_top").alias("_t"), "total")
        .select(F.col("_t.item").alias(key), F.col("_t.count").alias("est"), "total")
        .where(F.col(key).isNotNull() & (F.col("est") >= F.lit(floor) * F.col("total")))
    )


def heavy_keys(df: DataFrame, key: str, min_share: float) -> DataFrame:
    """Keys that hold at least ``min_share`` of all rows, with exact counts.

    Result: (key, rows, total, share).  Null keys count among all rows but are
    no key; equal notations are compared as stored.  The sketch names the
    candidates, an exact count over the candidates' rows alone decides.
    """
    cand = heavy_candidates(df, key, min_share).select(F.col(key).alias("_k"), "total")
    exact = df.select(key).join(F.broadcast(cand), F.col(key) == F.col("_k")).groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.max("total").alias("total"))
    return exact.where(F.col("rows") >= F.lit(min_share) * F.col("total")).withColumn("share", F.col("rows") / F.col("total"))


def join_skewed(left: DataFrame, right: DataFrame, key: str, how: str = "inner", min_share: float = 0.005) -> DataFrame:
    """Join a large, skewed left side to a right side with one row per key.

    Rows of heavy keys meet a broadcast of the right rows of those keys, at most
    ``2 / min_share`` rows since the right side is unique on ``key``; the rest is
    an ordinary shuffle join.  ``how`` is inner or left.  Null keys match nothing
    (left: kept with nulls).  Columns of the right side other than ``key`` must
    not clash with the left's; the caller renames.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    cand = heavy_candidates(left, key, min_share).select(key)
    small = F.broadcast(cand)
    heavy = left.join(small, key, "left_semi").join(F.broadcast(right.join(small, key, "left_semi")), key, how)
    light = left.join(small, key, "left_anti").join(right, key, how)
    return heavy.unionByName(light)


def aggregate_skewed(df: DataFrame, key: str, aggs: dict, merge: dict, salt_of: str, salts: int = 64) -> DataFrame:
    """Two-phase aggregate for functions that keep large state per key.

    Rows are first aggregated by (key, hash of ``salt_of``), then by key.
    ``aggs`` maps result names to row-level aggregates, ``merge`` the same names
    to functions over the partial columns.  The null key is a group of its own.
    """
    part = df.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts))).groupBy(key, "_salt").agg(*[a.alias(n) for n, a in aggs.items()])
    return part.groupBy(key).agg(*[merge[n](n).alias(n) for n in aggs])
