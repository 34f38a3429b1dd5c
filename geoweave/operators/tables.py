"""Upserts and merges of whole tables: one full outer join per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last by ``order``; null keys form one key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def upsert(old: DataFrame, new: DataFrame, key: str, order: list[Column] | None = None, on_create: tuple[str, ...] = (), only_if_exists: bool = False) -> DataFrame:
    """``old`` with ``new`` merged in by key.

    Columns that ``new`` lacks, and nulls in it, leave the old value; columns in
    ``on_create`` are set only on rows that are new; ``only_if_exists`` adds no
    rows.  Several new rows of a key: the last by ``order`` counts.  Running it
    twice gives the same table.
    """
    n = last_per_key(new, [key], order) if order else new.dropDuplicates([key])
    n = n.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_n_{c}") for c in n.columns if c != key])
    j = old.join(n, F.col(key) == F.col("_k"), "left" if only_if_exists else "full")
    cols = [F.coalesce(key, "_k").alias(key)]
    for c in dict.fromkeys([*old.columns, *[x[3:] for x in n.columns if x.startswith("_n_")]]):
        if c == key:
            continue
        had, has = c in old.columns, f"_n_{c}" in n.columns
        if not has:
            cols.append(F.col(c))
        elif not had:
            cols.append(F.col(f"_n_{c}").alias(c))
        elif c in on_create:
            cols.append(F.when(F.col(key).isNull(), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.coalesce(f"_n_{c}", c).alias(c))
    return j.select(*cols)


def upsert_edges(old: DataFrame, new: DataFrame, order: list[Column]) -> DataFrame:
    """Edges unique on (src, dst); the last by ``order`` wins, new over old on ties."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return last_per_key(both, ["src", "dst"], [*order, F.col("_new")]).drop("_new")


def add_if_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key tuple; null equals null."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def unordered_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct unordered pairs of different, non-null ends, smaller first."""
    return df.select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).where(F.col(a) < F.col(b)).distinct()
