"""Pairs of strings within a few edits, without comparing all pairs.

A string within k edits of another keeps at least one of k + 1 pieces of it
unchanged: the first one whose errors up to it are fewer than the pieces, with
exactly i errors before piece i and at most k - i behind it.  So the piece moves
by at most that much, counted from either end.  Pieces of one side are matched
by an equi-join with the substrings of the other that they could be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _piece(n: Column, i: int, parts: int) -> tuple[Column, Column]:
    """(start from 0, length) of piece i of a string of n letters; later pieces take the rest."""
    base, extra = F.floor(n / parts), n % parts
    more = F.greatest(F.lit(0), F.lit(i) - (parts - extra))
    size = base + F.when(F.lit(i) >= parts - extra, 1).otherwise(0)
    return (base * i + more).cast("int"), size.cast("int")


def _letters(x: Column) -> Column:
    """Two bits for each of 32 sorts of letters: one of them, two or more. An edit changes at most two bits."""
    two = lambda c: F.when(c == "", F.lit(0)).otherwise(F.pmod(F.ascii(c), F.lit(32)) * 2)
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), two(c))
    add = lambda m, c: m.bitwiseOR(F.when(m.bitwiseAND(bit(c)) == 0, bit(c)).otherwise(F.shiftleft(bit(c), 1)))
    return F.aggregate(F.filter(F.split(x, ""), lambda c: c != ""), F.lit(0).cast("bigint"), add)


def _spread(df: DataFrame, c: str) -> DataFrame:
    """Distinct strings in as many parts as a shuffle has: each becomes many rows, which sizes before do not show.

    Parted by a hash of the string: by the string itself, the planner takes the parts of the distinct step and merges them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(c).where(F.col(c).isNotNull()).distinct().repartition(parts, F.xxhash64(c))


def within_edits(left: DataFrame, right: DataFrame, k: int = 2) -> DataFrame:
    """(a, b, distance) of the distinct strings of ``left.a`` and ``right.b`` at most k edits apart.

    Exact for every length, also empty strings; nulls match nothing.  Keys are
    hashes and letters are compared first: both only name candidates.  The join
    is hinted: sizes known before the pieces are cut are far too low, so the
    planner would broadcast a side that the driver cannot hold.
    """
    parts = k + 1
    b = _spread(right, "b").select("b", _letters(F.col("b")).alias("b_letters"), F.length("b").alias("n"))
    keys = []
    for i in range(parts):
        start, size = _piece(F.col("n"), i, parts)
        keys.append(_key(F.col("n"), i, F.substr(F.col("b"), start + 1, size)))
    index = b.select("b", "b_letters", F.explode(F.array(*keys)).alias("key"))
    a = _spread(left, "a").select("a", _letters(F.col("a")).alias("a_letters"), F.length("a").alias("len"))
    probes = [_probes(F.col("len") - more, more, i, k) for more in range(-k, k + 1) for i in range(parts)]
    probe = a.select("a", "a_letters", F.explode(F.array_distinct(F.concat(*probes))).alias("key"))
    alike = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2 * k
    met = probe.hint("merge").join(index.hint("merge"), "key").where(alike).select("a", "b")
    return met.withColumn("distance", F.levenshtein("a", "b", k)).where("distance between 0 and " + str(k)).distinct()


def _key(n: Column, i: int, piece: Column) -> Column:
    return F.xxhash64(n.cast("int"), F.lit(i), piece)


def _probes(n: Column, more: int, i: int, k: int) -> Column:
    """Keys of the substrings of ``a``, ``more`` letters longer than n, that piece i of a string of n letters could be."""
    start, size = _piece(n, i, k + 1)
    first = F.greatest(F.lit(0), start + max(-i, more - (k - i)))
    last = F.least(F.col("len") - size, start + min(i, more + (k - i)))
    at = F.when((n >= 0) & (first <= last), F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda p: _key(n, i, F.substr(F.col("a"), p + 1, size)))
