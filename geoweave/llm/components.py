"""Consolidating pairwise matches into groups: deterministic Boruvka hooking.

Every component selects its smallest outgoing edge, the trees so formed collapse
by pointer doubling, edges are relabelled and deduplicated, until none remain.
Labels of the rounds are composed from the last to the first, so each round's
map is joined once; vertex counts at least halve per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.operators.heavy import join_skewed
from geoweave.runtime import Scratch

#: Below this many rows no key can hold more than one task sorts quickly.
PLAIN = 5_000_000


def _join(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """Inner join to a side unique on ``key``; hot keys are split off in large inputs."""
    return left.join(right, key) if rows <= PLAIN else join_skewed(left, right, key)


def unique_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """As ``_join``, counting the left side itself."""
    return _join(left, right, key, left.count())


def star_edges(members: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that join all vertices sharing a key to the key's smallest vertex.

    ``members`` has (vid, key).  Linear in the rows: never all pairs of a group.
    """
    m = scratch.save(members.select("vid", "key").where("key is not null").distinct(), "members")
    low = m.groupBy("key").agg(F.min("vid").alias("low"), F.max("vid").alias("_high")).where(F.col("low") < F.col("_high")).select("key", "low")
    return _join(m, low, "key", m.count()).where(F.col("vid") != F.col("low")).select(F.col("low").alias("a"), F.col("vid").alias("b"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(vid, label) of every vertex with an edge; label is the component's smallest vertex.

    ``edges`` has long columns a and b in any order, repeats and loops allowed;
    nulls are no edge.  An empty table gives no rows.
    """
    tidy = lambda e: e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a") < F.col("b")).distinct()
    cur = scratch.save(tidy(edges.where("a is not null and b is not null")), "edges")
    maps: list[DataFrame] = []
    while rows := cur.count():
        both = cur.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("x")), F.struct(F.col("b").alias("u"), F.col("a").alias("x")))))
        up = scratch.save(both.groupBy("u").agg(F.min("x").alias("p")), "hook")
        while True:
            over = up.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            # A pair that chose each other is a tree's root: its smaller end.
            new = F.when(F.col("pp") == F.col("u"), F.least("u", "p")).otherwise(F.col("pp"))
            nxt = scratch.save(_join(up, over, "p", 2 * rows).select("u", new.alias("p"), (new != F.col("p")).alias("moved")), "double")
            scratch.drop(up)
            up = nxt.select("u", "p")
            up._scratch_path = nxt._scratch_path
            if nxt.where("moved").isEmpty():
                break
        maps.append(up)
        ra = up.select(F.col("u").alias("a"), F.col("p").alias("ra"))
        rb = up.select(F.col("u").alias("b"), F.col("p").alias("rb"))
        one = _join(cur, ra, "a", rows).select("ra", "b")
        two = _join(one, rb, "b", rows).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        nxt = scratch.save(tidy(two), "edges")
        scratch.drop(cur)
        cur = nxt
    if not maps:
        return cur.select(F.col("a").alias("vid"), F.col("b").alias("label"))
    label = maps[-1].select("u", F.col("p").alias("label"))
    for m in reversed(maps[:-1]):
        later = label.select(F.col("u").alias("p"), "label")
        label = m.join(later, "p", "left").select("u", F.coalesce("label", "p").alias("label"))
    return label.select(F.col("u").alias("vid"), "label")
