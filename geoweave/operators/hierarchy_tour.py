"""Parent-child links to full hierarchies: peeling, Euler tours, list ranking.

1. Leaf peeling by doubling: after k rounds of ``jump(v) = jump(jump(v))`` the
   image of the jump is what 2**k rounds of peeling leaves would leave.  What
   never peels away are the cycles: the image once it no longer shrinks; nodes
   whose jump is always defined lead into one.
2. The remaining forest gets an Euler tour: a down and an up arc per edge, each
   arc linked to the next.  Siblings are linked in key order; siblings of a
   parent with very many children are linked block by block.
3. Parallel list ranking by pointer doubling gives each arc its place, the sum
   of the arcs' signs (the depth) and the list's end (the root).
4. Entry and exit places nest: a scan over range-partitioned arcs with a stack,
   seeded per partition with the nodes open at its start, yields full paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweave.runtime import Scratch

_BLOCK = 20_000


def _clean(edges: DataFrame) -> DataFrame:
    """One parent per node: null ends are no link; of several parents the smallest counts."""
    return edges.where(F.col("node").isNotNull() & F.col("parent").isNotNull()).groupBy("line", "node").agg(F.min("parent").alias("parent"))


class Hierarchy:
    """Edges (line, node, parent) turned into ranked Euler tours.

    ``edges`` has one row per link; each node has one parent per line.  Parents
    need not be nodes.  An empty table gives empty results.  With ``tails``,
    nodes that lead into a cycle are ranked too, below the node of it they reach.
    """

    def __init__(self, edges: DataFrame, scratch: Scratch, tails: bool = False):
        self.scratch = scratch
        e = scratch.save(_clean(edges), "edges")
        keys = e.select("line", F.col("node").alias("key")).union(e.select("line", F.col("parent"))).distinct()
        self.names = scratch.save(keys.withColumn("vid", F.monotonically_increasing_id()), "names")
        ids = self.names
        e = e.join(ids.select("line", F.col("key").alias("node"), F.col("vid").alias("v")), ["line", "node"])
        e = e.join(ids.select("line", F.col("key").alias("parent"), F.col("vid").alias("p")), ["line", "parent"])
        self.edges = scratch.save(e.select("v", "p"), "links")
        self.endless, self.cycle = self._peel()
        self.forest = scratch.save(self.edges.join(self.cycle if tails else self.endless, "v", "left_anti"), "forest")
        self.arcs = self._rank(self._tour())

    def _peel(self) -> tuple[DataFrame, DataFrame]:
        """(v leading into or on a cycle, v on a cycle)."""
        image = lambda df: df.select("p").distinct().count()
        jump, left = self.edges, self.edges.count()
        while True:
            b = jump.select(F.col("v").alias("p"), F.col("p").alias("p2"))
            nxt = self.scratch.save(jump.join(b, "p").select("v", F.col("p2").alias("p")), "jump")
            now = nxt.count()
            if not now or now == left and image(nxt) == image(jump):
                return nxt.select("v"), nxt.select(F.col("p").alias("v")).distinct()
            if jump is not self.edges:
                self.scratch.drop(jump)
            jump, left = nxt, now

    def _tour(self) -> DataFrame:
        """Arcs (arc, nxt, w, root): arc = 2 v + (0 down, 1 up); nxt null at the end of a tour."""
        f = self.forest
        wide = f.groupBy("p").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > _BLOCK).select("p", F.ceil(F.col("c") / _BLOCK).alias("nb"))
        b = f.join(wide, "p", "left").withColumn("blk", F.when(F.col("nb").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("v"), F.col("nb"))).cast("long"))
        sib = b.select("v", "p", "blk", F.lead("v").over(Window.partitionBy("p", "blk").orderBy("v")).alias("sib"))
        sib = self.scratch.save(sib, "siblings")
        head = sib.groupBy("p", "blk").agg(F.min("v").alias("first"))
        by = Window.partitionBy("p").orderBy("blk")
        head = self.scratch.save(head.select("p", "blk", "first", F.lead("first").over(by).alias("over"), (F.row_number().over(by) == 1).alias("lead")), "heads")
        first = head.where("lead").select(F.col("p").alias("v"), F.col("first").alias("kid"))
        over = head.where(F.col("over").isNotNull()).select("p", "blk", "over")
        t = sib.join(over, ["p", "blk"], "left").withColumn("sib", F.coalesce("sib", "over"))
        t = t.join(first, "v", "left")
        nonroot = self.forest.select(F.col("v").alias("p"), F.lit(True).alias("mid"))
        t = t.join(nonroot, "p", "left")
        down = F.struct((F.col("v") * 2).alias("arc"), F.coalesce(F.col("kid") * 2, F.col("v") * 2 + 1).alias("nxt"), F.lit(1).cast("long").alias("w"), F.lit(None).cast("long").alias("root"))
        end = F.col("sib").isNull() & F.col("mid").isNull()
        up = F.struct(
            (F.col("v") * 2 + 1).alias("arc"),
            F.coalesce(F.col("sib") * 2, F.when(F.col("mid"), F.col("p") * 2 + 1)).alias("nxt"),
            F.lit(-1).cast("long").alias("w"), F.when(end, F.col("p")).alias("root"),
        )
        return t.select(F.inline(F.array(down, up))).withColumn("n", F.lit(1).cast("long"))

    def _rank(self, arcs: DataFrame) -> DataFrame:
        """Arcs with w (sum of signs to the end), n (arcs to the end) and root."""
        cur = self.scratch.save(arcs, "arcs")
        rounds = [cur]
        done, live = [cur.where(F.col("nxt").isNull())], cur.where(F.col("nxt").isNotNull())
        while not live.isEmpty():
            target = live
            for d in done:
                target = target.unionByName(d)
            t = target.select(F.col("arc").alias("nxt"), F.col("nxt").alias("n2"), F.col("w").alias("w2"), F.col("root").alias("r2"), F.col("n").alias("c2"))
            nxt = live.select("arc", "nxt", "w", "n").join(t, "nxt").select("arc", F.col("n2").alias("nxt"), (F.col("w") + F.col("w2")).alias("w"), F.col("r2").alias("root"), (F.col("n") + F.col("c2")).alias("n"))
            cur = self.scratch.save(nxt, "rank")
            rounds.append(cur)
            done.append(cur.where(F.col("nxt").isNull()))
            live = cur.where(F.col("nxt").isNotNull())
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        ranked = self.scratch.save(out.select("arc", "w", "n", "root"), "ranked")
        self.scratch.drop(*rounds)
        return ranked

    def _down(self) -> DataFrame:
        return self.arcs.where(F.col("arc") % 2 == 0).select(F.expr("arc div 2").alias("v"), (1 - F.col("w")).alias("depth"), "root", F.col("n").alias("enter"))

    def _named(self, df: DataFrame, vid: str, out: str, line: bool = False) -> DataFrame:
        n = self.names.select(F.col("vid").alias(vid), F.col("key").alias(out), *(["line"] if line else []))
        return df.join(n, vid)

    def depths(self) -> DataFrame:
        """(line, node_id, root_id, depth) of every node that has a parent; ('', -1) where the way up never ends."""
        ok = self._named(self._named(self._down().select("v", "root", "depth"), "v", "node_id", line=True), "root", "root_id")
        bad = self._named(self.endless, "v", "node_id", line=True).withColumn("root_id", F.lit("")).withColumn("depth", F.lit(-1).cast("long"))
        cols = ["line", "node_id", "root_id", F.col("depth").cast("int").alias("depth")]
        return ok.select(*cols).unionByName(bad.select(*cols))

    def full(self, partitions: int | None = None) -> DataFrame:
        """(line, node_id, root_id, depth, path, descendants, in_cycle) of every node, roots included.

        ``path`` is the array of ids from the root to the node.  Nodes that lead
        into a cycle have root '', depth -1, no path and no count; ``in_cycle``
        tells those on it.
        """
        nodes, roots = self._trees(partitions)
        tops = roots.select("line", F.col("root_id").alias("node_id"), "root_id", F.lit(0).alias("depth"), F.array("root_id").alias("path"), "descendants")
        bad = self._named(self.endless.join(self.cycle.withColumn("c", F.lit(True)), "v", "left"), "v", "node_id", line=True)
        none = bad.select("line", "node_id", F.lit("").alias("root_id"), F.lit(-1).alias("depth"), F.lit(None).cast("array<string>").alias("path"), F.lit(None).cast("long").alias("descendants"), F.coalesce("c", F.lit(False)).alias("in_cycle"))
        return nodes.unionByName(tops).withColumn("in_cycle", F.lit(False)).unionByName(none)

    def descendants(self, partitions: int | None = None) -> DataFrame:
        """(line, ancestor_id, descendant_id), one row per pair; needs ``tails``.

        What the stack scan holds open at a node are its ancestors.  All nodes of
        a cycle are above each other, themselves and everything that leads in.
        """
        nodes, _ = self._trees(partitions)
        pairs = nodes.select("line", F.explode(F.slice("path", 1, F.size("path") - 1)).alias("ancestor_id"), F.col("node_id").alias("descendant_id"))
        ring = self._rings()
        inside = ring.select("v", F.lit(None).cast("long").alias("root"), "ring")
        below = self._down().select("v", "root").join(ring.withColumnRenamed("v", "root"), "root").select("v", "root", "ring").unionByName(inside)
        # The node a tail hangs on stands in its path already.
        over = below.join(ring.select(F.col("v").alias("a"), "ring"), "ring").where(F.col("root").isNull() | (F.col("a") != F.col("root")))
        over = self._named(self._named(over.select("a", "v"), "v", "descendant_id", line=True), "a", "ancestor_id")
        return pairs.unionByName(over.select(*pairs.columns))

    def _rings(self) -> DataFrame:
        """(v, ring) of the nodes on cycles; ring is the least v of the cycle, by doubling."""
        cur = self.scratch.save(self.edges.join(self.cycle, "v", "left_semi").select("v", "p", F.least("v", "p").alias("ring")), "ring")
        while True:
            b = cur.select(F.col("v").alias("p"), F.col("p").alias("p2"), F.col("ring").alias("r2"))
            nxt = cur.join(b, "p").select("v", F.col("p2").alias("p"), F.least("ring", "r2").alias("ring"), (F.col("r2") < F.col("ring")).alias("moved"))
            nxt = self.scratch.save(nxt, "ring")
            self.scratch.drop(cur)
            if nxt.where("moved").isEmpty():
                return nxt.select("v", "ring")
            cur = nxt.drop("moved")
            cur._scratch_path = nxt._scratch_path

    def _trees(self, partitions: int | None) -> tuple[DataFrame, DataFrame]:
        """Ranked nodes with their paths, and the roots (line, root, root_id, descendants)."""
        spark = self.scratch.spark
        ends = self.arcs.where(F.col("arc") % 2 == 1).select(F.expr("arc div 2").alias("v"), F.col("n").alias("leave"))
        span = self.scratch.save(self._named(self._down().join(ends, "v"), "v", "id", line=True), "spans")
        parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        order = [F.col("root"), F.col("enter").desc()]
        cut = self.scratch.save(span.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "cut")
        # At most one boundary per partition: the first entry of each.
        at = cut.groupBy("part").agg(F.min(F.struct("root", (-F.col("enter")).alias("m"))).alias("b")).select("part", F.col("b.root").alias("root"), (-F.col("b.m")).alias("cutoff"))
        # Open beyond its partition is what leaves after the next one begins; only that meets the other boundaries.
        following = at.select((F.lag("part").over(Window.orderBy("part"))).alias("part"), "root", "cutoff")
        crossing = cut.join(F.broadcast(following), ["part", "root"]).where(F.col("leave") < F.col("cutoff")).drop("part", "cutoff")
        opened = crossing.join(F.broadcast(at), "root").where((F.col("enter") > F.col("cutoff")) & (F.col("leave") < F.col("cutoff")))
        cols = ["part", "line", "v", "id", "root", "depth", "enter", "leave"]
        # The root itself lies open at the bottom of every partition that holds rows of its tree.
        tops = self._named(cut.select("part", "root").distinct(), "root", "id", line=True)
        last = F.lit(2**62).cast("long")
        tops = tops.select("part", "line", F.col("root").alias("v"), "id", "root", F.lit(0).cast("long").alias("depth"), last.alias("enter"), F.lit(-1).cast("long").alias("leave"))
        both = cut.select(*cols, F.lit(False).alias("seed")).unionByName(opened.select(*cols, F.lit(True).alias("seed"))).unionByName(tops.withColumn("seed", F.lit(True)))
        roots = self._named(span.groupBy("root").agg(F.count(F.lit(1)).alias("descendants")), "root", "root_id", line=True)
        lined = both.repartition(parts, "part").sortWithinPartitions("part", "root", F.col("enter").desc())
        nodes = lined.mapInPandas(_paths, "line string, node_id string, root_id string, depth int, path array<string>, descendants long")
        return nodes, roots


def _paths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stack scan: rows come by partition, root and entry; seeds are the nodes open at its start."""
    part = root = None
    stack: list[tuple[int, str]] = []
    for df in frames:
        out = []
        for r in df.itertuples(index=False):
            if r.part != part or r.root != root:
                part, root, stack = r.part, r.root, []
            while stack and stack[-1][0] > r.enter:
                stack.pop()
            stack.append((r.leave, r.id))
            if not r.seed:
                path = [i for _, i in stack]
                out.append((r.line, r.id, path[0], r.depth, path, (r.enter - r.leave - 1) // 2))
        yield pd.DataFrame(out, columns=["line", "node_id", "root_id", "depth", "path", "descendants"])
