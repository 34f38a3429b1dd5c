"""Dual-tree spatial joins: points near points, points inside regions.

The tree is a quadtree over latitude and longitude whose nodes carry the tight
bounds of their points.  It exists only as a table of nodes, so a traversal step
is an equi-join of node pairs with the children of both nodes: pairs that cannot
hold a result are discarded, pairs that certainly do are accepted wholesale and
never tested again, the rest is refined down to leaf pairs.  Leaves split on
their own count, so dense spots get small leaves; a leaf at the deepest level
that is still large (many points on one spot) is cut into blocks of bounded
size, so that no group meets itself in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.functions import geo
from geoweave.runtime import Scratch

#: Quadtree levels that get nodes; one step opens 16 (the first: 256) children.
LEVELS = (0, 4, 6, 8, 10, 12, 14, 16, 18, 20)
_DEEP = LEVELS[-1]
#: Key of the root.
_ROOT = 0


def _key(level: int | Column, iy: Column, ix: Column) -> Column:
    lv = F.lit(level).cast("long") if isinstance(level, int) else level.cast("long")
    return F.shiftleft(lv, 42) + F.shiftleft(iy, 21) + ix


def _box(prefix: str) -> dict:
    return {k: F.col(f"{prefix}{k}") for k in "snwe"}


#: Levels counted together; only points under nodes still too full go on to the next group.
_GROUPS = ((0, 4, 6, 8, 10), (12, 14, 16), (18, 20))


def _up(level: Column) -> tuple[Column, Column]:
    """Cell of a point at a level."""
    return F.expr(f"shiftright(iy, {_DEEP} - level)"), F.expr(f"shiftright(ix, {_DEEP} - level)")


class PointTree:
    """The node table and the blocked leaves of a set of (id, lat, lon) points.

    Points without a valid position are in no leaf.  Repeated ids stay as they
    are; the caller passes one row per id.  One tree serves several joins.
    """

    def __init__(self, points: DataFrame, scratch: Scratch, leaf_cap: int = 64):
        self.scratch, self.leaf_cap, self.block = scratch, leaf_cap, 4 * leaf_cap
        side = 1 << _DEEP
        cell = lambda v, span: F.least(F.lit(side - 1), F.floor((v + span / 2) / span * side)).cast("long")
        pts = points.select("id", "lat", "lon").where(geo.valid_position(F.col("lat"), F.col("lon")))
        self.points = scratch.save(pts.withColumn("iy", cell(F.col("lat"), 180.0)).withColumn("ix", cell(F.col("lon"), 360.0)), "points")
        above = F.create_map(*[F.lit(x) for pair in zip(LEVELS[1:], LEVELS) for x in pair])
        self.levels: list[int] = []
        self.nodes: DataFrame | None = None
        rest, wide, counts = self.points.select("iy", "ix", "lat", "lon"), None, []
        for group in _GROUPS:
            at = rest.withColumn("level", F.explode(F.array(*[F.lit(v) for v in group])))
            y, x = _up(F.col("level"))
            full = at.groupBy("level", y.alias("iy"), x.alias("ix")).agg(
                F.count(F.lit(1)).alias("cnt"), F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lon").alias("w"), F.max("lon").alias("e")
            )
            step = F.col("level") - F.coalesce(F.try_element_at(above, F.col("level")), F.lit(0))
            full = full.withColumn("_st", step).select(
                "level", _key(F.col("level"), F.col("iy"), F.col("ix")).alias("node"),
                F.when(F.col("level") == 0, F.lit(-1)).otherwise(_key(F.col("level") - F.col("_st"), F.expr("shiftright(iy, _st)"), F.expr("shiftright(ix, _st)"))).alias("parent"),
                "cnt", "s", "n", "w", "e",
            )
            full = scratch.save(full, "levels")
            counts.append(full)
            # A node is in the tree if its parent is too full to be a leaf.
            here = full.where(F.col("cnt") > leaf_cap).select(F.col("node").alias("parent"), "level")
            open_ = here.select("parent") if wide is None else here.select("parent").unionByName(wide)
            inside = full.where("level > 0").join(open_, "parent", "left_semi").unionByName(full.where("level = 0"), allowMissingColumns=True)
            nodes = scratch.save(inside.select(
                "node", "parent", "level", ((F.col("cnt") <= leaf_cap) | (F.col("level") == _DEEP)).alias("leaf"), F.ceil(F.col("cnt") / self.block).cast("int").alias("blocks"), "s", "n", "w", "e"
            ), "nodes")
            self.nodes = nodes if self.nodes is None else self.nodes.unionByName(nodes)
            self.levels += group
            wide = here.where(F.col("level") == group[-1]).select("parent")
            if group[-1] == _DEEP or wide.isEmpty():
                break
            y, x = (F.expr(f"shiftright({c}, {_DEEP - group[-1]})") for c in ("iy", "ix"))
            rest = rest.withColumn("parent", _key(group[-1], y, x)).join(wide, "parent", "left_semi").drop("parent")
        scratch.drop(*counts)
        self._packed: DataFrame | None = None

    def step(self, level: int) -> DataFrame:
        """What stands for a node after the step to ``level``: its children, or itself if a leaf above."""
        here = self.nodes.where(F.col("level") == level)
        kept = self.nodes.where((F.col("level") < level) & F.col("leaf")).withColumn("parent", F.col("node"))
        return here.unionByName(kept).drop("level")

    def first_cells(self) -> DataFrame:
        """The nodes of the first step, and the root if it is a leaf, each standing for itself."""
        here = self.nodes.where((F.col("level") == LEVELS[1]) | ((F.col("level") == 0) & F.col("leaf")))
        return here.withColumn("parent", F.col("node")).drop("level")

    def packed(self) -> DataFrame:
        """Leaf blocks: (node, block, pts), each array at most about ``block`` points long; written once."""
        if self._packed is None:
            leaf = self.nodes.where("leaf").select("node", "blocks", "level")
            # At most one value per level of the tree.
            used = sorted(r.level for r in leaf.select("level").distinct().collect())
            at = self.points.withColumn("level", F.explode(F.array(*[F.lit(v) for v in used]).cast("array<int>")))
            y, x = _up(F.col("level"))
            home = at.select("id", "lat", "lon", _key(F.col("level"), y, x).alias("node")).join(leaf.drop("level"), "node")
            block = F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")
            self._packed = self.scratch.save(home.groupBy("node", block.alias("block")).agg(F.collect_list(F.struct("id", "lat", "lon")).alias("pts")), "leaves")
        return self._packed

    @property
    def root(self) -> DataFrame:
        return self.nodes.where(F.col("level") == 0)


def _renamed(df: DataFrame, p: str) -> DataFrame:
    return df.select(F.col("parent").alias(f"{p}parent"), *[F.col(c).alias(f"{p}{c}") for c in ("node", "leaf", "blocks", "s", "n", "w", "e")])


def near_pairs(points: DataFrame | PointTree, km: float, scratch: Scratch, leaf_cap: int = 64) -> DataFrame:
    """All unordered pairs of different ids at most ``km`` apart: (left_id, right_id), smaller first.

    ``points`` has id, lat, lon, or is a tree of them.  Rows without a valid position have no pair; an
    empty table gives none.  Points on one spot pair with each other (distance
    0).  The number of rows is that of the true pairs, nothing is capped.
    """
    tree = points if isinstance(points, PointTree) else PointTree(points, scratch, leaf_cap)
    limit = geo.hav_of_km(km)
    live = tree.root.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(False).alias("sure"))
    finished: list[DataFrame] = []
    for level in tree.levels[1:]:
        side = tree.step(level)
        pair = live.select("a", "b", "sure").join(_renamed(side, "l"), F.col("a") == F.col("lparent")).join(_renamed(side, "r"), F.col("b") == F.col("rparent"))
        pair = pair.where((F.col("a") != F.col("b")) | (F.col("lnode") <= F.col("rnode")))
        pair = pair.where(F.col("sure") | (geo.min_hav(_box("l"), _box("r")) <= limit * (1 + 1e-9)))
        nxt = pair.select(
            F.col("lnode").alias("a"), F.col("rnode").alias("b"),
            (F.col("sure") | (geo.max_hav(_box("l"), _box("r")) <= limit * (1 - 1e-9))).alias("sure"),
            (F.col("lleaf") & F.col("rleaf")).alias("done"), F.col("lblocks").alias("ab"), F.col("rblocks").alias("bb"),
        )
        nxt = scratch.save(nxt, f"pairs{level}")
        finished.append(nxt.where("done"))
        live = nxt.where(~F.col("done"))
        if level >= 8 and live.isEmpty():
            break
    leaves = finished[0]
    for f in finished[1:]:
        leaves = leaves.unionByName(f)
    count = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    blocks = leaves.withColumn("i", count("ab")).withColumn("j", count("bb")).where((F.col("a") != F.col("b")) | (F.col("i") <= F.col("j")))
    packed = tree.packed()
    pa = packed.select(F.col("node").alias("a"), F.col("block").alias("i"), F.col("pts").alias("pa"))
    pb = packed.select(F.col("node").alias("b"), F.col("block").alias("j"), F.col("pts").alias("pb"))
    met = blocks.join(pa, ["a", "i"]).join(pb, ["b", "j"])
    same = (F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))
    rows = met.select("sure", same.alias("same"), F.inline("pa").alias("aid", "alat", "alon"), "pb").select("sure", "same", "aid", "alat", "alon", F.inline("pb").alias("bid", "blat", "blon"))
    dlat = F.degrees(F.lit(km / geo.EARTH_KM)) * (1 + 1e-9)
    close = (F.abs(F.col("alat") - F.col("blat")) <= dlat) & (geo.haversine_km(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon")) <= km)
    return rows.where(F.when(F.col("same"), F.col("aid") < F.col("bid")).otherwise(F.col("aid") != F.col("bid")) & (F.col("sure") | close)).select(
        F.least("aid", "bid").alias("left_id"), F.greatest("aid", "bid").alias("right_id")
    )


def points_in_regions(points: DataFrame | PointTree, regions: DataFrame, scratch: Scratch, leaf_cap: int = 64) -> DataFrame:
    """Every region with every point inside it, in the plane: (region_id, point_id).

    ``regions`` has region_id and edges (see ``geo.polygon_edges``).  Overlapping
    regions each give their rows; a region without edges holds nothing.
    """
    tree = points if isinstance(points, PointTree) else PointTree(points, scratch, leaf_cap)
    ex = lambda f, *cs: f(F.flatten(F.transform("edges", lambda e: F.array(*[e[c] for c in cs]))))
    reg = regions.where(F.size("edges") > 0).select(
        "region_id", "edges", ex(F.array_min, "y1", "y2").alias("zs"), ex(F.array_max, "y1", "y2").alias("zn"), ex(F.array_min, "x1", "x2").alias("zw"), ex(F.array_max, "x1", "x2").alias("ze")
    )
    # A node needs the edges that a ray to the east from any of its points can meet; every
    # step narrows them, so a region's outline is split over its nodes and no step joins on the region.
    top = LEVELS[1]
    side = 1 << top
    span = lambda lo, hi, width: F.sequence(*[F.greatest(F.lit(0), F.least(F.lit(side - 1), F.floor((F.col(c) + width / 2) / width * side))).cast("long") for c in (lo, hi)])
    bounds = ["zs", "zn", "zw", "ze"]
    cells = reg.withColumn("iy", F.explode(span("zs", "zn", 180.0)))
    cells = cells.withColumn("edges", _east_of(F.col("edges"), F.col("iy") * (180.0 / side) - 90, (F.col("iy") + 1) * (180.0 / side) - 90, F.lit(-180.0)))
    cells = cells.withColumn("ix", F.explode(span("zw", "ze", 360.0))).select("region_id", "edges", *bounds, _key(top, F.col("iy"), F.col("ix")).alias("a"))
    whole = reg.select("region_id", "edges", *bounds, F.lit(_ROOT).alias("a"))
    # The root stands for all points: one step down, a region meets only the cells its bounds touch.
    live = scratch.save(cells.unionByName(whole).withColumn("sure", F.lit(False)), "regions")
    finished: list[DataFrame] = []
    for level in tree.levels[1:]:
        kids = _renamed(tree.first_cells() if level == top else tree.step(level), "l")
        box = _box("l")
        overlap = (box["s"] <= F.col("zn")) & (box["n"] >= F.col("zs")) & (box["w"] <= F.col("ze")) & (box["e"] >= F.col("zw"))
        met = live.join(kids, F.col("a") == F.col("lparent")).where(F.col("sure") | overlap)
        met = met.withColumn("edges", F.when(~F.col("sure"), _east_of(F.col("edges"), box["s"], box["n"], box["w"])))
        met = met.withColumn("edge", ~F.col("sure") & geo.box_touches_edges(box, F.col("edges")))
        met = met.withColumn("in", F.col("sure") | (~F.col("edge") & geo.point_in_edges(box["w"], box["s"], F.col("edges"))))
        nxt = met.where(F.col("edge") | F.col("in")).select(
            "region_id", F.col("lnode").alias("a"), F.col("in").alias("sure"), F.col("lleaf").alias("leaf"), F.col("lblocks").alias("blocks"), F.when(F.col("edge"), F.col("edges")).alias("edges"), *bounds
        )
        nxt = scratch.save(nxt, f"zones{level}")
        finished.append(nxt.where("leaf").select("region_id", "a", "sure", "blocks", "edges"))
        live = nxt.where(~F.col("leaf")).drop("leaf", "blocks")
        if level >= 8 and live.isEmpty():
            break
    leaves = finished[0]
    for f in finished[1:]:
        leaves = leaves.unionByName(f)
    packed = tree.packed().select(F.col("node").alias("a"), F.col("block").alias("i"), "pts")
    met = leaves.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(packed, ["a", "i"])
    kept = F.when(F.col("sure"), F.col("pts")).otherwise(F.filter("pts", lambda p: geo.point_in_edges(p["lon"], p["lat"], F.col("edges"))))
    return met.select("region_id", F.explode(F.transform(kept, lambda p: p["id"])).alias("point_id"))


def _east_of(edges: Column, s: Column, n: Column, w: Column) -> Column:
    """The edges that reach between two latitudes and not wholly west of a longitude; a hair more, for rounding."""
    slack = 1e-6
    return F.filter(edges, lambda e: (F.greatest(e["y1"], e["y2"]) >= s - slack) & (F.least(e["y1"], e["y2"]) <= n + slack) & (F.greatest(e["x1"], e["x2"]) >= w - slack))
