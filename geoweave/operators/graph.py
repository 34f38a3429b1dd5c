"""Edges of the administrative hierarchy and walks along them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.runtime import Scratch

#: Admin columns, coarsest first; a division of level n is keyed by country and the first n.
ADMIN = ["admin1Code", "admin2Code", "admin3Code", "admin4Code"]
#: Into so many parts the places of one division go when they meet it.
SLICES = 8


def divisions(places: DataFrame) -> DataFrame:
    """Rows of code ADM1..4 with a full key: (geonameId, level, countryCode, admin1..4Code)."""
    level = F.regexp_extract("featureCode", r"^ADM([1-4])$", 1).try_cast("int")
    d = places.withColumn("level", level).where("level is not null and countryCode is not null")
    full = reduce(lambda a, b: a & b, [F.when(F.col("level") > i, F.col(c).isNotNull()).otherwise(True) for i, c in enumerate(ADMIN)])
    return d.where(full)


def code_divisions(places: DataFrame) -> DataFrame:
    """Divisions as the places' own codes name them: (code, parent, level, countryCode), one row each.

    ``code`` is the composite key joined by dots; level 1 hangs on the country.
    """
    ok = F.col("countryCode").isNotNull()
    rows, code = [], F.col("countryCode")
    for i, c in enumerate(ADMIN):
        ok, parent = ok & F.col(c).isNotNull(), code
        code = F.concat_ws(".", code, F.col(c))
        rows.append(F.when(ok, F.struct(code.alias("code"), parent.alias("parent"), F.lit(i + 1).alias("level"), F.col("countryCode").alias("countryCode"))))
    return places.select(F.explode(F.array_compact(F.array(*rows))).alias("d")).select("d.*").distinct()


def located(places: DataFrame, levels: tuple[int, ...] = (1, 2, 3, 4)) -> DataFrame:
    """(level, src, dst), distinct: every place that is no division in its divisions of these levels.

    Missing codes match nothing.  Where two divisions share a key, each gets an
    edge, so there are many more edges than places: they are never shuffled.
    Rows of one id are gathered before the join instead; where both ids have
    several keys, the least that they share gives the edge.  Divisions are few
    beside places: each is copied to every slice of a country's places.
    """
    d = divisions(places).where(F.col("level").isin(*levels))
    key = F.filter(F.array("countryCode", *ADMIN), lambda x, i: i <= F.col("level"))
    d = _keys(d.select(F.col("geonameId").alias("dst"), F.array(F.struct("level", key.alias("key"))).alias("keys")), "dst")
    d = d.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    ok = lambda n: F.forall(F.array("countryCode", *ADMIN[:n]), lambda x: x.isNotNull())
    at = [F.when(ok(n), F.struct(F.lit(n).alias("level"), F.array("countryCode", *ADMIN[:n]).alias("key"))) for n in levels]
    p = places.where(F.coalesce(F.col("featureClass") != "A", F.lit(False)))
    p = _keys(p.select(F.col("geonameId").alias("src"), F.array_compact(F.array(*at)).alias("keys")), "src").withColumn("slice", F.pmod(F.xxhash64("src"), F.lit(SLICES)).cast("int"))
    once = F.col("src_keys").isNull() | F.col("dst_keys").isNull() | (F.col("key") == F.array_min(F.array_intersect("src_keys", "dst_keys")))
    return p.join(d, ["level", "key", "slice"]).where(once).select("level", "src", "dst")


def _keys(df: DataFrame, c: str) -> DataFrame:
    """(c, level, key), distinct, from (c, keys); ``{c}_keys`` has all keys of that level where there are several."""
    every = F.array_distinct(F.flatten(F.collect_set("keys")))
    df = df.groupBy(c).agg(every.alias("keys")).select(c, "keys", F.inline("keys"))
    same = F.transform(F.filter("keys", lambda x: x["level"] == F.col("level")), lambda x: x["key"])
    return df.select(c, "level", "key", F.when(F.size(same) > 1, same).alias(f"{c}_keys"))


def located_in(places: DataFrame, level: int) -> DataFrame:
    """(src, dst) from every place that is no division to its divisions of that level."""
    return located(places, (level,)).select("src", "dst")


def part_of(places: DataFrame) -> DataFrame:
    """(src, src_level, dst, dst_country): each division to the one above; level 1 to its country."""
    d = divisions(places)
    out = d.where("level = 1").select(F.col("geonameId").alias("src"), "level", F.lit(None).cast("long").alias("dst"), F.col("countryCode").alias("dst_country"))
    for n in (2, 3, 4):
        keys = ["countryCode", *ADMIN[: n - 1]]
        up = d.where(F.col("level") == n - 1).select(*keys, F.col("geonameId").alias("dst"))
        down = d.where(F.col("level") == n).select(*keys, F.col("geonameId").alias("src"), "level")
        out = out.unionByName(down.join(up, keys).select("src", "level", "dst", F.lit(None).cast("string").alias("dst_country")).distinct())
    return out


def located_by_country_and_code(places: DataFrame, code: str = "admin2Code") -> DataFrame:
    """(src, dst) from every place that is no division to the level-2 divisions of its country and code alone.

    The looser key of loads whose divisions lack the level above; several may fit.
    """
    d = places.where((F.col("featureCode") == "ADM2") & F.col("countryCode").isNotNull() & F.col(code).isNotNull()).select("countryCode", code, F.col("geonameId").alias("dst"))
    p = places.where(F.coalesce(F.col("featureClass") != "A", F.lit(False))).select("countryCode", code, F.col("geonameId").alias("src"))
    return p.join(d, ["countryCode", code]).select("src", "dst").distinct()


def walk(edges: DataFrame, start: DataFrame, most: int, least: int = 1) -> DataFrame:
    """(start, node, hops, path) of every walk of ``least`` to ``most`` hops along (src, dst).

    Bounded depth is a chain of equi-joins.  No edge is used twice in a walk, a
    node may be: two steps over one edge are told by its ends, or by ``edge``
    where the edges have such a column, as undirected ones do for both directions.
    """
    e = edges.select(F.col("src").alias("node"), "dst", (F.col("edge") if "edge" in edges.columns else F.struct("src", "dst")).alias("_e"))
    here = start.select(F.col("node").alias("start"), "node", F.lit(0).alias("hops"), F.array("node").alias("path"))
    steps = [here] if least == 0 else []
    for n in range(1, most + 1):
        here = here.join(e, "node")
        used = F.array("_e")
        if n > 1:
            here, used = here.where(~F.array_contains("_used", F.col("_e"))), F.concat("_used", used)
        here = here.select("start", F.col("dst").alias("node"), F.lit(n).alias("hops"), F.concat("path", F.array("dst")).alias("path"), used.alias("_used"))
        if n >= least:
            steps.append(here.drop("_used"))
    return reduce(DataFrame.unionByName, steps)


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of (src, dst) edges, distinct."""
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def closure(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(src, dst) reachable in one or more hops; ends on cycles too.

    Pairs found last are extended by all pairs known, which doubles the reach
    per round; each round is written, so the plan does not grow with the depth.
    """
    known = scratch.save(edges.select("src", "dst").where("src is not null and dst is not null").distinct(), "edges")
    fresh = known
    while True:
        longer = fresh.join(known.select(F.col("src").alias("dst"), F.col("dst").alias("far")), "dst").select("src", F.col("far").alias("dst")).distinct()
        fresh = scratch.save(longer.join(known, ["src", "dst"], "left_anti"), "fresh")
        if fresh.isEmpty():
            return known
        known = known.unionByName(fresh)


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """A guarded ratio: null where the whole is 0."""
    return F.round(F.try_divide(part, whole), digits)
