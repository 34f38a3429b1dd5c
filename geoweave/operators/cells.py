"""Radius and nearest-neighbour joins of two point sets by grid cells.

Latitude bands of one radius height; each band has its own number of cells, so
that a cell is at least one radius wide at its latitude.  A target row has one
cell, a source row meets the distinct cells around its own; an equi-join on the
cell and a residual distance follow.  Works across the date line and the poles.

For the k nearest, each source first learns from counts in ever smaller cells how
near k targets certainly are, and only that circle is searched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoweave.functions import geo


def _grid(km: float) -> tuple[float, float]:
    d = km / geo.EARTH_KM * (1 + 1e-6)
    return d, math.degrees(d)


def _width(band: Column, d: float, height: float) -> Column:
    """Cells of a band; one where a radius spans the band's shortest parallel."""
    outer = F.least(F.lit(90.0), F.greatest(F.abs((band - 1) * height - 90), F.abs((band + 2) * height - 90)))
    c = F.cos(F.radians(outer))
    return F.when(c <= d, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(360 / F.degrees(d / c)))).cast("long")


def own_cell(lat: Column, lon: Column, km: float) -> Column:
    d, h = _grid(km)
    band = F.floor((lat + 90) / h).cast("long")
    n = _width(band, d, h)
    return F.struct(band.alias("cy"), F.least(n - 1, F.floor((lon + 180) / 360 * n).cast("long")).alias("cx"))


def cells_around(lat: Column, lon: Column, km: float) -> Column:
    d, h = _grid(km)
    mid = F.floor((lat + 90) / h).cast("long")

    def of_band(b: Column) -> Column:
        n = _width(b, d, h)
        x = F.least(n - 1, F.floor((lon + 180) / 360 * n).cast("long"))
        return F.transform(F.array(x - 1, x, x + 1), lambda i: F.struct(b.alias("cy"), F.pmod(i, n).alias("cx")))

    return F.array_distinct(F.flatten(F.transform(F.array(mid - 1, mid, mid + 1), of_band)))


def _sides(source: DataFrame, target: DataFrame, km: float) -> tuple[DataFrame, DataFrame]:
    """Sources at the cells around them, targets at their own; both with cy and cx."""
    s = source.withColumn("cell", F.explode(cells_around(F.col("slat"), F.col("slon"), km))).select("*", "cell.cy", "cell.cx").drop("cell")
    t = target.withColumn("cell", own_cell(F.col("tlat"), F.col("tlon"), km)).select("*", "cell.cy", "cell.cx").drop("cell")
    return s, t


def _points(df: DataFrame, p: str) -> DataFrame:
    name = {"s": "src_id", "t": "dst_id"}[p]
    return df.where(geo.valid_position(F.col("lat"), F.col("lon"))).select(F.col("id").alias(name), F.col("lat").alias(f"{p}lat"), F.col("lon").alias(f"{p}lon"))


def _km() -> Column:
    return F.round(geo.haversine_km(F.col("slat"), F.col("slon"), F.col("tlat"), F.col("tlon")), 3)


def radius_join(source: DataFrame, target: DataFrame, km: float) -> DataFrame:
    """(src_id, dst_id, km) of all pairs at most ``km`` apart, km rounded to metres.

    Both sides have id, lat, lon; rows without a valid position have no pair.
    Distances are compared after rounding.  A full cell is a skewed key of an
    inner join, which the adaptive planner splits.
    """
    s, t = _sides(_points(source, "s"), _points(target, "t"), km)
    return s.join(t, ["cy", "cx"]).select("src_id", "dst_id", _km().alias("km")).where(F.col("km") <= km)


def nearest(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest targets per source, ties by target id, with their rank."""
    w = Window.partitionBy("src_id").orderBy("km", "dst_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


#: How often the radius of a nearest search may halve.
HALVINGS = 5


def knn(source: DataFrame, target: DataFrame, km: float, k: int, salts: int = 16) -> DataFrame:
    """(src_id, dst_id, km, rank): the k nearest targets at most ``km`` away, ties by target id.

    Equals ``nearest(radius_join(...), k)`` without its pairs.  Of targets on one
    spot only the k smallest ids can count, so a spot is cut down to them, in two
    steps.  A cell whose diagonal is at most r and that holds k targets shows
    that they all lie within r of a source in it; each source searches the
    smallest such r of km, km / 2, km / 4 and so on.
    """
    first = lambda df, *by: df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("dst_id"))).where(F.col("_r") <= k).drop("_r")
    t = _points(target, "t").withColumn("_s", F.pmod(F.xxhash64("dst_id"), F.lit(salts)))
    t = first(first(t, "tlat", "tlon", "_s").drop("_s"), "tlat", "tlon")
    s = _points(source, "s")
    radii = [km / 2**j for j in range(HALVINGS + 1)]
    # Rounding moves a distance by half a metre at most.
    small = lambda la, lo: F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _inner_cell(la, lo, r - 0.001).alias("c")) for j, r in enumerate(radii) if j and r > 0.002]))
    full = t.select(small(F.col("tlat"), F.col("tlon")).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("x")
    best = s.select("src_id", small(F.col("slat"), F.col("slon")).alias("x")).join(full, "x", "left_semi").groupBy("src_id").agg(F.max("x.j").alias("j"))
    s = s.join(best, "src_id", "left").withColumn("j", F.coalesce("j", F.lit(0)))
    around = F.lit(None)
    for j, r in enumerate(radii):
        around = F.when(F.col("j") == j, cells_around(F.col("slat"), F.col("slon"), r)).otherwise(around)
    s = s.withColumn("cell", F.explode(around)).select("*", "cell.cy", "cell.cx").drop("cell")
    own = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), own_cell(F.col("tlat"), F.col("tlon"), r).alias("at")) for j, r in enumerate(radii)]))
    t = t.withColumn("x", own).select("dst_id", "tlat", "tlon", "x.j", "x.at.cy", "x.at.cx")
    reach = F.element_at(F.array(*[F.lit(r) for r in radii]), F.col("j") + 1)
    return nearest(s.join(t, ["j", "cy", "cx"]).withColumn("km", _km()).where(F.col("km") <= reach).select("src_id", "dst_id", "km"), k)


def _inner_cell(lat: Column, lon: Column, km: float) -> Column:
    """A cell with no two points further than ``km`` apart: both sides at most km / 1.5."""
    height = math.degrees(km / 1.5 / geo.EARTH_KM)
    band = F.floor((lat + 90) / height)
    # The parallel nearest the equator is the longest of a band.
    inner = F.when((band * height - 90 <= 0) & ((band + 1) * height - 90 >= 0), F.lit(0.0)).otherwise(F.least(F.abs(band * height - 90), F.abs((band + 1) * height - 90)))
    n = F.ceil(360 * F.cos(F.radians(inner)) / height) + 1
    return F.struct(band.alias("cy"), F.floor((lon + 180) / 360 * n).alias("cx"))


def box_join(source: DataFrame, target: DataFrame, km: float) -> DataFrame:
    """As ``radius_join``, with the bounding box as a cheap filter before the distance."""
    s, t = _sides(_points(source, "s").withColumn("box", geo.bounding_box(F.col("slat"), F.col("slon"), F.lit(float(km)))), _points(target, "t"), km)
    near = s.join(t, ["cy", "cx"]).where(geo.in_box(F.col("tlat"), F.col("tlon"), F.col("box")))
    return near.select("src_id", "dst_id", _km().alias("km")).where(F.col("km") <= km)
