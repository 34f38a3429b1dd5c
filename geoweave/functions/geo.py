"""Geometry as column expressions: a sphere of radius 6371 km, plane polygons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; null if any coordinate is null."""
    a = _hav(lat1, lon1, lat2, lon2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))


def _hav(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    s = F.sin(F.radians(lat2 - lat1) / 2)
    t = F.sin(F.radians(lon2 - lon1) / 2)
    return s * s + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * t * t


def bounding_box(lat: Column, lon: Column, km: Column) -> Column:
    """struct(south, north, west, east, wraps): a box that holds the circle around a point.

    Latitudes are clamped to the poles; a box that meets a pole spans all
    longitudes; one that crosses the date line has ``wraps`` true and west > east.
    """
    d = km / EARTH_KM
    dlat = F.degrees(d)
    reach = F.sin(d) / F.cos(F.radians(lat))
    polar = (F.abs(lat) + dlat >= 90) | (reach.isNull()) | (F.abs(reach) >= 1)
    dlon = F.when(polar, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), reach))))
    west, east = lon - dlon, lon + dlon
    wraps = ~polar & ((west < -180) | (east > 180))
    return F.struct(
        F.greatest(F.lit(-90.0), lat - dlat).alias("south"),
        F.least(F.lit(90.0), lat + dlat).alias("north"),
        F.when(polar, F.lit(-180.0)).when(west < -180, west + 360).otherwise(west).alias("west"),
        F.when(polar, F.lit(180.0)).when(east > 180, east - 360).otherwise(east).alias("east"),
        wraps.alias("wraps"),
    )


def in_box(lat: Column, lon: Column, box: Column) -> Column:
    inside = F.when(box["wraps"], (lon >= box["west"]) | (lon <= box["east"])).otherwise(lon.between(box["west"], box["east"]))
    return lat.between(box["south"], box["north"]) & inside


def valid_position(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180)


def repaired(lat: Column, lon: Column) -> Column:
    """struct(lat, lon, outcome): kept, or swapped where only the exchanged numbers are a position; null where neither is."""
    made = lambda a, o, how: F.struct(a.alias("lat"), o.alias("lon"), F.lit(how).alias("outcome"))
    return F.when(valid_position(lat, lon), made(lat, lon, "kept")).when(valid_position(lon, lat), made(lon, lat, "swapped"))


def parse_point(text: Column) -> Column:
    """struct(lat, lon) from point text, longitude first; null where it gives no point."""
    pat = r"(?i)point\s*z?\s*\(\s*([-+]?[0-9.]+(?:e[-+]?[0-9]+)?)[\s,]+([-+]?[0-9.]+(?:e[-+]?[0-9]+)?)"
    lon = F.regexp_extract(text, pat, 1).try_cast("double")
    lat = F.regexp_extract(text, pat, 2).try_cast("double")
    return F.when(valid_position(lat, lon), F.struct(lat.alias("lat"), lon.alias("lon")))


def position(location: Column, lat: Column, lon: Column) -> Column:
    """struct(lat, lon): the point text where it gives a point, else the two numbers, else null."""
    own = F.when(valid_position(lat, lon), F.struct(lat.alias("lat"), lon.alias("lon")))
    return F.coalesce(parse_point(location), own)


def min_hav(a: dict, b: dict) -> Column:
    """Lower bound of the haversine between any two points of two boxes."""
    dlat = F.greatest(F.lit(0.0), a["s"] - b["n"], b["s"] - a["n"])
    gap = F.greatest(F.lit(0.0), a["w"] - b["e"], b["w"] - a["e"])
    around = F.greatest(F.lit(0.0), F.lit(360.0) - (F.greatest(a["e"], b["e"]) - F.least(a["w"], b["w"])))
    dlon = F.least(gap, around)
    c = F.cos(F.radians(F.greatest(F.abs(a["s"]), F.abs(a["n"])))) * F.cos(F.radians(F.greatest(F.abs(b["s"]), F.abs(b["n"]))))
    s, t = F.sin(F.radians(dlat) / 2), F.sin(F.radians(dlon) / 2)
    return s * s + F.greatest(F.lit(0.0), c) * t * t


def max_hav(a: dict, b: dict) -> Column:
    """Upper bound of the haversine between any two points of two boxes."""
    dlat = F.greatest(a["n"] - b["s"], b["n"] - a["s"])
    dlon = F.least(F.lit(180.0), F.greatest(a["e"] - b["w"], b["e"] - a["w"]))

    def widest(x: dict) -> Column:
        nearest = F.when((x["s"] <= 0) & (x["n"] >= 0), F.lit(0.0)).otherwise(F.least(F.abs(x["s"]), F.abs(x["n"])))
        return F.cos(F.radians(nearest))

    s, t = F.sin(F.radians(dlat) / 2), F.sin(F.radians(dlon) / 2)
    return s * s + widest(a) * widest(b) * t * t


def hav_of_km(km: float) -> float:
    import math

    x = min(km / EARTH_KM, math.pi)
    return math.sin(x / 2) ** 2


def polygon_edges(text: Column) -> Column:
    """array of struct(x1, y1, x2, y2) from polygon text, every ring closed; null if unreadable.

    Holes and several rings count by the even-odd rule.
    """
    body = F.regexp_extract(text, r"(?is)polygon\s*z?\s*(\(.*\))", 1)
    rings = F.filter(F.split(body, r"\)\s*,\s*\("), lambda r: F.trim(r) != "")
    number = r"\s+"

    def points(r: Column) -> Column:
        flat = F.trim(F.regexp_replace(r, r"[()]", " "))
        return F.transform(F.split(flat, r"\s*,\s*"), lambda p: F.split(F.trim(p), number).try_cast("array<double>"))

    def edges(r: Column) -> Column:
        pts = points(r)
        n = F.size(pts)
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                F.get(F.get(pts, i), F.lit(0)).alias("x1"),
                F.get(F.get(pts, i), F.lit(1)).alias("y1"),
                F.get(F.get(pts, (i + 1) % n), F.lit(0)).alias("x2"),
                F.get(F.get(pts, (i + 1) % n), F.lit(1)).alias("y2"),
            ),
        )

    return F.when(body != "", F.flatten(F.transform(rings, edges)))


def point_in_edges(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd rule in the plane."""
    hits = F.filter(
        edges,
        lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]),
    )
    return F.size(hits) % 2 == 1


def box_touches_edges(box: dict, edges: Column) -> Column:
    """False only if no edge's own bounding box meets the box: then it is all in or all out."""
    return F.exists(
        edges,
        lambda e: (F.greatest(e["x1"], e["x2"]) >= box["w"])
        & (F.least(e["x1"], e["x2"]) <= box["e"])
        & (F.greatest(e["y1"], e["y2"]) >= box["s"])
        & (F.least(e["y1"], e["y2"]) <= box["n"]),
    )
