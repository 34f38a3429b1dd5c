import math
import random

import pytest
from pyspark.sql import functions as F

from geoweave.functions import geo, ids
from geoweave.operators import dualtree, heavy
from geoweave.operators.hierarchy_tour import Hierarchy
from geoweave.runtime import in_force


def km(a, b):
    p = math.pi / 180
    h = math.sin((b[0] - a[0]) * p / 2) ** 2 + math.cos(a[0] * p) * math.cos(b[0] * p) * math.sin((b[1] - a[1]) * p / 2) ** 2
    return 12742 * math.asin(math.sqrt(min(1, h)))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- heavy keys


def test_heavy_keys_exact_threshold_nulls_and_ties(spark):
    data = [("a",)] * 40 + [("b",)] * 40 + [("c",)] * 4 + [(None,)] * 10 + [(f"x{i}",) for i in range(6)]
    got = heavy.heavy_keys(spark.createDataFrame(data, "k string"), "k", 0.04)
    assert {(r.k, r.rows, r.total) for r in got.collect()} == {("a", 40, 100), ("b", 40, 100), ("c", 4, 100)}


def test_heavy_keys_empty_table(spark):
    assert heavy.heavy_keys(spark.createDataFrame([], "k string"), "k", 0.04).count() == 0


def test_join_skewed_equals_plain_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(300)] + [(f"k{i % 7}", i) for i in range(40)] + [(None, 1), ("none", 2)], "k string, v int")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(7)], "k string, w int")
    for how in ("inner", "left"):
        assert sorted(map(str, heavy.join_skewed(left, right, "k", how, 0.1).select("k", "v", "w").collect())) == sorted(map(str, left.join(right, "k", how).select("k", "v", "w").collect()))
    with pytest.raises(ValueError):
        heavy.join_skewed(left, right.withColumn("v", F.lit(1)), "k")
    with pytest.raises(ValueError):
        heavy.join_skewed(left, right, "k", "full")


def test_aggregate_skewed(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [(None, 3)], "k string, v int")
    got = heavy.aggregate_skewed(df, "k", {"n": F.count("v"), "s": F.sum("v")}, {"n": F.sum, "s": F.sum}, "v", 4)
    assert {tuple(r) for r in got.collect()} == {("a", 50, sum(range(50))), (None, 1, 3)}


# ---- points


CASES = {
    "globe": lambda r: (math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)),
    "pole": lambda r: (r.uniform(89.5, 90), r.uniform(-180, 180)),
    "date line": lambda r: (r.uniform(-1, 1), r.choice([-180, 180]) + r.uniform(-0.5, 0.5)),
    "town": lambda r: (45 + r.gauss(0, 0.01), 10 + r.gauss(0, 0.01)),
}


@pytest.mark.parametrize("case,limit", [("globe", 900.0), ("pole", 10.0), ("date line", 10.0), ("town", 2.0)])
def test_near_pairs_against_brute_force(spark, scratch, case, limit):
    r = random.Random(case)
    pts = [(i, *CASES[case](r)) for i in range(180)]
    pts = [(i, a, (o + 180) % 360 - 180) for i, a, o in pts]
    pts += [(1000 + i, 45.0, 10.0) for i in range(30)]  # many on one spot
    want = sorted((a[0], b[0]) for a in pts for b in pts if a[0] < b[0] and km(a[1:], b[1:]) <= limit)
    df = spark.createDataFrame([*pts, (5000, None, 1.0), (5001, float("nan"), 1.0), (5002, 95.0, 1.0)], "id long, lat double, lon double")
    assert rows(dualtree.near_pairs(df, limit, scratch, leaf_cap=6)) == want


def test_near_pairs_empty_and_single(spark, scratch):
    assert dualtree.near_pairs(spark.createDataFrame([], "id long, lat double, lon double"), 2.0, scratch).count() == 0
    assert dualtree.near_pairs(spark.createDataFrame([(1, 0.0, 0.0)], "id long, lat double, lon double"), 2.0, scratch).count() == 0


def test_points_in_regions(spark, scratch):
    r = random.Random(3)
    pts = [(i, r.uniform(-10, 10), r.uniform(-10, 10)) for i in range(400)]
    zones = [(1, "POLYGON((-5 -5, 5 -5, 5 5, -5 5, -5 -5))"), (2, "polygon (( 0 0, 9 1, 2 8 ))"), (3, "POLYGON((-8 -8, 8 -8, 8 8, -8 8),(-4 -4, 4 -4, 4 4, -4 4))"), (4, None), (5, "broken"), (6, "POLYGON((100 50, 101 50, 101 51))")]
    df = spark.createDataFrame(pts, "id long, lat double, lon double")
    z = spark.createDataFrame(zones, "region_id long, b string").select("region_id", geo.polygon_edges(F.col("b")).alias("edges"))

    def inside(x, y, ring):
        c = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                c = not c
        return c

    box = lambda s: [(-s, -s), (s, -s), (s, s), (-s, s)]
    want = [(1, i) for i, a, o in pts if inside(o, a, box(5))] + [(2, i) for i, a, o in pts if inside(o, a, [(0, 0), (9, 1), (2, 8)])]
    want += [(3, i) for i, a, o in pts if inside(o, a, box(8)) and not inside(o, a, box(4))]
    assert rows(dualtree.points_in_regions(df, z, scratch, leaf_cap=5)) == sorted(want)
    assert dualtree.points_in_regions(df.limit(0), z, scratch).count() == 0
    few = df.where("id < 3")
    assert rows(dualtree.points_in_regions(few, z, scratch)) == sorted(w for w in want if w[1] < 3)


def test_position_rule(spark):
    data = [("POINT(2 1)", 5.0, 6.0), ("SRID=4326;POINT (2 1)", None, None), ("point( 2  1 )", None, None), ("POINT(nan nan)", 5.0, 6.0), ("POINT EMPTY", 5.0, 6.0), ("", float("nan"), 6.0), (None, None, None), ("POINT(200 1)", 5.0, 6.0), (None, 95.0, 6.0)]
    got = spark.createDataFrame(data, "l string, a double, o double").select(geo.position(F.col("l"), F.col("a"), F.col("o")).alias("p")).collect()
    assert [tuple(r.p) if r.p else None for r in got] == [(1.0, 2.0)] * 3 + [(5.0, 6.0)] * 2 + [None, None, (5.0, 6.0), None]


# ---- hierarchies


def brute(edges):
    up = {}
    for line, n, p in edges:
        if n is not None and p is not None:
            up[line, n] = min(p, up.get((line, n), p))
    out = set()
    for line, n in up:
        seen, at, depth = {n}, n, 0
        while (line, at) in up:
            at, depth = up[line, at], depth + 1
            if at in seen:
                at, depth = "", -1
                break
            seen.add(at)
        out.add((line, n, at, depth))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_hierarchy_against_walking(spark, scratch, seed):
    r = random.Random(seed)
    edges = [("t", f"n{i}", f"n{r.randrange(max(1, i // 2))}") for i in range(1, 120)]
    edges += [("t", f"c{i}", f"c{(i + 1) % 5}") for i in range(5)] + [("t", f"d{i}", f"c{i % 5}") for i in range(7)] + [("t", "self", "self")]
    edges += [("u", f"q{i}", f"q{i + 1}") for i in range(150)] + [("u", "n3", "rowless"), ("u", None, "x"), ("u", "y", None), ("u", "n3", "rowless")]
    h = Hierarchy(spark.createDataFrame(edges, "line string, node string, parent string"), scratch)
    want = brute(edges)
    assert {tuple(x) for x in h.depths().collect()} == want
    full = {(x.line, x.node_id): x for x in h.full(5).collect()}
    up = {(line, n): p for line, n, p in edges if n and p}
    for line, n, root, depth in want:
        x = full[line, n]
        assert (x.root_id, x.depth) == (root, depth)
        if depth > 0:
            path = [n]
            while (line, path[-1]) in up:
                path.append(up[line, path[-1]])
            assert x.path == path[::-1]
            assert x.descendants == sum(1 for y in full.values() if y.line == line and y.path and n in y.path[:-1])
        else:
            assert x.in_cycle == (n[0] in "cs") and x.path is None
    assert full["u", "q150"].depth == 0 and full["u", "q150"].descendants == 150


def test_hierarchy_many_children_and_empty(spark, scratch, monkeypatch):
    import geoweave.operators.hierarchy_tour as t

    monkeypatch.setattr(t, "_BLOCK", 10)
    edges = [("t", f"k{i}", "hub") for i in range(95)]
    h = Hierarchy(spark.createDataFrame(edges, "line string, node string, parent string"), scratch)
    assert {tuple(x) for x in h.depths().collect()} == brute(edges)
    e = Hierarchy(spark.createDataFrame([], "line string, node string, parent string"), scratch)
    assert e.depths().count() == 0 and e.full().count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_descendants_against_walking(spark, scratch, seed):
    r = random.Random(seed)
    edges = [("t", f"n{i}", f"n{r.randrange(max(1, i // 2))}") for i in range(1, 80)] + [("t", f"c{i}", f"c{(i + 1) % 5}") for i in range(5)]
    edges += [("t", f"d{i}", f"c{i % 5}") for i in range(7)] + [("t", f"e{i}", f"d{i % 7}") for i in range(9)] + [("t", "self", "self"), ("u", "n1", "n0"), ("u", "n0", "top")]
    up, want = {(line, n): p for line, n, p in edges}, set()
    for line, n in up:
        at = n
        while (line, at) in up and (line, up[line, at], n) not in want:
            at = up[line, at]
            want.add((line, at, n))
    e = spark.createDataFrame(edges, "line string, node string, parent string")
    assert rows(Hierarchy(e, scratch, tails=True).descendants(5)) == sorted(want)
    assert Hierarchy(e.limit(0), scratch, tails=True).descendants().count() == 0


@pytest.mark.parametrize("tail", [1, 3, 6, 21])
def test_long_tails_are_not_on_the_circle(spark, scratch, tail):
    edges = [("t", f"x{i}", f"x{i + 1}") for i in range(tail)] + [("t", f"x{tail}", "c"), ("t", "c", "d"), ("t", "d", "c"), ("t", "a", "b")]
    e = spark.createDataFrame(edges, "line string, node string, parent string")
    got = {x.node_id: x.in_cycle for x in Hierarchy(e, scratch).full().collect()}
    assert got == {f"x{i}": False for i in range(tail + 1)} | {"a": False, "b": False, "c": True, "d": True}


# ---- identifiers, rows in force


def test_identifier_notations(spark):
    q = ["Q5", "q5", " Q5 ", "wd:Q5", "<http://e.example/Q5>", "https://e.example/wiki/Q5", "Q0", "", "-", "unknown", None, "viaf"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in q], "x string").select(ids.qid(F.col("x"))).collect()]
    assert got == ["Q5"] * 6 + [None] * 6
    v = ["7300", " 7300", "VIAF 7300", "viaf:7300", "https://a.example/viaf/7300/", "0", "000", "n/a", "viaf", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in v], "x string").select(ids.number_id(F.col("x"))).collect()]
    assert got == ["7300"] * 5 + [None] * 5
    p = ["lincs:4a8f", "LINCS:4A8F", "<lincs:4a8f>", "https://i.example/lincs/4a8f", " lincs:4a8f ", "WD:q5", "Q5", "7300", "none", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "x string").select(ids.person_id(F.col("x"))).collect()]
    assert got == ["lincs:4a8f"] * 5 + ["wd:Q5", "wd:Q5", "viaf:7300", None, None]


def test_in_force(spark):
    df = spark.createDataFrame([(1, "old", "2023-01-01", 9), (1, "new", "2024-01-01", 9), (1, "late", None, 9), (2, "only", None, 9), (None, "x", "2024-01-01", 9)], "k int, v string, t string, extra int").withColumn("loadedAt", F.col("t").cast("timestamp_ntz"))
    assert rows(in_force(df, "k", ["v"])) == [(1, "new"), (2, "only")]


def test_regions_with_long_outlines(spark, scratch):
    """A star of many edges, one with a hole, and one box, over points that need several levels."""
    import math

    r = random.Random(3)
    star = [(30 + (9 if i % 2 else 4) * math.cos(i * math.pi / 60), 40 + (9 if i % 2 else 4) * math.sin(i * math.pi / 60)) for i in range(120)]
    ring = lambda ps: "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*ps, ps[0]]) + ")"
    box = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    regions = [(1, f"POLYGON({ring(star)})"), (2, f"POLYGON({ring(box(20, 45))}, {ring(box(25, 40))})"), (3, f"POLYGON({ring(box(-60, -59))})"), (4, "POLYGON EMPTY"), (5, None)]
    pts = [(i, 40 + r.gauss(0, 6), 30 + r.gauss(0, 6)) for i in range(1500)] + [(5000 + i, 40.0 + i % 7 * 1e-7, 30.0) for i in range(300)] + [(9000, -59.5, -59.5)]
    zones = spark.createDataFrame(regions, "region_id long, boundary string").select("region_id", geo.polygon_edges(F.col("boundary")).alias("edges"))
    got = rows(dualtree.points_in_regions(spark.createDataFrame(pts, "id long, lat double, lon double"), zones, scratch, leaf_cap=16))

    def inside(x, y, loops):
        hit = False
        for ps in loops:
            for (x1, y1), (x2, y2) in zip(ps, [*ps[1:], ps[0]]):
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    hit = not hit
        return hit

    want = sorted((z, i) for z, loops in ((1, [star]), (2, [box(20, 45), box(25, 40)]), (3, [box(-60, -59)])) for i, la, lo in pts if inside(lo, la, loops))
    assert got == want and len({z for z, _ in got}) == 3
