import random

import pytest
from pyspark.sql import functions as F

from geoweave import linking, reconcile
from geoweave.functions import geo
from geoweave.operators import cells, graph, inverted, tables
from geoweave.operators.edits import within_edits
from tests.test_core_problems import km, rows


@pytest.mark.parametrize("box,limit", [((-1, 1, -1, 1), 10.0), ((89, 90, -180, 180), 50.0), ((-60, -59, 179, 181), 10.0), ((-90, 90, -180, 180), 4000.0)])
def test_radius_join_against_brute_force(spark, box, limit):
    r = random.Random(1)
    mk = lambda n: [(i, r.uniform(box[0], box[1]), (r.uniform(box[2], box[3]) + 180) % 360 - 180) for i in range(n)]
    a, b = mk(80), mk(160)
    want = sorted((x[0], y[0]) for x in a for y in b if round(km(x[1:], y[1:]), 3) <= limit)
    s, t = spark.createDataFrame([*a, (999, None, 1.0)], "id long, lat double, lon double"), spark.createDataFrame(b, "id long, lat double, lon double")
    got = cells.radius_join(s, t, limit)
    assert rows(got.select("src_id", "dst_id")) == want
    if limit < 1000:
        assert rows(cells.box_join(s, t, limit).select("src_id", "dst_id")) == want
    near = cells.nearest(got, 2).collect()
    assert all(n.rank <= 2 for n in near) and len({(n.src_id, n["rank"]) for n in near}) == len(near)


def test_radius_join_plan(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "id long, lat double, lon double")
    plan = cells.nearest(cells.radius_join(p, p, 10.0), 3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan and "WindowGroupLimit" in plan


def test_within_edits_against_brute_force(spark):
    r = random.Random(2)
    words = ["".join(r.choice("abc") for _ in range(r.randrange(0, 10))) for _ in range(120)]

    def lev(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            c = [i]
            for j, y in enumerate(b, 1):
                c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
            p = c
        return p[-1]

    for k in (1, 2):
        got = within_edits(spark.createDataFrame([(w,) for w in [*words[:50], None]], "a string"), spark.createDataFrame([(w,) for w in [*words[40:], None]], "b string"), k)
        assert rows(got) == sorted({(a, b, lev(a, b)) for a in words[:50] for b in words[40:] if lev(a, b) <= k})


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 5, "x"), (2, "b", None, "y")], "id int, name string, pop int, keep string")
    new = spark.createDataFrame([(1, "A", None, 1), (1, "A2", None, 2), (3, "c", 7, 1)], "id int, name string, pop int, v int")
    once = tables.upsert(old, new, "id", [F.col("v")]).select("id", "name", "pop", "keep")
    assert sorted(map(str, once.collect())) == sorted(map(str, spark.createDataFrame([(1, "A2", 5, "x"), (2, "b", None, "y"), (3, "c", 7, None)], once.schema).collect()))
    assert sorted(map(str, tables.upsert(once, new, "id", [F.col("v")]).select(*once.columns).collect())) == sorted(map(str, once.collect()))
    assert {r.id: r.name for r in tables.upsert(old, new, "id", [F.col("v")], on_create=("name",)).collect()} == {1: "a", 2: "b", 3: "c"}
    assert {r.id for r in tables.upsert(old, new, "id", [F.col("v")], only_if_exists=True).collect()} == {1, 2}
    e = spark.createDataFrame([("a", "b", 1, 1)], "src string, dst string, w int, t int")
    f = spark.createDataFrame([("a", "b", 2, 1), ("b", "c", 3, 1)], "src string, dst string, w int, t int")
    assert rows(tables.upsert_edges(e, f, [F.col("t")]).select("src", "dst", "w")) == [("a", "b", 2), ("b", "c", 3)]
    assert rows(tables.add_if_absent(old.select("id"), new.select("id"), "id")) == [(1,), (2,), (3,)]
    assert len(tables.first_wins(spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, o int"), ["k"], [F.col("o")]).collect()) == 2
    assert rows(tables.unordered_pairs(spark.createDataFrame([("b", "a"), ("a", "b"), ("c", "c"), ("d", None)], "x string, y string"), "x", "y")) == [("a", "b")]


PLACES = [
    (1, "Town", "P", "PPL", "CA", "01", "02", "03", None, 100), (2, "Region", "A", "ADM1", "CA", "01", None, None, None, 0), (3, "County", "A", "ADM2", "CA", "01", "02", None, None, 0), (4, "Township", "A", "ADM3", "CA", "01", "02", "03", None, 0),
    (5, "Bare", "P", "PPL", "CA", None, None, None, None, 1), (6, "Other", None, "PPL", "US", "01", None, None, None, 1), (7, "Ward", "A", "ADM4", "CA", "01", "02", "03", "04", 0), (8, "Lone", "A", "ADM2", "CA", "09", None, None, None, 0),
]


def test_hierarchy_edges(spark):
    p = spark.createDataFrame(PLACES, "geonameId long, name string, featureClass string, featureCode string, countryCode string, admin1Code string, admin2Code string, admin3Code string, admin4Code string, population long")
    assert [rows(graph.located_in(p, n)) for n in (1, 2, 3, 4)] == [[(1, 2)], [(1, 3)], [(1, 4)], []]
    assert {(r.src, r.level, r.dst, r.dst_country) for r in graph.part_of(p).collect()} == {(2, 1, None, "CA"), (3, 2, 2, None), (4, 3, 3, None), (7, 4, 4, None)}
    assert ("CA.01.02", "CA.01", 2, "CA") in rows(graph.code_divisions(p)) and graph.code_divisions(p.limit(0)).count() == 0


def test_walks_and_closure(spark, scratch):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    w = graph.walk(e, spark.createDataFrame([("a",)], "node string"), 3, 0)
    assert rows(w.select("node", "hops")) == [("a", 0), ("a", 3), ("b", 1), ("c", 2), ("d", 3)]
    got = rows(graph.closure(e, scratch))
    assert got == sorted((x, y) for x in "abc" for y in "abcd")
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "src int, dst int")
    assert graph.closure(chain, scratch).count() == 40 * 41 // 2 and graph.closure(chain.limit(0), scratch).count() == 0
    assert rows(graph.undirected(chain.limit(1))) == [(0, 1), (1, 0)]


def test_linkers(spark):
    src = spark.createDataFrame([("w1", "Maitland", "town", 45.0, -64.0), ("w2", "Nowhere", None, 45.0, -64.0), ("w3", "Far", None, 10.0, 10.0), ("w4", "None", None, None, None)], "id string, name string, label string, lat double, lon double")
    dst = spark.createDataFrame([(1, "Maitland", "PPL", 45.001, -64.0), (2, "Maitland Mill", "BLDG", 45.02, -64.0)], "id long, name string, code string, lat double, lon double")
    one = {(r.src, r.dst): r.relation for r in linking.spatial(src, dst, "nearest").collect()}
    assert one == {("w1", 1): "SAME_AS"}
    c = linking.spatial(src, dst, "canada")
    both = linking.same_as_too(c)
    assert {(r.src, r.dst, r.relation) for r in both.where("dst = 1 and src = 'w1'").collect()} == {("w1", 1, "NEAR"), ("w1", 1, "SAME_AS")}
    ref = spark.createDataFrame([("w1", "gn:0001"), ("w2", "2.0"), ("w3", "nine"), ("w4", None), ("w5", "77")], "id string, ref string")
    assert rows(linking.by_id(ref, dst)) == [("w1", 1), ("w2", 2)]
    off = spark.createDataFrame([(1, "Maitland Post Office", "Nova Scotia"), (2, "Twin P.O.", "Nova Scotia"), (3, "X", None)], "id long, name string, province string")
    pl = spark.createDataFrame([(10, "Maitland", "07"), (11, "Maitland", "08"), (12, "Twin", "NS"), (13, "Twin", "07")], "id long, name string, admin1 string")
    assert rows(linking.by_name_and_province(off, pl)) == [(1, 10)]


def test_historical_point_prefers_the_city(spark):
    pts = spark.createDataFrame([(1, "Toronto", 43.65, -79.38)], "id long, name string, lat double, lon double")
    pl = spark.createDataFrame([(1, "Toronto", "city", "PPLA", "P", 2_600_000, 43.7, -79.4), (2, "CN Tower", "tower", "BLDG", "S", 0, 43.6426, -79.3871)], "id long, name string, label string, code string, class string, population long, lat double, lon double")
    assert linking.historical(pts, pl, 10.0, 0.5).where("rank = 1").first().place == 1


def test_reconcile(spark):
    places = spark.createDataFrame(
        [(1, None, "Regina", ["Wascana"], [], "CA", "PPLA", 200, 50.45, -104.6, None), (2, None, "Regina", [], [], "US", "PPL", None, 40.0, -90.0, None), (3, None, "Regine", [], [], "CA", "PPL", 10, 50.5, -104.6, None), (4, "Q4", "Old Regina", ["Regina"], None, "CA", "PPLH", 0, None, None, "1900")],
        "geonameId long, wikidataId string, name string, alternateNames array<string>, wikidataAlternateNames array<string>, countryCode string, featureCode string, population long, lat double, lon double, dissolvedDate string",
    )
    req = spark.createDataFrame([(1, "Regina", "CA", "11", 50.4, -104.6, 50.0, True), (2, "Rgina", None, None, None, None, None, None), (3, "Zzz", None, None, None, None, None, False)], "mention_id long, name string, country string, admin1 string, lat double, lon double, radius_km double, historical boolean")
    located = spark.createDataFrame([(1, "CA.11")], "src long, division string")
    got = [(r.mention_id, r.geonameId, r.strategy) for r in reconcile.smart(req, places, located, 0.5).orderBy("mention_id", "rank").collect()]
    assert got == [(1, 1, "exact"), (1, 4, "exact"), (1, 3, "fuzzy"), (2, 1, "fuzzy"), (2, 2, "fuzzy"), (2, 3, "fuzzy")]
    assert [r.geonameId for r in reconcile.historical(req, places).collect()] == [4]
    assert reconcile.smart(req.limit(0), places, located).count() == 0


def test_walks_use_no_edge_twice(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c")], "src string, dst string")
    start = spark.createDataFrame([("a",), ("c",)], "node string")
    assert rows(graph.walk(e, start, 3, 0).select("start", "node", "hops")) == [("a", "a", 0), ("a", "a", 2), ("a", "b", 1), ("c", "c", 0), ("c", "c", 1)]
    both = spark.createDataFrame([("a", "b", 1), ("b", "a", 1), ("b", "d", 2), ("d", "b", 2)], "src string, dst string, edge int")
    assert rows(graph.walk(both, start, 2, 2).select("start", "node")) == [("a", "d")]
    assert graph.walk(e, start.limit(0), 2, 0).count() == 0


@pytest.mark.parametrize("k", [1, 3, 10])
def test_nearest_against_all_pairs(spark, k):
    r = random.Random(k)
    # Uneven: one spot that very many share, a dense town, the date line, a pole.
    pts = [(i, 10.0, 20.0) for i in range(60)] + [(100 + i, 10 + r.gauss(0, 0.004), 20 + r.gauss(0, 0.004)) for i in range(200)] + [(400 + i, r.uniform(-1, 1), (179.9 + r.uniform(0, 0.2) + 180) % 360 - 180) for i in range(60)]
    pts += [(600 + i, 89.97 + r.uniform(0, 0.03), r.uniform(-180, 180)) for i in range(30)] + [(700 + i, r.uniform(-80, 80), r.uniform(-180, 180)) for i in range(30)] + [(800, None, 1.0), (801, float("nan"), 1.0), (802, 95.0, 1.0)]
    src = spark.createDataFrame([(-i, a, o) for i, a, o in pts[::3]], "id long, lat double, lon double")
    dst = spark.createDataFrame(pts, "id long, lat double, lon double")
    assert rows(cells.knn(src, dst, 10.0, k)) == rows(cells.nearest(cells.radius_join(src, dst, 10.0), k))


def test_word_index(spark, scratch):
    t = spark.createDataFrame([(1, "Школа у моста, school"), (2, "school school bridge"), (3, None), (4, ""), (5, "straße")], "id int, text string")
    index = inverted.word_index(t, "id", "text", scratch)
    assert rows(index.where("term = 'school'")) == [("school", 1, 1), ("school", 2, 2)]
    assert [(r.id, r.terms) for r in inverted.search_words(index, ["SCHOOL", "школа"], least=2).collect()] == [(1, 2)] and inverted.search_words(index, ["none"]).count() == 0
    empty = inverted.word_index(t.limit(0), "id", "text", scratch)
    assert inverted.search_words(empty, ["school"]).count() == 0


def test_repaired_positions(spark):
    t = spark.createDataFrame([(10.0, 20.0), (120.0, 20.0), (200.0, 200.0), (None, 1.0), (float("nan"), 1.0)], "a double, o double")
    got = [tuple(r[0]) if r[0] else None for r in t.select(geo.repaired(F.col("a"), F.col("o"))).collect()]
    assert got == [(10.0, 20.0, "kept"), (20.0, 120.0, "swapped"), None, None, None]
