import math

import pytest
from pyspark.sql import functions as F

from geoweave.functions import geo, scores, text


def col(spark, values, kind, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(f(F.col("x"))).collect()]


def test_distance_steps(spark):
    assert col(spark, [0.0, 0.1, 0.11, 1.0, 1.1, 5.0, 5.1, 10.0, 10.1, None], "double", scores.distance_score) == [1.0, 1.0, 0.9, 0.9, 0.7, 0.7, 0.5, 0.5, 0.3, None]
    assert col(spark, [0.5, 0.6, 2.0, 5.0, 10.0, 25.0, 26.0], "double", lambda c: scores.distance_score(c, True)) == [1.0, 0.9, 0.9, 0.75, 0.5, 0.3, 0.1]


def test_name_scores(spark):
    df = spark.createDataFrame([("Toronto", "toronto"), ("Toronto City", "Toronto"), ("Old Red Mill", "Red Old Barn House"), ("a", "b"), ("", "x"), (None, "x"), ("x", None)], "a string, b string")
    assert [round(r[0], 4) for r in df.select(scores.name_score(F.col("a"), F.col("b"))).collect()] == [1.0, 0.8, 0.25, 0.0, 0.0, 0.0, 0.0]
    assert [round(r[0], 4) for r in df.select(scores.name_score(F.col("a"), F.col("b"), True)).collect()] == [1.0, 0.8, 0.25, 0.0, 0.0, 0.0, 0.5]


def test_priorities(spark):
    assert col(spark, ["county", "Village", "district", "estate", None], "string", scores.label_priority) == [85, 70, 40, 50, 50]
    assert col(spark, ["ADM3", "PPLA2", "ppl", "AREA", "PPLX", "SCH", None], "string", scores.code_priority) == [85, 80, 70, 75, 40, 50, 50]
    df = spark.createDataFrame([("real estate", None, None), ("tower", "PPL", "P"), (None, "CH", "S"), (None, "X", "L"), (None, None, None), ("regional county municipality", None, None)], "l string, c string, k string")
    assert [r[0] for r in df.select(scores.historical_priority(F.col("l"), F.col("c"), F.col("k"))).collect()] == [95, 10, 15, 55, 30, 90]


def test_confidences_and_relations(spark):
    one = spark.range(1)
    assert one.select(scores.type_score(F.lit(70), F.lit(70))).first()[0] == pytest.approx(0.84)
    assert one.select(scores.type_score(F.lit(50), F.lit(70))).first()[0] == pytest.approx(0.6)
    assert one.select(scores.confidence(F.lit(1.0), F.lit(1.0), F.lit(1.2))).first()[0] == 1.0
    assert one.select(scores.historical_confidence(F.lit(1.0), F.lit(100), F.lit(1.0), F.lit(1.3))).first()[0] == pytest.approx(0.93)
    assert col(spark, [None, 0, 999, 1000, 10_000, 100_000], "long", scores.population_weight) == [1.0, 1.0, 1.0, 1.1, 1.2, 1.3]
    rel = lambda p, a, b, km, c: one.select(scores.relation(p, F.lit(a), F.lit(b), F.lit(km), F.lit(c))).first()[0]
    assert [rel("canada", 50, 70, 5.0, 0.9), rel("canada", 70, 70, 0.5, 0.9), rel("global", 70, 70, 1.0, 0.85), rel("global", 70, 70, 1.1, 0.9), rel("nearest", 0, 0, 0.5, 0.9), rel("nearest", 0, 0, 5.0, 0.8), rel("nearest", 0, 0, 6.0, 0.8)] == [
        "LOCATED_IN", "NEAR", "SAME_AS", "NEAR", "SAME_AS", "NEAR", "LOCATED_IN",
    ]


def test_text_functions(spark):
    assert col(spark, ["Regina Post Office", "Moose Jaw P.O.", "Camp M.P.O. 5", " Plain ", "St. Paul", None], "string", text.office_name) == ["regina", "moose jaw", "camp", "plain", "st. paul", None]
    assert col(spark, ["https://g.example/6098717/", "https://g.example/6098717l", "none", None], "string", text.url_number) == [6098717, 6098717, None, None]
    assert col(spark, ["1867-07-01T00:00", "about 1850", "-0044-03-15", "n.d.", None], "string", text.normal_date) == ["1867-07-01", "1850", "-0044-03-15", "n.d.", None]
    assert col(spark, ["+1867-07-01T00:00:00Z", "-0044-03-15T00:00:00Z"], "string", text.time_date) == ["1867-07-01", "-0044-03-15"]
    assert col(spark, ["+1234.9", "-3.5", "x", None], "string", text.amount) == [1234, -3, None, None]
    assert col(spark, ["Indian Agent occupation of J. X", "nothing", ""], "string", text.occupation_role) == ["Indian Agent", "Unknown", "Unknown"]
    assert col(spark, [" a, ,b ,", "", None], "string", text.split_names) == [["a", "b"], [], []]
    assert col(spark, ["Ontario", "Nowhere"], "string", text.province_codes) == [["ON", "08"], None]
    assert col(spark, ["New York City"], "string", text.article_url) == ["https://en.wikipedia.org/wiki/New_York_City"]


def test_bounding_boxes_hold_the_circle(spark):
    pts = [(0.0, 0.0, 100.0), (60.0, 179.9, 50.0), (89.9, 10.0, 50.0), (-45.0, -179.99, 10.0)]
    r = spark.createDataFrame(pts, "lat double, lon double, km double").select("*", geo.bounding_box(F.col("lat"), F.col("lon"), F.col("km")).alias("b")).collect()
    for x in r:
        for k in range(36):
            t, d = k * math.pi / 18, x.km / geo.EARTH_KM * 0.9999
            a, o = math.radians(x.lat), math.radians(x.lon)
            la = math.asin(math.sin(a) * math.cos(d) + math.cos(a) * math.sin(d) * math.cos(t))
            lo = math.degrees(o + math.atan2(math.sin(t) * math.sin(d) * math.cos(a), math.cos(d) - math.sin(a) * math.sin(la)))
            la, lo = math.degrees(la), (lo + 180) % 360 - 180
            assert x.b.south <= la <= x.b.north
            assert (lo >= x.b.west or lo <= x.b.east) if x.b.wraps else x.b.west <= lo <= x.b.east
