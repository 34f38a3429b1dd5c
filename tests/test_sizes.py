"""Plans that must hold at any size: nothing that grows with the input goes through the driver, no step writes its whole output to disk."""

import random

from geoweave import reconcile
from geoweave.operators import graph
from geoweave.operators.edits import within_edits


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_pieces_of_names_are_not_broadcast(spark):
    r = random.Random(3)
    names = ["".join(r.choice("abcdefghij") for _ in range(12)) for _ in range(300)]
    got = within_edits(spark.createDataFrame([(w,) for w in names], "a string"), spark.createDataFrame([(w[:5] + w[6:],) for w in names], "b string"))
    assert "Broadcast" not in plan(got)
    assert {(w, w[:5] + w[6:], 1) for w in names} <= set(map(tuple, got.collect()))


def test_fuzzy_ranks_namesakes_once_and_broadcasts_nothing(spark):
    """500 namesakes a country and 60 requests for them: each request's best 20 over countries, one with two rows of its own."""
    p = [(n, f"Q{n}", "Aberdon", "XA" if n % 2 else "XB", None if n % 50 == 0 else n % 97) for n in range(1000)] + [(2000, None, "Aberden", None, 10**6), (2001, None, None, "XA", 1)]
    places = spark.createDataFrame(p, "geonameId long, wikidataId string, name string, countryCode string, population long")
    asked = [(m, "aberdon" if m % 3 else "Aberdonn", (None, "XA", "XB")[m % 4 % 3]) for m in range(60)] + [(7, "Aberdo", "XB"), (90, None, None)]
    got = reconcile.fuzzy(spark.createDataFrame(asked, "mention_id long, name string, country string"), places)
    steps = plan(got)
    assert "Broadcast" not in steps
    edits = {("aberdon", "aberdon"): 0, ("aberdon", "aberden"): 1, ("aberdonn", "aberdon"): 1, ("aberdonn", "aberden"): 2, ("aberdo", "aberdon"): 1, ("aberdo", "aberden"): 2}
    want = []
    for m in {m for m, name, _ in asked if name}:
        rows = [(d, -1 if x is None else x, g, round(1 - d / len(name), 3)) for i, name, c in asked if i == m for g, _, b, code, x in p if b and (c is None or c == code) for d in [edits[name.lower(), b.lower()]]]
        rows.sort(key=lambda x: (x[0], -x[1], x[2]))
        want += [(m, g, confidence, k + 1) for k, (_, _, g, confidence) in enumerate(rows[:20])]
    assert sorted(map(tuple, got.select("mention_id", "geonameId", "confidence", "place_rank").collect())) == sorted(want)


def test_edges_of_the_hierarchy_are_not_shuffled(spark):
    """Each place and division once, some with rows of two keys: pairs stay distinct without gathering them."""
    r = random.Random(4)
    code = lambda: r.choice(["1", "2", None])
    made = [(n % 150, r.choice(["P", "S", "A", None]), r.choice(["XA", "XB", None]), code(), code(), code(), code()) for n in range(400)]
    rows = [(i, k, f"ADM{1 + i % 4}" if k == "A" else None, *x) for i, k, *x in made]
    places = spark.createDataFrame(rows, "geonameId long, featureClass string, featureCode string, countryCode string, admin1Code string, admin2Code string, admin3Code string, admin4Code string")
    got = graph.located(places)
    steps = plan(got)
    assert "Aggregate" not in steps[: steps.index("Join")]
    full = lambda x, n: x[3 : n + 4] if None not in x[3 : n + 4] else None
    want = {(n, a[0], b[0]) for n in (1, 2, 3, 4) for a in rows for b in rows if a[1] and a[1] != "A" and b[2] == f"ADM{n}" and full(a, n) and full(a, n) == full(b, n)}
    assert sorted(map(tuple, got.collect())) == sorted(want)
