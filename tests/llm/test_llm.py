import random
import re

import pytest
from pyspark.sql import functions as F

from geoweave.llm import canonical, entity_match, leak, mixing, pii
from geoweave.llm.components import components, star_edges


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- groups


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(spark, scratch, seed):
    r = random.Random(seed)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(300, 300 + i) for i in range(60)] + [(400 + i, 401 + i) for i in range(40)] + [(7, 7), (5, None)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long"), scratch)
    assert rows(got) == sorted((v, find(v)) for v in up)


def test_components_empty_and_star(spark, scratch):
    assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0
    m = spark.createDataFrame([(1, "k"), (2, "k"), (3, "k"), (3, "k"), (4, None), (5, "lone")], "vid long, key string")
    assert rows(star_edges(m, scratch)) == [(1, 2), (1, 3)]


# ---- canonical list


def osa(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_against_dynamic_programming():
    r = random.Random(1)
    words = ["".join(r.choice("abc") for _ in range(r.randrange(1, 9))) for _ in range(150)]
    trie = canonical.Trie({w: [i] for i, w in enumerate(dict.fromkeys(words))})
    names = list(dict.fromkeys(words))
    for q in [*words[:60], "", "abcabcabc"]:
        for k in (0, 1, 2, 3):
            got = {(d, e) for d, e in trie.search(q, k)}
            assert got == {(osa(q, w), i) for i, w in enumerate(names) if osa(q, w) <= k}, (q, k)


def test_matcher():
    entries = [(1, "AA", 10, ["Gánjenumba", "Duvelgate"]), (2, "BB", 5, ["Port Dreanbruckgate"]), (3, "AA", 1, ["Chèmurtval"]), (4, "CC", 9, ["Chèmurtval"]), (5, "DD", 0, ["Letelares Point"])]
    m = canonical.Matcher(entries, [("AA", "Arlandia"), ("CC", "Corlandia")])
    for raw, hint, want in [
        ("Gánjenumba", None, 1), ("near ganjenumba (sic)", None, 1), ("GANJENUMBA P.O.", None, 1), ("Ganjneumba", None, 1), ("duvelgate?", None, 1), ("Pt. Dreanbrukgate", None, 2), ("Port Dreanbruck", None, 0),
        ("Chemurtval", "CC", 4), ("Chemurtval", "aa", 3), ("Chemurtval, Corl.", None, 4), ("Letelares Poi.", None, 5), ("vicinity-of-Duvelgate", None, 1), ("at sea", None, 0), ("", None, 0), (None, None, 0), ("?", "AA", 0), ("Zzzzzzzzz", None, 0), ("x" * 5000, None, 0),
    ]:
        assert m.match(raw, hint)[0] == want, raw


# ---- leaks


ITEM = "One marshy barn notices jetties under an outpost while its plain chapel inherits broken depots along the quiet northern road."


@pytest.fixture(scope="module")
def items():
    return leak.Items([(1, ITEM), (2, "Chez nous le vallon décrit la carrière, mais le four fermé ferme enfin la douane penchée du port."), (3, "too short to count"), (4, None), (5, "")])


@pytest.mark.parametrize(
    "text,want",
    [
        (ITEM, {1}), (f"<p>Before. {ITEM.upper()}</p> After.", {1}), (ITEM.replace(" ", "\n  "), {1}), (ITEM.replace("barn", "b-arn").replace("under an", "underan"), {1}),
        ("chez nous le vallon decrit la carriere mais le four ferme ferme enfin la douane penchee du port", {2}), (ITEM.replace("jetties", "harbours").replace("plain", "grey"), {1}),
        (" ".join(ITEM.split()[3:16]), {1}), (" ".join(ITEM.split()[:10]), set()), (" ".join(w if i % 3 else "other" for i, w in enumerate(ITEM.split())), set()), (ITEM.replace("chapel ", ""), {1}), ("", set()), ("x" * 100_000, set()),
    ],
)
def test_leaks(items, text, want):
    assert set(items.found(text)) == want


def test_wu_manber_against_find():
    r = random.Random(2)
    pats = list({"".join(r.choice("ab") for _ in range(r.randrange(6, 12))) for _ in range(40)})
    text = "".join(r.choice("ab") for _ in range(3000))
    want = {(i, p) for p in pats for i in range(len(text)) if text.startswith(p, i)}
    assert set(leak.WuManber({p: [] for p in pats}, 4).search(text)) == want
    assert list(leak.WuManber({}).search("abc")) == []


# ---- mixing


def test_mixing_against_a_simple_queue(spark, scratch, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 40)
    r = random.Random(4)
    docs = [(i, r.choice(["a", "a", "a", "b", "c", None]), r.randrange(1, 60)) for i in range(600)] + [(900, "a", 0), (901, "z", 9)]
    goals = [("m", "A", 50.0, "percent", 2, 1.0), ("m", "b", 30.0, "percent", None, 1.0), ("m", "c ", 10.0, "percent", 3, 1.0), ("m", "none", 10.0, "percent", 3, 1.0), ("n", "b", 0.5, "fraction", 50, 9.0), ("n", "c", None, "fraction", 2, 9.0), ("m", None, 1.0, "fraction", 1, 1.0)]
    g = spark.createDataFrame(goals, "mix string, source string, weight double, unit string, max_repeats int, size_factor double")
    chosen, t, _ = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, tokens long"), g, scratch)
    got = {}
    for c in chosen.collect():
        got.setdefault(c["mix"], []).append((c.finish, c.source, c.doc_id, c["copy"], c.tokens))
    whole = sum(d[2] for d in docs)
    size = {s: sum(d[2] for d in docs if d[1] == s) for s in "abc"}
    order = {x.doc_id: x.h for x in spark.createDataFrame(docs, "doc_id long, source string, tokens long").select("doc_id", F.xxhash64("doc_id", F.lit("mix")).alias("h")).collect()}
    for mix, weights, caps, budget in (("m", {"a": 0.5 / 0.9, "b": 0.3 / 0.9, "c": 0.1 / 0.9}, {"a": 2, "b": 1, "c": 3}, whole), ("n", {"b": 1.0}, {"b": 50}, 9 * whole)):
        queue = []
        for s, w in weights.items():
            run = 0
            for _, i, n in sorted((order[d[0]], d[0], d[2]) for d in docs if d[1] == s and d[2]):
                run += n
                queue += [((c * size[s] + run) / w, s, i, c + 1, n) for c in range(caps[s])]
        want, full = set(), 0
        for f, s, i, c, n in sorted(queue):
            if full + n > budget:
                break
            full += n
            want.add((s, i, c))
        assert {(s, i, c) for _, s, i, c, _ in got[mix]} == want
    rep = {(x["mix"], x.source): x for x in mixing.shares(chosen, t).collect()}
    assert rep["m", "none"].actual_share == 0 and abs(sum(x.actual_share for k, x in rep.items() if k[0] == "m") - 1) < 1e-9


# ---- personal data


@pytest.fixture(scope="module")
def lexicon():
    return pii.Lexicon(["Mirelle", "Haldor", "Piran"], ["Hollis"])


@pytest.mark.parametrize(
    "text,want",
    [
        ("Selon Mirelle Quillard, la chapelle", [("name", "Mirelle Quillard")]), ("Mme Orminwick, Mirelle conserve", [("name", "Orminwick, Mirelle")]), ("Dr. Z. H. Caveau said", [("name", "Z. H. Caveau")]),
        ("reg. 20055864 Haldor Dumham, 9 barns", [("name", "Haldor Dumham")]), ("HALDOR MACHASK (XK0506324)", [("name", "HALDOR MACHASK"), ("idnum", "XK0506324")]), ("Haldor Hollis de\nStavoard ran", [("name", "Haldor Hollis de\nStavoard")]), ("P.O. Harbour and 576 E. Orchard Avenue until", [("address", "576 E. Orchard Avenue")]),
        ("<a.b+c@x.example>.", [("email", "a.b+c@x.example")]), ("mail a_b [at] post [dot] mg [dot] example for", [("email", "a_b [at] post [dot] mg [dot] example")]), ("The survey @ 1977 feet was", []), ("to x(at)kartei.example, on", [("email", "x(at)kartei.example")]),
        ("Ring +33 (0)1 99 00 95 13 now", [("phone", "+33 (0)1 99 00 95 13")]), ("(204) 555-0189 le", [("phone", "(204) 555-0189")]), ("+1, my sheet from 1836", []), ("ISBN 7-1951-3976-X and 54.10.7099 and 7508-296-13", []),
        ("Health card 3 45 13 68 907 132 was", [("idnum", "3 45 13 68 907 132")]), ("no. 1069-890-715-QP was", [("idnum", "1069-890-715-QP")]), ("l'identifiant 700181099. On", []), ("ID 811746076 (copy enclosed)", [("idnum", "811746076")]), ("Hill); id 700181099; ref", []), ("The 1720 Wren Street fire destroyed", []),
        ("Return to 1218 Harrow Cres. if", [("address", "1218 Harrow Cres.")]), ("Unit 14, 948 Foundry Court", [("address", "Unit 14, 948 Foundry Court")]), ("Adresse : 35 bis, chemin Wren", [("address", "35 bis, chemin Wren")]), ("Wohnhaft Am Tanneryhof 94.", [("address", "Am Tanneryhof 94")]),
        ("Vive en Avenida del Cooper, 176.", [("address", "Avenida del Cooper, 176")]), ("", []),
    ],
)
def test_detection(lexicon, text, want):
    assert [(k, text[a:z]) for a, z, k in lexicon.spans(text)] == want


def test_empty_lexicon_still_finds_initials():
    assert pii.Lexicon([], []).spans("by C. Deloeau.") == [(3, 13, "name")]


def test_surrogates_keep_kind_and_format():
    core = pii.surrogate_core("key", "phone", "+12045550189", 0)
    assert pii.surrogate_core("key", "phone", "+12045550189", 0) == core != pii.surrogate_core("other", "phone", "+12045550189", 0)
    assert len(pii.dress("phone", "(204) 555-0189", core)) == 14 and pii.dress("phone", "+33 (0)1 99 00 95 13", core).startswith("+33 (0)")
    name = pii.surrogate_core("key", "name", "mirelle quillard", 0)
    given, family = name.split(" ")
    assert pii.dress("name", "Quillard, Mirelle", name) == f"{family}, {given}" and pii.dress("name", "MIRELLE QUILLARD", name) == name.upper() and pii.dress("name", "M. Quillard", name) == f"{given[0]}. {family}"
    assert "(at)" in pii.dress("email", "a(at)b.example", pii.surrogate_core("key", "email", "a@b.example", 0))
    assert pii.dress("address", "Am Tanneryhof 94", pii.surrogate_core("key", "address", "am tanneryhof 94", 0)).startswith("Am ")
    assert pii.canonical("name", "Quillard,\nMirelle") == pii.canonical("name", "MIRELLE  QUILLARD") and pii.canonical("phone", "+1 204 555 0189") == pii.canonical("phone", "(204) 555-0189")


def test_replacement_keeps_the_rest(spark):
    import pandas as pd

    text = "by Mirelle Quillard and Mirelle Quillard, 5"
    hits = [{"start": 3, "stop": 19, "kind": "name", "entity": "x", "core": "Anna Bell"}, {"start": 24, "stop": 40, "kind": "name", "entity": "x", "core": "Anna Bell"}]
    out = next(pii.replace_frames(iter([pd.DataFrame({"doc_id": [1, 2, 3], "text": [text, None, "plain"], "hits": [hits, None, None]})])))
    assert list(out["tagged"]) == ["by [NAME_1] and [NAME_1], 5", None, "plain"] and out["surrogate"][0] == "by Anna Bell and Anna Bell, 5"


# ---- entities


def _match(spark, scratch, places, others, countries=()):
    p = spark.createDataFrame(places, "id long, names array<string>, pos struct<lat:double,lon:double>, code string, class string, country string, other_id string")
    o = spark.createDataFrame(others, "id string, names array<string>, lat double, lon double, label string, country_qid string, place_id long")
    c = spark.createDataFrame(list(countries), "country_qid string, code string")
    return {(r.geoname_id, r.qid) for r in entity_match.match(p, o, c, scratch).collect()}


def test_entity_matching(spark, scratch):
    at = lambda la, lo: (la, lo)
    places = [
        (1, ["Lac Sorlund"], at(10.0, 20.0), "LK", "H", "AA", None), (2, ["Sorlund Lake"], at(10.01, 20.01), "LK", "H", "AA", None), (3, ["Sorlund"], at(10.0, 20.0), "PPL", "P", "AA", None),
        (4, ["Nakrylów"], at(-5.0, 179.999), "PPL", "P", "BB", None), (5, ["Farwick"], None, "PPL", "P", "BB", None), (6, ["Swapton"], at(30.0, 50.0), "PPL", "P", "BB", None), (7, [None, ""], at(1.0, 1.0), None, None, None, None), (8, ["Old Mill (historical)"], at(40.0, 40.0), None, "P", None, None),
    ]
    others = [
        ("Q1", ["lac sorlund"], 10.001, 20.001, "lake", None, None), ("Q2", ["Sorlund, Arlandia"], 10.0, 20.0, "village", None, None), ("Q3", ["Nakrylow"], -5.0, -179.999, None, None, None), ("Q4", ["Farwick"], 3.0, 3.0, "town", None, 5), ("Q5", ["Swapton"], 50.0, 30.0, "hamlet", None, None),
        ("Q6", ["Sorlund Herald"], 10.0, 20.0, "newspaper", None, None), ("Q7", ["Sorlund"], 60.0, 20.0, "village", None, None), ("Q8", [None], 1.0, 1.0, None, None, None), ("Q9", ["Farwick"], None, None, "town", None, None), ("Q10", ["Nakyrlów"], -5.001, 179.998, "village", None, None), ("Q11", ["Lac Sorlund"], 10.0, 20.0, "lake", None, 3), ("Q12", ["Fahrwieck am See"], None, None, "town", None, 5),
    ]
    assert _match(spark, scratch, places, others) == {(1, "Q1"), (3, "Q2"), (4, "Q3"), (5, "Q4"), (6, "Q5"), (4, "Q10"), (1, "Q11")}
    assert _match(spark, scratch, [], others) == set() and _match(spark, scratch, places, []) == set()


def test_close_pairs_are_exact(spark, scratch):
    r = random.Random(6)
    base = ["mount dorvik", "lake sorlund", "old teckham", "pont galero"]

    def typo(s):
        s = list(s)
        for _ in range(r.randrange(3)):
            s[r.randrange(len(s))] = r.choice("abcdef")
        return "".join(s)

    def side(n):
        return [(i, [typo(r.choice(base))], 50 + r.gauss(0, 0.02), 179.99 + r.gauss(0, 0.03)) for i in range(n)]

    mk = lambda x: entity_match.name_rows(spark.createDataFrame([(i, n) for i, n, _, _ in x], "id long, names array<string>"), F.col("names")).join(spark.createDataFrame([(i, a, o - 360 if o > 180 else o) for i, _, a, o in x], "id long, lat double, lon double"), "id")
    at = F.col("lat"), F.col("lon")
    l, o = scratch.save(mk(side(120)).withColumn("cells", F.array(entity_match.own_cell(*at)))), scratch.save(mk(side(120)).withColumn("cells", entity_match.met_cells(*at)))
    from geoweave.functions import geo

    cross = l.select(*[F.col(c).alias(f"l{c}") for c in l.columns]).crossJoin(o.select(*[F.col(c).alias(f"r{c}") for c in o.columns]))
    apart = F.bit_count(F.col("lv0").bitwiseXOR(F.col("rv0"))) + F.bit_count(F.col("lv1").bitwiseXOR(F.col("rv1")))
    want = cross.where((apart <= entity_match.APART) & (geo.haversine_km(F.col("llat"), F.col("llon"), F.col("rlat"), F.col("rlon")) <= entity_match.SPOT_KM)).select("lnid", "rnid")
    assert rows(entity_match.close_pairs(l, o, scratch).select("lnid", "rnid")) == rows(want) and want.count() > 50


def test_components_with_hot_keys_split_off(spark, scratch, monkeypatch):
    import geoweave.llm.components as c

    monkeypatch.setattr(c, "PLAIN", 0)
    edges = [(0, i) for i in range(1, 200)] + [(1000 + i, 1001 + i) for i in range(9)]
    got = rows(c.components(spark.createDataFrame(edges, "a long, b long"), scratch))
    assert got == [(i, 0) for i in range(200)] + [(1000 + i, 1000) for i in range(10)]


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_results_do_not_depend_on_partitions(spark, scratch, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        r = random.Random(9)
        edges = spark.createDataFrame([(r.randrange(80), r.randrange(80)) for _ in range(60)], "a long, b long")
        got = rows(components(edges.repartition(int(partitions)), scratch))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(label <= v for v, label in got) and len({label for _, label in got}) == sum(v == label for v, label in got)


def test_canonical_list_in_blocks(spark, tmp_path, monkeypatch):
    from geoweave.llm import queries

    d = str(tmp_path)
    spark.createDataFrame([(1, "Gánjenumba", ["x"], None, 1.0, 1.0, "AA", 5), (2, "Duvelgate", None, ["Old Gate"], 1.0, 1.0, "BB", 6), (3, "Kukiszurina", [], [], 1.0, 1.0, "AA", 7)], "geonameId long, name string, alternateNames array<string>, wikidataAlternateNames array<string>, latitude double, longitude double, countryCode string, population long").write.parquet(f"{d}/placeref.parquet")
    spark.createDataFrame([("AA", "Arlandia", "Q1")], "code string, name string, qid string").write.parquet(f"{d}/country.parquet")
    spark.createDataFrame([(1, "ganjenumba", None), (1, "ganjenumba", None), (2, "old gate", None), (3, "kukisurina", "AA"), (4, "at sea", None), (5, None, None), (None, "x", None)], "mentionId long, rawName string, countryHint string").write.parquet(f"{d}/placemention.parquet")
    want = [(1, 1), (2, 2), (3, 3), (4, 0), (5, 0)]
    assert rows(queries.p6_found(spark, d)) == want
    monkeypatch.setattr(queries, "REFERENCE_BLOCK", 1)
    assert rows(queries.p6_found(spark, d)) == want


def test_items_in_blocks(spark, tmp_path, monkeypatch):
    from geoweave.llm import queries

    d = str(tmp_path)
    spark.createDataFrame([(1, ITEM), (2, None), (3, ITEM.upper())], "item_id long, text string").write.parquet(f"{d}/evalitem.parquet")
    spark.createDataFrame([(10, "x " + ITEM + " y"), (11, None), (12, ""), (13, "nothing here")], "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    assert rows(queries.p7_found(spark, d)) == [(10, 1), (10, 3)]
    monkeypatch.setattr(queries, "ITEM_BLOCK", 1)
    assert rows(queries.p7_found(spark, d)) == [(10, 1), (10, 3)]
    assert {(r.item_id, r.documents) for r in queries.p7_leaked_items(spark, d).collect()} == {(1, 1), (3, 1)}


def persons(spark, d, names, parents=()):
    rows_ = [(f"raw:{i}", n, (None, None)) for i, n in enumerate(names)] + [(f"raw:c{i}", None, p) for i, p in enumerate(parents)]
    spark.createDataFrame(rows_, "personId string, name string, birthEvent struct<motherId:string,fatherId:string>").withColumn("loadedAt", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(f"{d}/historicalperson.parquet")


def test_surrogates_are_distinct(spark, tmp_path, monkeypatch):
    from geoweave.llm import queries

    d = str(tmp_path)
    people = [(f"Mirelle Quill{chr(97 + i)}rd",) for i in range(20)] + [("Haldor X Bell",)] * 3
    persons(spark, d, [n for n, in people])
    texts = [(i, f"by Mirelle Quill{chr(97 + i)}rd, again Quill{chr(97 + i)}rd, Mirelle.") for i in range(20)] + [(50, None), (51, "plain")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    # A tiny space of surrogates on the first draw: most collide and are drawn again.
    real = pii.surrogate_core
    monkeypatch.setattr(pii, "surrogate_core", lambda key, kind, entity, attempt, sex: "Anna Same" if attempt == 0 else real(key, kind, entity, attempt, sex))
    got = {r.doc_id: r for r in queries.p9_redacted(spark, d).collect()}
    assert len(got) == 22 and got[50].tagged is None and got[51].surrogate == "plain"
    assert all(got[i].tagged == "by [NAME_1], again [NAME_1]." for i in range(20))
    assert len({got[i].surrogate for i in range(20)}) == 20


def test_surrogates_are_distinct_as_written(spark, tmp_path, monkeypatch):
    from geoweave.llm import queries

    d = str(tmp_path)
    persons(spark, d, ["Haldor X Bell"] * 3)
    texts = [(1, "by M. Quillard."), (2, "by T. Orminwick."), (3, "at 5 Wren Lane."), (4, "at 77 Same Lane."), (5, "Ring 204-555-0189 now"), (6, "Ring +1 204 555 0133 now")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    # Cores that differ but look the same once written, or look like what really occurs.
    first = {"m. quillard": "Alma Same", "t. orminwick": "Adam Same", "5 wren lane": "77 1 A Same", "77 same lane": "78 1 A Other", "+12045550189": "20455501330000000000" + "A" * 20}
    real = pii.surrogate_core
    monkeypatch.setattr(pii, "surrogate_core", lambda key, kind, entity, attempt, sex: first.get(entity) if attempt == 0 and entity in first else real(key, kind, entity, attempt, sex))
    got = {r.doc_id: r for r in queries.p9_redacted(spark, d).collect()}
    assert [got[i].tagged for i, _ in texts] == ["by [NAME_1].", "by [NAME_1].", "at [ADDRESS_1].", "at [ADDRESS_1].", "Ring [PHONE_1] now", "Ring [PHONE_1] now"]
    assert len({got[i].surrogate for i in (1, 2)}) == 2 and got[3].surrogate not in ("at 77 Same Lane.", got[4].surrogate) and "555-0133" not in got[5].surrogate


@pytest.mark.parametrize("found", ["+33612345678", "+14165551234", "14165551234", "4165551234", "+33 (0)6 12 34 56 78", "+33 6 12 34 56 78", "+44 20 7946 0958", "+1 416 555 1234", "06 12 34 56 78", "020 7946 0958"])
def test_surrogate_of_a_phone_is_another(lexicon, found):
    assert lexicon.spans(found) == [(0, len(found), "phone")]
    out = pii.dress("phone", found, "9" * 20 + "X" * 20)
    assert out != found and len(out) == len(found) and re.fullmatch(r"\+(1|33|44)9{9,10}", pii.canonical("phone", out))
    assert out.startswith(next((c for c in ("+33", "+44", "+1") if found.startswith(c)), ""))


def test_blocks_of_the_list_rank_like_one(spark, tmp_path, monkeypatch):
    from geoweave.llm import queries

    d = str(tmp_path)
    ref = [(i, n, [], [], c, p) for i, n, c, p in [(1, "Chèmurtval", "AA", 5), (2, "Chemurtval", "BB", 1), (3, "Chemurtval", "CC", 9), (4, "Letelares Point", "AA", 9), (5, "Letelares", "BB", 1), (6, "Letelares Poimont", "CC", None), (7, "Duvelgate", None, 2), (8, "Duvelgate", None, 2), (9, "Duvelgato", "AA", 99)]]
    spark.createDataFrame(ref, "geonameId long, name string, alternateNames array<string>, wikidataAlternateNames array<string>, countryCode string, population long").write.parquet(f"{d}/placeref.parquet")
    spark.createDataFrame([("BB", "Borlandia", "Q1"), ("CC", "Corlandia", "Q2")], "code string, name string, qid string").write.parquet(f"{d}/country.parquet")
    typed = [("chemurtval", "BB"), ("chemurtval", None), ("chemurtval, Borl.", None), ("chemurtvil", "aa"), ("letelares.", None), ("Letelares Poi.", "CC"), ("Letelares Poi.", None), ("duvelgate", "AA"), ("duvelgatx", "AA"), ("at sea", "AA")]
    spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(typed)], "mentionId long, rawName string, countryHint string").write.parquet(f"{d}/placemention.parquet")
    want = list(enumerate([2, 3, 2, 1, 5, 6, 4, 7, 9, 0]))
    assert rows(queries.p6_found(spark, d)) == want
    monkeypatch.setattr(queries, "REFERENCE_BLOCK", 1)
    assert rows(queries.p6_found(spark, d)) == want


LONG = ITEM[:-1].split() + "Beyond seven willows stood another gravel quay where masons counted barrels before winter closed every sluice.".split()


@pytest.mark.parametrize("wrong", [(1, 10), (10,), (1,), (4, 10), (1, 7), (1, 2), (9, 10), (5, 6)])
@pytest.mark.parametrize("start", [0, 4, 8])
@pytest.mark.parametrize("missing", [False, True])
def test_twelve_words_with_errors_near_the_ends(items, start, wrong, missing):
    quoted = ITEM.split()[start : start + 12]
    told = " ".join("" if missing and i in wrong else "otherwise" if i in wrong else w for i, w in enumerate(quoted))
    assert items.found(f"Something else was said: {told}; nothing of it follows here") == {1: 12}
    less = " ".join(told.split()[:-1]) if 10 not in wrong else " ".join(told.split()[1:])
    assert items.found(f"Something else was said: {less}; nothing of it follows here") == {}


def test_gap_as_long_as_the_errors_allowed():
    block = leak.Items([(1, " ".join(LONG))])
    tell = lambda ws: block.found("Before that " + " ".join(ws) + " came later")
    assert tell(LONG[:10] + LONG[14:24]) == {1: 24} and tell(LONG[:10] + ["quite", "other", "terms", "here"] + LONG[14:24]) == {1: 24}
    assert tell(LONG[:9] + LONG[13:22]) == {} and tell(LONG[:10] + LONG[15:24]) == {}


def aligned(ws, text):
    """Longest passage by trying every chain of equal words; a gap costs the larger of what is passed over on either side."""
    best = 0
    at = {(i, q) for i, w in enumerate(ws) for q, t in enumerate(text) if w == t}
    for i, q in sorted(at):
        cost = {(i, q): 0}
        for k, r in sorted(at):
            if k > i and r > q:
                ways = [c + max(k - a - 1, r - b - 1) for (a, b), c in cost.items() if a < k and b < r]
                if ways:
                    cost[k, r] = min(ways)
        best = max([best, *(k - i + 1 for (k, _), c in cost.items() if 6 * c <= k - i + 1)])
    return best if best >= leak.LEAST else 0


@pytest.mark.parametrize("kind", ["changed", "missing", "between"])
def test_leaks_against_every_alignment(kind):
    r = random.Random(kind)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    hits = 0
    for _ in range(120):
        ws = [word() for _ in range(r.randrange(20, 40))]
        a = r.randrange(0, len(ws) - 12)
        told = ws[a : a + r.randrange(12, 36)]
        n, at = r.randrange(1, 6), r.randrange(1, len(told) - 1)
        told[at : at + (0 if kind == "between" else n)] = [] if kind == "missing" else [word() for _ in range(n)]
        text = [word(), word(), *told, word(), word()]
        want = aligned(ws, text)
        hits += want > 0
        assert leak.Items([(1, " ".join(ws))]).found(" ".join(text)).get(1, 0) == want, (ws, text)
    assert 20 < hits < 120


def test_leaks_in_other_scripts():
    ru = "Старая мельница у тихого пруда помнит каждого мельника который чинил её тяжёлые деревянные колёса весной"
    zh = "河邊的舊磨坊記得每一位修理過木輪的工匠"
    block = leak.Items([(1, ru), (2, zh)])
    assert block.found(f"Раньше: <b>{ru.upper()}</b>!") == {1: 15} and block.found(ru.replace("тихого", "старого")) == {1: 15} and block.found("前言。" + zh + "。後記") == {2: 19}
    assert block.found(zh[:11]) == {} and block.found(" ".join(ru.split()[:11])) == {}


def test_long_tags_and_short_patterns():
    tag = "<a href='" + "x" * 1000 + "'>"
    assert set(leak.Items([(1, ITEM), (2, "a b c d e f g h i j k l m")]).found(ITEM.replace("plain ", f"plain {tag}"))) == {1}
    many = {f"{i:020d}": None for i in range(20_000)}
    search = leak.WuManber(many | {"abcd": None})
    assert search.cuts == (4, 20) and set(search.search("xabcdx" + "0" * 19 + "7x")) == {(1, "abcd"), (6, "0" * 19 + "7")}


def test_canonical_list_in_other_scripts_and_chunks(spark, tmp_path, monkeypatch):
    from geoweave.llm import queries

    d = str(tmp_path)
    ref = [(1, "Москва", ["Moskwa"], None, "RU", 5), (2, "東京都", None, None, "JP", 9), (3, "Μόσχα Χωριό", None, None, "GR", None), (4, None, None, None, None, None), (None, "Duvelgate", None, None, None, 1)]
    spark.createDataFrame(ref, "geonameId long, name string, alternateNames array<string>, wikidataAlternateNames array<string>, countryCode string, population long").write.parquet(f"{d}/placeref.parquet")
    spark.createDataFrame([("RU", "Россия", "Q1")], "code string, name string, qid string").write.parquet(f"{d}/country.parquet")
    typed = ["МОСКВА", "Масква", "東京都", "大阪", "μοσχα χωριο", "Moskwa, Рос", "Duvelgate"]
    spark.createDataFrame([(i, t, None) for i, t in enumerate(typed)], "mentionId long, rawName string, countryHint string").write.parquet(f"{d}/placemention.parquet")
    want = list(enumerate([1, 1, 2, 0, 3, 1, 0]))
    for block, chunk in ((20_000, 2_000), (1, 1), (2, 3)):
        monkeypatch.setattr(queries, "REFERENCE_BLOCK", block)
        monkeypatch.setattr(queries, "MENTION_CHUNK", chunk)
        assert rows(queries.p6_found(spark, d)) == want


def test_every_given_name_counts(spark, tmp_path, monkeypatch):
    from geoweave.llm import queries

    d = str(tmp_path)
    persons(spark, d, ["Haldor Bell"] * 2000 + ["Wolfgang Grey", "Jo Marsh", "Дмитрий Орлов", "Aino B. Maria Hill", "Bell, Ash", "x. Odd"])
    texts = [(1, "So says Wolfgang Smith."), (2, "by JO RIVER and Bell Tower"), (3, "Спросите Дмитрий Волков дома"), (4, "Aino Maria de la Torre; Aino  Maria\nde Brook"), (5, "Wolfgang\n\nSmith"), (6, None), (7, "")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    want = [(1, "name", "Wolfgang Smith"), (2, "name", "JO RIVER"), (3, "name", "Дмитрий Волков"), (4, "name", "Aino  Maria\nde Brook"), (4, "name", "Aino Maria")]
    assert rows(queries.p9_found(spark, d)) == sorted(want)
    monkeypatch.setattr(queries, "LEXICON_MOST", 0)
    assert rows(queries.p9_found(spark, d)) == sorted(want)


def test_names_held_out_of_the_table_are_what_is_missed(spark, tmp_path):
    """Recall on given names that the person table lacks: only those with initials can be found."""
    lex = pii.Lexicon(["Haldor"], [])
    assert [t for t in ("Haldor Bell", "H. Bell", "Unheard Bell") if lex.spans(f"by {t}.")] == ["Haldor Bell", "H. Bell"]


def test_phones_of_two_areas_are_two(lexicon):
    same = [["306-555-0128", "+1 306 555 0128", "1-306-555-0128", "(306) 555-0128", "3065550128"], ["01 99 00 95 13", "+33 (0)1 99 00 95 13", "+33 1 99 00 95 13", "01.99.00.95.13"], ["020 7946 0958", "+44 20 7946 0958"]]
    assert [{pii.canonical("phone", x) for x in group} for group in same] == [{"+13065550128"}, {"+33199009513"}, {"+442079460958"}] and pii.canonical("phone", "506-555-0128") == "+15065550128"
    core = pii.surrogate_core("key", "phone", "+1", 0)
    for group in same:
        assert len({pii.canonical("phone", pii.dress("phone", x, core)) for x in group}) == 1


@pytest.mark.parametrize("found", ["Unit 12, 44 Old Mill Road", "576-B E. Orchard Avenue", "35 bis, chemin Wren", "12, rue de l'Anse", "Am Tanneryhof 94b", "Avenida del Cooper, 176"])
def test_no_part_of_an_address_stays(found):
    out = pii.dress("address", found, pii.surrogate_core("key", "address", found, 0))
    assert not set(re.findall(r"\d+", found)) & set(re.findall(r"\d+", out))
    assert not any(w in out for w in ("Old", "Mill", "Orchard", "Wren", "Anse", "Tannery", "Cooper", "-B ", "94b"))
    kept = [w for w in ("Unit", "Road", "E. ", "Avenue", " bis, chemin", "rue de l'", "Am ", "hof ", "Avenida del ") if w in found]
    assert kept and all(w in out for w in kept)


def test_letters_of_documents_and_scripts_of_names():
    assert re.fullmatch(r"(?!XK)[A-Z]{2}\d{7}", pii.dress("idnum", "XK0506324", pii.surrogate_core("key", "idnum", "XK0506324", 0)))
    assert re.fullmatch(r"[А-Я][а-я]+ [А-Я][а-я]+", pii.dress("name", "Дмитрий Волков", pii.surrogate_core("key", "name", "дмитрии волков", 0)))
    given = lambda sex: pii.surrogate_core("key", "name", "x y", 0, sex).split(" ")[0]
    assert given("f") in pii._GIVEN["f"] and given("m") in pii._GIVEN["m"] and given("") in pii._GIVEN[""]
    assert len(pii.surrogate_core("key", "name", "x y", 400)) > 200


def test_initials_follow_the_full_name_of_their_text(spark, tmp_path):
    from geoweave.llm import queries

    d = str(tmp_path)
    persons(spark, d, ["John Smith", "Jane Smith", "Mary Hill", "Carl Hill"], [("raw:2", "raw:3"), ("raw:1", "raw:0")])
    texts = [(1, "John Smith wrote; J. Smith signed."), (2, "John Smith met Jane Smith and J. Smith."), (3, "Mary Hill met Carl Hill. M. Hill left.")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    spark.conf.set(queries.SURROGATE_KEY, "secret")
    try:
        got = {r.doc_id: r for r in queries.p9_redacted(spark, d).collect()}
        assert got == {r.doc_id: r for r in queries.p9_redacted(spark, d).collect()}
    finally:
        spark.conf.unset(queries.SURROGATE_KEY)
    assert [got[i].tagged for i in (1, 2, 3)] == ["[NAME_1] wrote; [NAME_1] signed.", "[NAME_1] met [NAME_2] and [NAME_3].", "[NAME_1] met [NAME_2]. [NAME_1] left."]
    a, b = re.match(r"(\w+) (\w+) wrote; (\w\. \w+) signed", got[1].surrogate).group(1, 2), got[1].surrogate
    assert f"{a[0][0]}. {a[1]} signed" in b and a[0] in pii._GIVEN["m"]
    assert got[3].surrogate.split(" ")[0] in pii._GIVEN["f"] and re.search(r"met (\w+)", got[3].surrogate).group(1) in pii._GIVEN["m"]


@pytest.mark.skipif(not __import__("pathlib").Path("/root/testdata/sf0.001").exists(), reason="needs the small test tables")
def test_no_two_entities_share_what_is_written(spark, scratch):
    from geoweave.llm import queries

    d = "/root/testdata/sf0.001"
    hits = scratch.save(queries._entities(spark, d))
    placed = hits.join(queries._surrogates(hits, queries._sexes(spark, d), "k", scratch), ["kind", "entity"]).collect()
    assert len(placed) == hits.count() > 100
    real = {(r.kind, r.entity) for r in placed}
    owner = {}
    for r in placed:
        shown = r.kind, pii.canonical(r.kind, pii.dress(r.kind, r.found_text, r.core))
        assert shown not in real and owner.setdefault(shown, r.entity) == r.entity


def test_a_full_spot_is_cut_into_blocks(spark, scratch, monkeypatch):
    r = random.Random(8)
    names = ["".join(r.choice("abcdefgh") for _ in range(9)) for _ in range(300)]
    side = lambda n: spark.createDataFrame([(i, [names[i % 300][: 9 - i % 2]]) for i in range(n)], "id long, names array<string>")
    mk = lambda n: scratch.save(entity_match.name_rows(side(n), F.col("names")).withColumns({"lat": F.lit(1.0), "lon": F.lit(1.0)}).withColumn("cells", F.array(entity_match.own_cell(F.col("lat"), F.col("lon")))))
    left, right = mk(600), mk(450)
    whole = rows(entity_match.close_pairs(left, right, scratch))
    monkeypatch.setattr(entity_match, "BLOCK", 40)
    assert rows(entity_match.close_pairs(left, right, scratch)) == whole and len(whole) >= 900


def test_shares_meet_their_targets_within_a_document(spark, scratch):
    """While no source runs out, every source is served to within two documents of its weight at any time."""
    r = random.Random(11)
    docs = [(i, "abcd"[i % 4] if i % 3 else "a", r.randrange(1, 400)) for i in range(4000)]
    goals = [("m", s, w, "percent", 3, 0.4) for s, w in zip("abcd", (10.0, 20.0, 30.0, 40.0))] + [("n", "a", 1.0, "fraction", 9, 1.5), ("n", "b", 3.0, "fraction", 9, 1.5)]
    g = spark.createDataFrame(goals, "mix string, source string, weight double, unit string, max_repeats int, size_factor double")
    chosen, t, _ = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, tokens long").repartition(3), g, scratch)
    for mix, weights, factor in (("m", {"a": 0.1, "b": 0.2, "c": 0.3, "d": 0.4}, 0.4), ("n", {"a": 0.25, "b": 0.75}, 1.5)):
        got = sorted((x.finish, x.source, x.doc_id, x["copy"], x.tokens, x.upto) for x in chosen.where(F.col("mix") == mix).collect())
        whole, served = 0, dict.fromkeys(weights, 0)
        for _, s, _, _, n, upto in got:
            whole, served[s] = whole + n, served[s] + n
            assert upto == whole and all(abs(served[k] - w * whole) <= 800 for k, w in weights.items())
        budget = int(factor * sum(d[2] for d in docs))
        assert budget - 400 < whole <= budget
    for x in mixing.shares(chosen, t).collect():
        assert abs(x.actual_share - x.target_share) < 0.01
