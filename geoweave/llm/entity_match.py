"""Matching places across two sources that share no dependable identifier.

1. Every name and alias of either source becomes a fixed bit vector of its word
   q-grams (117 bits in 13 chunks of 9).
2. Multi-index Hamming hashing: vectors at most 12 bits apart agree in at least
   one of the 13 chunks, so an equi-join on (spot cell, chunk number, chunk
   value) finds every close pair exactly; a pair is kept only at its first
   common chunk.  The spot cell is a second index: each vector of the larger
   source has one cell, each of the other the four cells its circle can meet.
   A cell that holds very many vectors is cut into blocks on either side.
3. Field-weighted Dice scores of name, spot, sort and country are calibrated
   against stored identifiers, noisy as they are, by isotonic regression.
4. A pair needs a calibrated confidence of ``ACCEPT`` and has to pass an exact
   check on spelling, sort and distance.

Where a record has no usable position, its spot cell is the pair of records
that a stored identifier names; all other steps are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.functions import geo, ids
from geoweave.functions.ids import let
from geoweave.llm.components import unique_join
from geoweave.runtime import Scratch, fold

#: Chunks of a vector, bits of a chunk, bits two vectors may differ in (one less than the chunks).
CHUNKS, BITS, APART = 13, 9, 12
#: Chunks that a long holds.
_PER = 7
#: Least calibrated confidence of a match.
ACCEPT = 0.05
#: Vectors of one side of a cell that one task compares at most.
BLOCK = 10_000
#: Two records of one thing lie at most this far apart; less where the spelling differs.
SPOT_KM, NEAR_KM, CLOSE_KM = 3.5, 2.5, 1.5
#: Largest share of letters in which two spellings of one name differ.
SPELLING, SPELLING_NEAR = 0.3, 0.15
#: Height of a spot cell in degrees: at least twice SPOT_KM.
_CELL = 0.064

# Words of names that tell what kind of thing it is.
_WORDS = {
    "chapel": "CH", "church": "CH", "eglise": "CH", "gare": "RSTN", "halt": "RSTN", "station": "RSTN", "old": "PPLH", "historical": "PPLH", "academy": "SCH", "school": "SCH",
    "north": "PPLX", "lower": "PPLX", "heights": "PPLX", "east": "PPLX", "farm": "FRM", "grange": "FRM", "bridge": "BDG", "pont": "BDG", "hill": "MT", "mount": "MT",
    "pic": "MT", "po": "PO", "post": "PO", "river": "STM", "brook": "STM", "rio": "STM", "lake": "LK", "lac": "LK", "st": "",
}
# Feature codes that the kinds of the other source correspond to.
_KINDS = {
    "village": "PPL", "hamlet": "PPL", "town": "PPL", "human settlement": "PPL", "city": "PPLA", "neighbourhood": "PPLX", "ghost town": "PPLH", "municipality": "ADM3",
    "post office": "PO", "school": "SCH", "church building": "CH", "bridge": "BDG", "railway station": "RSTN", "farm": "FRM", "lake": "LK", "river": "STM", "mountain": "MT",
}
# Abbreviated words of names and what they stand for.
_SHORT = {"saint": "st", "mt": "mount", "stn": "station", "sta": "station", "l": "lake", "r": "river"}
# Sorts of each feature class.
_CLASSES = {"P": "PPL PPLA PPLX PPLH", "A": "ADM3", "S": "PO SCH CH BDG RSTN FRM", "H": "LK STM", "T": "MT"}
_CODES = sorted({v for v in _WORDS.values() if v} | set(_KINDS.values()))


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def tokens(name: Column) -> Column:
    """Plain words of a name; a country behind a comma or in brackets is no part of it."""
    s = F.regexp_replace(fold(name), r"p\.\s?o\.", "po ")
    s = F.substring_index(F.regexp_replace(s, r"\((?!historical)[^)]*\)", " "), ",", 1)
    t = F.split(F.trim(F.regexp_replace(s, r"[^a-z0-9]+", " ")), " ")
    return F.transform(F.filter(t, lambda x: ~x.isin("", "de", "office")), lambda x: F.coalesce(F.try_element_at(_map(_SHORT), x), x))


def gram_bits(toks: Column) -> Column:
    """Bit numbers of the hashed q-grams (q = 2) of the padded words, distinct."""
    grams = F.flatten(F.transform(toks, lambda t: let(F.concat(F.lit("^"), t, F.lit("$")), lambda y: F.transform(F.sequence(F.lit(1), F.length(y) - 1), lambda i: F.substr(y, i, F.lit(2))))))
    return F.array_distinct(F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(CHUNKS * BITS))))


def packed(bits: Column, k: int) -> Column:
    """Long k of the vector: its chunks 7 k to 7 k + 6."""
    half = _PER * BITS
    here = F.filter(bits, lambda x: (x >= half * k) & (x < half * k + half))
    return F.aggregate(here, F.lit(0).cast("long"), lambda a, x: a + F.call_function("shiftleft", F.lit(1).cast("long"), (x - half * k).cast("int")))


def name_rows(records: DataFrame, names: Column) -> DataFrame:
    """One row per record and distinct spelling: id, toks-derived columns, vector."""
    r = records.select("id", F.explode(F.array_distinct(F.transform(F.array_compact(names), tokens))).alias("toks")).where(F.size("toks") > 0)
    r = r.withColumn("bits", gram_bits(F.col("toks")))
    return r.select(
        "id", F.array_join("toks", "").alias("flat"), F.array_join(F.array_sort("toks"), "").alias("sorted"),
        F.array_join(F.array_sort(F.array_intersect("toks", F.array(*[F.lit(w) for w in _WORDS]))), " ").alias("kindwords"),
        packed(F.col("bits"), 0).alias("v0"), packed(F.col("bits"), 1).alias("v1"),
    ).withColumn("nid", F.monotonically_increasing_id())


def kind_of_words(c: Column) -> Column:
    """Sort told by the words of a name if they agree, else null."""
    got = F.array_distinct(F.filter(F.transform(F.split(c, " "), lambda w: F.try_element_at(_map(_WORDS), w)), lambda x: x.isNotNull() & (x != "")))
    return F.when(F.size(got) == 1, F.get(got, F.lit(0)))


def _band(lat: Column) -> Column:
    return F.floor((lat + 90) / _CELL)


def _across(band: Column) -> Column:
    """Cells of a latitude band; each at least _CELL wide on the ground."""
    edge = F.greatest(F.abs(band * _CELL - 90), F.abs((band + 1) * _CELL - 90))
    return F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(F.least(edge, F.lit(90.0)))) / _CELL)).cast("long")


def own_cell(lat: Column, lon: Column) -> Column:
    b = _band(lat)
    n = _across(b)
    return F.xxhash64(b, F.pmod(F.floor((lon + 180) / 360 * n), n))


def met_cells(lat: Column, lon: Column) -> Column:
    """The up to four cells that hold every point within half a cell."""
    y = (lat + 90) / _CELL
    bands = F.array(F.floor(y), F.when(y - F.floor(y) < 0.5, F.floor(y) - 1).otherwise(F.floor(y) + 1))

    def columns(b: Column) -> Column:
        n = _across(b)
        x = (lon + 180) / 360 * n
        side = F.when(x - F.floor(x) < 0.5, F.floor(x) - 1).otherwise(F.floor(x) + 1)
        return F.array(F.xxhash64(b, F.pmod(F.floor(x), n)), F.xxhash64(b, F.pmod(side, n)))

    return F.array_distinct(F.flatten(F.transform(bands, columns)))


def _chunk(v: list[Column], c: int) -> Column:
    return F.shiftright(v[c // _PER], BITS * (c % _PER)).bitwiseAND(F.lit((1 << BITS) - 1))


def _buckets(df: DataFrame, p: str) -> DataFrame:
    """One narrow row per vector, cell, block and chunk: bucket key, chunk number, row number, vector."""
    v = [F.col("v0"), F.col("v1")]
    df = df.select("row", "v0", "v1", "cell", "lblock", "rblock", F.posexplode(F.array(*[_chunk(v, c).cast("int") for c in range(CHUNKS)])).alias("chunk", "value"))
    return df.select(F.xxhash64("cell", "lblock", "rblock", "chunk", "value").alias("bucket"), F.col("chunk").cast("byte").alias(f"{p}chunk"), *[F.col(c).alias(f"{p}{c}") for c in ("row", "v0", "v1")])


def close_pairs(left: DataFrame, right: DataFrame, scratch: Scratch) -> DataFrame:
    """(lnid, rnid, km, dice): name vectors at most APART bits and spots at most SPOT_KM apart.

    Both sides have nid, v0, v1, lat, lon and cells; the right may repeat a nid
    with several positions.  Pairs without positions have km null and rest on
    their cell alone.  Exact: no pair within both limits and with a common cell
    is missed.  Bucket rows carry only the vector and a row number; spots are
    looked up for the pairs whose vectors are close.
    """
    cols = ["nid", "v0", "v1", "lat", "lon"]
    l = scratch.save(left.select(*cols, "cells").withColumn("row", F.monotonically_increasing_id()), "left")
    r = scratch.save(right.select(*cols, "cells").withColumn("row", F.monotonically_increasing_id()), "right")
    lc = l.select("row", "v0", "v1", F.explode("cells").alias("cell"))
    rc = scratch.save(r.select("row", "v0", "v1", F.explode("cells").alias("cell")), "cells")
    # Cells that both sides reach, with the blocks that either side is cut into.
    blocks = lambda df, to: df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(to))
    met = scratch.save(blocks(lc, "lblocks").join(blocks(rc, "rblocks"), "cell"), "met")
    mine = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = _buckets(unique_join(lc, met, "cell").withColumn("lblock", mine("lblocks")).withColumn("rblock", every("rblocks")), "l")
    b = _buckets(unique_join(rc, met, "cell").withColumn("rblock", mine("rblocks")).withColumn("lblock", every("lblocks")), "r")
    m = a.join(b, "bucket").where(F.col("lchunk") == F.col("rchunk"))
    x = [F.col(f"lv{k}").bitwiseXOR(F.col(f"rv{k}")) for k in range(2)]
    first = F.lit(None).cast("int")
    for c in reversed(range(CHUNKS)):
        first = F.when(_chunk(x, c) == 0, F.lit(c)).otherwise(first)
    m = m.where((F.bit_count(x[0]) + F.bit_count(x[1]) <= APART) & (F.col("lchunk") == first)).select("lrow", "rrow")
    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}{c}") for c in ("row", *cols)])
    m = m.join(side(l, "l"), "lrow").join(side(r, "r"), "rrow")
    ones = lambda f: f(0) + f(1)
    both = ones(lambda k: F.bit_count(F.col(f"lv{k}").bitwiseAND(F.col(f"rv{k}"))))
    size = ones(lambda k: F.bit_count(F.col(f"lv{k}")) + F.bit_count(F.col(f"rv{k}")))
    km = geo.haversine_km(F.col("llat"), F.col("llon"), F.col("rlat"), F.col("rlon"))
    m = m.select("lnid", "rnid", km.alias("km"), F.coalesce(F.try_divide(2.0 * both, size), F.lit(0.0)).alias("dice"))
    return m.where(F.col("km").isNull() | (F.col("km") <= SPOT_KM)).groupBy("lnid", "rnid").agg(F.min("km").alias("km"), F.max("dice").alias("dice"))


def _sorts(left_words: Column, right_words: Column) -> Column:
    """Whether two records are of the same sort; columns code, class, label of the pair."""
    known = F.when(F.col("label").isNotNull(), F.coalesce(F.try_element_at(_map(_KINDS), F.col("label")), F.lit("other")))
    w = F.coalesce(known, kind_of_words(right_words))
    p = F.coalesce(F.when(F.col("code").isin(_CODES), F.col("code")), kind_of_words(left_words))
    of_class = F.coalesce(F.array_contains(F.split(F.try_element_at(_map(_CLASSES), F.col("class")), " "), w), F.col("class").isNull())
    plain = p.isin("PPL", "PPLA", "ADM3") | (p.isNull() & F.coalesce(F.col("class").isin("P", "A"), F.lit(True)))
    return F.when(w.isNull(), plain | (F.col("spelling") <= 0.25)).when(p.isNull(), of_class & (w != "other")).otherwise(w == p)


def match(places: DataFrame, others: DataFrame, countries: DataFrame, scratch: Scratch) -> DataFrame:
    """(geoname_id, qid, confidence, km, spelling) of the pairs that are one real place.

    ``places``: id, names, position struct pos, code, class, country, other_id.
    ``others``: id, names, lat, lon, label, country_qid, place_id.  Null or empty
    names never match; records in force only, one row each.  One qid belongs to
    at most one place: of several that pass, the most alike; one place may have
    more than one qid.
    """
    p = scratch.save(places, "places")
    o = scratch.save(others, "others")
    pn = scratch.save(name_rows(p.select("id", "names"), F.col("names")), "names")
    on = scratch.save(name_rows(o.select("id", "names"), F.col("names")), "othernames")
    ppos = p.where("pos is not null").select("id", "pos.lat", "pos.lon")
    right = F.struct("lat", "lon")
    swapped = F.struct(F.col("lon").alias("lat"), F.col("lat").alias("lon"))
    ok = lambda la, lo: F.coalesce(geo.valid_position(la, lo), F.lit(False))
    both = F.array_compact(F.array(F.when(ok(F.col("lat"), F.col("lon")), right), F.when(ok(F.col("lon"), F.col("lat")), swapped)))
    opos = o.select("id", F.inline(both))
    # Where a position is missing, only a stored identifier can lead to the other record.
    by_id = o.select(F.col("id").alias("qid"), F.col("place_id").alias("gid")).where("gid is not null").unionByName(p.select(F.col("other_id").alias("qid"), F.col("id").alias("gid")).where("qid is not null")).distinct()
    led = unique_join(by_id, p.select(F.col("id").alias("gid"), F.col("pos").isNull().alias("pm")), "gid")
    led = unique_join(led, o.select(F.col("id").alias("qid"), (F.size(both) == 0).alias("om")), "qid").where("pm or om")
    led = scratch.save(led.select("gid", "qid", F.array(F.xxhash64(F.lit("id"), "gid", "qid")).alias("cells"), *[F.lit(None).cast("double").alias(c) for c in ("lat", "lon")]), "led")
    named = lambda df, names, key: names.join(df.withColumnRenamed(key, "id"), "id")
    cols = ["nid", "v0", "v1", "lat", "lon", "cells"]
    left = pn.join(ppos.withColumn("cells", F.array(own_cell(F.col("lat"), F.col("lon")))), "id").select(*cols).unionByName(named(led, pn, "gid").select(*cols))
    right = on.join(opos.withColumn("cells", met_cells(F.col("lat"), F.col("lon"))), "id").select(*cols).unionByName(named(led, on, "qid").select(*cols))
    pair = scratch.save(close_pairs(left, right, scratch), "close")
    side = lambda df, s: df.select(*[F.col(c).alias(f"{s}{c}") for c in ("nid", "id", "flat", "sorted", "kindwords")])
    pair = pair.join(side(pn, "l"), "lnid").join(side(on, "r"), "rnid").where((F.col("lkindwords") == F.col("rkindwords")) | (F.col("lkindwords") == "") | (F.col("rkindwords") == ""))
    lev = F.least(
        F.levenshtein("lflat", "rflat") / F.greatest(F.length("lflat"), F.length("rflat")),
        F.levenshtein("lsorted", "rsorted") / F.greatest(F.length("lsorted"), F.length("rsorted")),
    )
    pair = pair.withColumn("spelling", lev).where(F.col("spelling") <= SPELLING)
    pair = pair.join(p.select(F.col("id").alias("lid"), "code", "class", "country"), "lid").join(o.select(F.col("id").alias("rid"), "label", "country_qid", "place_id"), "rid")
    pair = pair.where(_sorts(F.col("lkindwords"), F.col("rkindwords")))
    best = pair.groupBy("lid", "rid").agg(
        F.min("km").alias("km"), F.min("spelling").alias("spelling"), F.max("dice").alias("dice"),
        F.max("country").alias("country"), F.max("country_qid").alias("country_qid"), F.max("place_id").alias("place_id"),
    )
    best = best.join(countries.select("country_qid", F.col("code").alias("ccode")).distinct(), "country_qid", "left")
    same = F.when(F.col("country").isNull() | F.col("ccode").isNull(), 0.5).otherwise((F.col("country") == F.col("ccode")).cast("double"))
    score = 0.6 * F.col("dice") + 0.3 * F.coalesce(F.exp(-F.col("km") / 2), F.lit(0.5)) + 0.1 * same
    best = scratch.save(best.withColumn("score", score), "scored")
    limit = F.when(F.col("spelling") == 0, SPOT_KM).when(F.col("spelling") <= SPELLING_NEAR, NEAR_KM).otherwise(CLOSE_KM)
    sure = best.withColumn("confidence", calibrated(best, F.col("score"))).where(F.col("confidence") >= ACCEPT)
    passed = sure.where(F.col("km").isNull() | (F.col("km") <= limit))
    one = passed.groupBy("rid").agg(F.max_by(F.struct("lid", "confidence", "km", "spelling"), F.struct("score", -F.col("lid"))).alias("b")).select("rid", "b.*")
    return one.select(F.col("lid").alias("geoname_id"), F.col("rid").alias("qid"), "confidence", "km", "spelling")


def calibrated(scored: DataFrame, score: Column, bins: int = 20) -> Column:
    """Confidence of a score: isotonic regression of agreement with stored identifiers.

    All scored pairs whose record stores an identifier are counted, in ``bins``
    bins; the 20 counts are fitted on the driver.  Stored identifiers are partly
    wrong, so agreement understates the truth a little.
    """
    b = F.least(F.lit(bins - 1), F.floor(F.col("score") * bins)).cast("int")
    rows = scored.where("place_id is not null").groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("place_id") == F.col("lid")).alias("y")).collect()
    got = {r.b: (r.y, r.n) for r in rows}
    blocks: list[list[float]] = []
    for i in range(bins):
        y, n = got.get(i, (0, 0))
        # A weak prior along the diagonal fills bins without labels.
        blocks.append([y + 2 * (i + 0.5) / bins, n + 2, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] > blocks[-1][0] / blocks[-1][1]:
            y2, n2, w2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y2, blocks[-1][1] + n2, blocks[-1][2] + w2]
    fitted = [y / n for y, n, w in blocks for _ in range(int(w))]
    return F.get(F.array(*[F.lit(round(v, 4)) for v in fitted]), F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(score * bins))).cast("int"))
