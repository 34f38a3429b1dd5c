"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweave.functions import geo, ids
from geoweave.llm import canonical, entity_match, leak, mixing, pii
from geoweave.llm.components import components, star_edges
from geoweave.plans import base
from geoweave.runtime import Scratch, in_force, table

#: Entries of the canonical list and mentions that one task holds at a time.
REFERENCE_BLOCK, MENTION_CHUNK = 20_000, 2_000
#: Evaluation items searched in one pass over the documents (about 8 kB of tables each).
ITEM_BLOCK = 20_000
#: A rank file of a public tokenizer; the driver reads it and sends it along.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Session setting that holds the secret key of the surrogates; without one each run draws its own.
SURROGATE_KEY = "spark.geoweave.surrogateKey"
#: Names sent to the executors as one set; with more, the documents' words meet the names in a join.
LEXICON_MOST = 1_000_000


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that are one real place, with calibrated confidence, distance and spelling difference."""
    none = F.array().cast("array<string>")
    p = in_force(table(spark, d, "place"), "geonameId", ["name", "asciiName", "alternateNames", "wikidataAlternateNames", "location", "latitude", "longitude", "featureClass", "featureCode", "countryCode", "wikidataId"])
    code = lambda c: F.when(F.trim(c) != "", F.upper(F.trim(c)))
    places = p.select(
        F.col("geonameId").alias("id"), F.concat(F.array("name", "asciiName"), F.coalesce("alternateNames", none), F.coalesce("wikidataAlternateNames", none)).alias("names"),
        geo.position(F.col("location"), F.col("latitude"), F.col("longitude")).alias("pos"), code(F.col("featureCode")).alias("code"), code(F.col("featureClass")).alias("class"),
        code(F.col("countryCode")).alias("country"), ids.qid(F.col("wikidataId")).alias("other_id"),
    )
    w = in_force(table(spark, d, "wikidataplace"), "qid", ["name", "alternateNames", "officialNames", "latitude", "longitude", "instanceOfLabel", "countryQid", "geonamesId"])
    others = w.select(
        F.col("qid").alias("id"), F.concat(F.array("name"), F.coalesce("alternateNames", none), F.coalesce("officialNames", none)).alias("names"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        F.when(F.trim("instanceOfLabel") != "", F.lower(F.trim("instanceOfLabel"))).alias("label"), ids.qid(F.col("countryQid")).alias("country_qid"),
        ids.gazetteer_id(F.regexp_replace("geonamesId", r"\.0+$", "")).alias("place_id"),
    )
    countries = table(spark, d, "country").select(ids.qid(F.col("qid")).alias("country_qid"), F.upper(F.trim("code")).alias("code"))
    return entity_match.match(places, others, countries, Scratch(spark, "p1"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of places and entities that are one real-world thing."""
    return p1_matches(spark, d).select("geoname_id", "qid")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of person records linked by QID, VIAF id or a judgement."""
    scratch = Scratch(spark, "p5")
    raw = table(spark, d, "historicalperson").withColumn("personId", ids.person_id(F.col("personId")))
    p = in_force(raw, "personId", ["wikidataQid", "viafId"])
    # Sorted before numbering: vertex order is the byte order of the ids.
    v = scratch.save(p.sort("personId").withColumn("vid", F.monotonically_increasing_id()), "persons")
    own = F.col("personId")
    keys = F.array_distinct(F.array_compact(F.array(
        F.concat(F.lit("q"), ids.qid(F.col("wikidataQid"))),
        F.concat(F.lit("q"), F.when(own.startswith("wd:"), ids.qid(own))),
        F.concat(F.lit("v"), ids.number_id(F.col("viafId"))),
        F.concat(F.lit("v"), F.when(own.startswith("viaf:"), ids.number_id(own))),
    )))
    shared = star_edges(v.select("vid", F.explode(keys).alias("key")), scratch)
    j = table(spark, d, "personmatch")
    l, r = ids.person_id(F.col("leftPersonId")), ids.person_id(F.col("rightPersonId"))
    j = j.select(F.least(l, r).alias("pa"), F.greatest(l, r).alias("pb"), "verdict", "judgedAt", "matchId").where("pa <> pb")
    last = j.groupBy("pa", "pb").agg(F.max_by(F.lower(F.trim("verdict")), F.struct("judgedAt", "matchId")).alias("verdict")).where("verdict = 'match'")
    pa, pb = v.select(F.col("personId").alias("pa"), F.col("vid").alias("a")), v.select(F.col("personId").alias("pb"), F.col("vid").alias("b"))
    judged = last.join(pa, "pa").join(pb, "pb").select("a", "b")
    label = scratch.save(components(shared.unionByName(judged), scratch), "labels")
    names = v.select("vid", F.col("personId").alias("person_id"))
    heads = v.select(F.col("vid").alias("label"), F.col("personId").alias("group_id"))
    return label.join(names, "vid").join(heads, "label").select("person_id", "group_id")


def _p6(spark: SparkSession, d: str) -> DataFrame:
    """(mention_id, geoname_id, distance): every chunk of mentions meets every block of the list.

    Neither side comes to the driver, no task holds more than a block and a chunk.
    """
    raw = table(spark, d, "placemention").where("mentionId is not null")
    m = raw.groupBy(F.col("mentionId").alias("mention_id")).agg(F.min(F.struct(F.col("rawName").alias("raw"), F.col("countryHint").alias("hint"))).alias("m")).select("mention_id", "m.raw", "m.hint")
    none = F.array().cast("array<string>")
    names = F.array_compact(F.concat(F.array("name"), F.coalesce("alternateNames", none), F.coalesce("wikidataAlternateNames", none)))
    ref = table(spark, d, "placeref").where("geonameId is not null").select("geonameId", "countryCode", F.coalesce("population", F.lit(0)).cast("long").alias("population"), names.alias("names"))
    countries = [tuple(r) for r in table(spark, d, "country").select("code", "name").collect()]
    blocks, chunks = max(1, -(-ref.count() // REFERENCE_BLOCK)), max(1, -(-raw.count() // MENTION_CHUNK))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part_of = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = lambda df: df.repartition(parts, "block", "chunk").groupBy("block", "chunk")
    left = m.withColumn("chunk", part_of("mention_id", chunks)).withColumn("block", every(blocks))
    right = ref.withColumn("block", part_of("geonameId", blocks)).withColumn("chunk", every(chunks))
    out = spread(left).cogroup(spread(right)).applyInPandas(canonical.search_groups(countries), "mention_id long, geoname_id long, distance int, completed boolean, elsewhere boolean, population long")
    if blocks == 1:
        return out.select("mention_id", "geoname_id", "distance")
    # The whole key by which one block ranks its entries.
    rank = F.struct(F.when(F.col("distance") < 0, 99).otherwise(F.col("distance")), "completed", "elsewhere", -F.col("population"), "geoname_id")
    return out.groupBy("mention_id").agg(F.min_by(F.struct("geoname_id", "distance"), rank).alias("x")).select("mention_id", "x.*")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The canonical entry each mention means, 0 if none."""
    return _p6(spark, d).select("mention_id", "geoname_id")


def _p7(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text").where("text is not null")
    items = table(spark, d, "evalitem").select("item_id", "text").where("text is not null")
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    out = None
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        got = docs.mapInPandas(leak.leak_frames([tuple(r) for r in part.collect()]), "doc_id long, item_id long, words int")
        out = got if out is None else out.unionByName(got)
    return out


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of an evaluation item, with the item."""
    return _p7(spark, d).select("doc_id", "item_id")


def p7_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    """Per leaked item: in how many documents, and the longest passage in words."""
    return _p7(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("words").alias("longest"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    import public_tokenizers

    with open(TOKENIZER, "rb") as f:
        ranks = f.read()
    docs = table(spark, d, "documents").select("doc_id", mixing.source_name(F.col("source")).alias("source"), "text")
    sized = docs.mapInPandas(mixing.token_frames(ranks, public_tokenizers.PATTERN), "doc_id long, source string, tokens long")
    return mixing.mix(sized, table(spark, d, "mixtarget"), Scratch(spark, "p8"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixtures: one row per chosen copy of a document, with its virtual finish time."""
    return _mixed(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of every source in every mix."""
    chosen, t, _ = _mixed(spark, d)
    return mixing.shares(chosen, t)


def _given(name: Column) -> Column:
    """Words of a name before the family name."""
    own = F.when(name.contains(","), F.substring_index(name, ",", -1)).otherwise(F.regexp_replace(name, r"\s+\S+\s*$", ""))
    return F.split(F.trim(own), r"\s+")


def _lexicon(spark: SparkSession, d: str) -> DataFrame:
    """(first, w): every given and middle name of the person table, distinct, spelled as in a text.

    Words that stand as family name more than twenty times as often as first are no given name.
    """
    p = table(spark, d, "historicalperson").where("name is not null").select("name")
    family = F.trim(F.when(F.col("name").contains(","), F.substring_index("name", ",", 1)).otherwise(F.regexp_extract("name", r"(\S+)\s*$", 1)))
    tok = p.select(F.posexplode(F.concat(F.array(family), _given(F.col("name")))).alias("pos", "w"))
    tok = tok.withColumn("w", F.when(F.col("w") == F.upper("w"), F.initcap("w")).otherwise(F.col("w")))
    tok = tok.where(F.col("w").rlike(r"^\p{Lu}[\p{L}\p{M}'’-]*[\p{L}\p{M}]$") & ~F.lower("w").isin("van", "von", "de", "du"))
    n = tok.groupBy("w").agg(*[F.count_if(c).alias(a) for c, a in ((F.col("pos") == 0, "family"), (F.col("pos") == 1, "given"), (F.col("pos") > 1, "middle"))])
    kinds = F.array(F.when((F.col("given") > 0) & (F.col("given") * 20 >= F.col("family")), True), F.when(F.col("middle") > 0, False))
    return n.select(F.explode(F.array_compact(kinds)).alias("first"), "w")


def _entities(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text").where("text is not null")
    schema = "doc_id long, start int, stop int, kind string, found_text string, entity string"
    lex = Scratch(spark, "p9names").save(_lexicon(spark, d), "names")
    if lex.count() <= LEXICON_MOST:
        rows = lex.collect()
        return docs.mapInPandas(pii.find_frames([r.w for r in rows if r.first], [r.w for r in rows if not r.first]), schema)
    words = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\p{Lu}[\p{L}\p{M}'’-]*[\p{L}\p{M}])"), F.lit(1)))).alias("t"))
    met = words.withColumn("w", F.when(F.col("t") == F.upper("t"), F.initcap("t")).otherwise(F.col("t"))).join(lex, "w")
    own = met.groupBy("doc_id").agg(F.collect_set(F.when(F.col("first"), F.col("t"))).alias("given"), F.collect_set(F.when(~F.col("first"), F.col("t"))).alias("middle"))
    return docs.join(own, "doc_id", "left").mapInPandas(pii.find_frames(None, None), schema)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in documents, by kind, as it stands in the text."""
    return _entities(spark, d).select("doc_id", "kind", "found_text").distinct()


def _sexes(spark: SparkSession, d: str) -> DataFrame:
    """(given, sex): given names that nine in ten of the known mothers or fathers who bear them agree on."""
    p = in_force(table(spark, d, "historicalperson").withColumn("personId", ids.person_id(F.col("personId"))), "personId", ["name", "birthEvent"])
    parent = lambda field, sex: p.select(ids.person_id(F.col(f"birthEvent.{field}")).alias("personId"), F.lit(sex).alias("sex")).where("personId is not null").distinct()
    known = parent("motherId", "f").unionByName(parent("fatherId", "m")).join(p.select("personId", F.lower(F.get(_given(F.col("name")), F.lit(0))).alias("given")), "personId")
    n = known.where("given is not null").groupBy("given").agg(F.count_if(F.col("sex") == "f").alias("f"), F.count(F.lit(1)).alias("n"))
    return n.select("given", F.when(F.col("f") >= 0.9 * F.col("n"), "f").when(F.col("f") <= 0.1 * F.col("n"), "m").alias("sex")).where("sex is not null")


def _surrogates(hits: DataFrame, sexes: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, entity, core): dressed in the formats an entity is found in, no core gives what another entity gets or a real one.

    Compared is the canonical form of what is written.  Where two entities drew
    the same, or one drew a real entity, all but the first draw again until none
    collide; the space of surrogates grows with the attempts.
    """
    forms = hits.select("kind", "entity", F.col("found_text").alias("found")).distinct()
    own = hits.where("kind = 'name'").select("kind", "entity").distinct().withColumn("given", F.substring_index("entity", " ", 1)).join(sexes, "given").select("kind", "entity", "sex")
    forms = scratch.save(forms.join(own, ["kind", "entity"], "left"), "forms")
    known = forms.select("kind", F.col("entity").alias("shown")).distinct()
    draw = lambda df: df.mapInPandas(pii.draw_frames(key), "kind string, entity string, sex string, found string, attempt int, core string, shown string")
    cur = scratch.save(draw(forms.withColumn("attempt", F.lit(0))), "draw")
    while True:
        firsts = cur.groupBy("kind", "shown").agg(F.min("entity").alias("first"), F.max("entity").alias("last")).where("first <> last").drop("last")
        bad = cur.join(firsts, ["kind", "shown"]).where(F.col("entity") != F.col("first")).select("kind", "entity")
        real = cur.join(known, ["kind", "shown"], "left_semi").select("kind", "entity")
        again = scratch.save(bad.unionByName(real).distinct(), "again")
        if again.isEmpty():
            return cur.select("kind", "entity", "core").distinct()
        redo = draw(cur.join(again, ["kind", "entity"], "left_semi").select("kind", "entity", "sex", "found", (F.col("attempt") + 1).cast("int").alias("attempt")))
        cur = scratch.save(cur.join(again, ["kind", "entity"], "left_anti").unionByName(redo), "draw")


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every document with typed placeholders (tagged) and with keyed surrogates (surrogate).

    Surrogates are drawn per distinct entity over all documents.  Their key is
    the session's secret; where it sets none, a random one serves this run only.
    """
    scratch = Scratch(spark, "p9")
    key = spark.conf.get(SURROGATE_KEY, None) or secrets.token_hex(32)
    hits = scratch.save(_entities(spark, d), "hits")
    placed = hits.join(_surrogates(hits, _sexes(spark, d), key, scratch), ["kind", "entity"])
    lists = placed.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop", "kind", "entity", "core")).alias("hits"))
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.join(lists, "doc_id", "left").mapInPandas(pii.replace_frames, "doc_id long, tagged string, surrogate string")


QUERIES = {
    "p1_found": p1_found,
    "p1_matches": p1_matches,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_leaked_items": p7_leaked_items,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_redacted": p9_redacted,
}
_VIAF = "nullif(regexp_extract(regexp_replace(regexp_replace({x}, '[<>\\s]', '', 'g'), '/+$', ''), '(?:^|[^0-9])0*([1-9][0-9]*)$', 1), '')"
ORACLES: dict[str, str] = {
    "p5_found": base.with_views(f"""with recursive v as (select personId, {_VIAF.format(x="viafId")} v from (select personId, viafId, row_number() over (partition by personId order by loadedAt desc) r from historicalperson) where r = 1),
 k as (select distinct personId, key from (select personId, 'q' || wikidataQid key from {{h}} union all select personId, 'q' || substr(personId, 4) from h where personId like 'wd:%' union all select personId, 'v' || v from v
 union all select personId, 'v' || substr(personId, 6) from v where personId like 'viaf:%'
 union all select unnest([a, b]), 'm' || matchId from (select *, row_number() over (partition by a, b order by judgedAt desc, matchId desc) r from {{pair}}) where r = 1 and lower(trim(verdict)) = 'match' and a in (select personId from h) and b in (select personId from h)) where key is not null),
 g as (select k1.personId a, k2.personId b from k k1 join k k2 using (key) group by all), r as (select a, b from g union select r.a, g.b from r join g on g.a = r.b)
 select a person_id, min(b) group_id from r group by 1 having count(*) > 1"""),
}
