"""Scores, priorities, confidences and relation rules of the linkers, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoweave.functions.ids import let


def ladder(x: Column, steps: list[tuple[float, float]], rest: float) -> Column:
    """The value of the first step whose limit ``x`` does not exceed; null stays null."""
    out = F.lit(rest)
    for limit, value in reversed(steps):
        out = F.when(x <= limit, F.lit(value)).otherwise(out)
    return F.when(x.isNotNull(), out)


# Distance in km and score, for the plain and the historical linker.
DISTANCE = [(0.1, 1.0), (1.0, 0.9), (5.0, 0.7), (10.0, 0.5)], 0.3
DISTANCE_HISTORICAL = [(0.5, 1.0), (2.0, 0.9), (5.0, 0.75), (10.0, 0.5), (25.0, 0.3)], 0.1
# Words of a type label and priority, first that occurs counts.
LABEL_WORDS = [
    (["county", "township", "municipality", "division"], 85),
    (["city", "town", "village", "settlement"], 70),
    (["neighbourhood", "neighborhood", "district"], 40),
]
# Priorities of type labels of the historical linker, in order of precedence.
LABELS_HISTORICAL = {
    "country": 100, "province": 95, "state": 95, "county": 90, "regional county municipality": 90, "census division": 90, "regional district": 90, "township": 85,
    "rural municipality": 85, "geographic township": 85, "municipality": 80, "city": 75, "town": 70, "village": 65, "hamlet": 60, "settlement": 60,
    "human settlement": 60, "unincorporated community": 55, "neighbourhood": 40, "district": 40, "neighborhood": 40, "borough": 40, "building": 20, "landmark": 20,
    "place of worship": 15, "railway station": 15, "tower": 10, "monument": 10, "park": 10, "cemetery": 10, "school": 10, "hospital": 10,
}
# Priorities of feature codes of the historical linker.
CODES_HISTORICAL = {
    "ADM1": 95, "ADM2": 90, "ADM3": 85, "ADM4": 80, "AREA": 75, "PPLA": 90, "PPLA2": 85, "PPLA3": 80, "PPLA4": 75, "PPL": 70, "PPLL": 65, "PPLC": 95, "PPLH": 60,
    "PPLQ": 55, "PPLX": 40, "CH": 15, "SCH": 15, "BLDG": 10, "MUS": 10, "MNMT": 10, "HTL": 10,
}
# Priorities of feature classes where the code has none.
CLASSES_HISTORICAL = {"P": 50, "A": 60, "L": 55}
# Population from which a candidate gains weight.
POPULATION = [(100_000, 1.3), (10_000, 1.2), (1_000, 1.1)]


def distance_score(km: Column, historical: bool = False) -> Column:
    return ladder(km, *(DISTANCE_HISTORICAL if historical else DISTANCE))


def words(c: Column) -> Column:
    """Distinct blank-separated words."""
    return F.array_distinct(F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != ""))


def name_score(a: Column, b: Column, by_target: bool = False) -> Column:
    """1 if equal, 0.8 if one holds the other, else half the share of common words.

    The share is of the larger word set, or of ``b``'s (the target's) words.
    Null or empty names score 0; a missing target scores 0.5 where ``by_target``.
    """
    x, y = F.lower(a), F.lower(b)
    wa, wb = words(x), words(y)
    common = F.size(F.array_intersect(wa, wb))
    of = F.size(wb) if by_target else F.greatest(F.size(wa), F.size(wb))
    some = F.when(x == y, 1.0).when(x.contains(y) | y.contains(x), 0.8).otherwise(F.coalesce(F.try_divide(common * F.lit(0.5), of), F.lit(0.0)))
    gap = F.coalesce(a, F.lit("")) == "" if by_target else (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")
    out = F.when(gap, 0.0).otherwise(some)
    return F.when(F.coalesce(b, F.lit("")) == "", 0.5).otherwise(out) if by_target else out


def label_priority(label: Column) -> Column:
    low = F.lower(F.coalesce(label, F.lit("")))
    out = F.lit(50)
    for ws, value in reversed(LABEL_WORDS):
        out = F.when(low.rlike("|".join(ws)), F.lit(value)).otherwise(out)
    return out


def code_priority(code: Column) -> Column:
    c = F.upper(F.coalesce(code, F.lit("")))
    return F.when(c.startswith("ADM"), 85).when(c.startswith("PPLA"), 80).when(c == "PPL", 70).when(c == "AREA", 75).when(c == "PPLX", 40).otherwise(50)


def _table(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def historical_priority(label: Column, code: Column, cls: Column) -> Column:
    """By label words in order of precedence, else by feature code, else by class, else 30."""
    keys = F.array(*[F.lit(k) for k in LABELS_HISTORICAL])
    word = let(F.lower(F.coalesce(label, F.lit(""))), lambda x: F.get(F.filter(keys, lambda k: x.contains(k)), F.lit(0)))
    return F.coalesce(
        F.try_element_at(_table(LABELS_HISTORICAL), word),
        F.try_element_at(_table(CODES_HISTORICAL), F.upper(code)),
        F.try_element_at(_table(CLASSES_HISTORICAL), F.upper(cls)),
        F.lit(30),
    )


def type_score(a: Column, b: Column) -> Column:
    """Mean priority in [0, 1]; a fifth more where both are high."""
    mean = (a + b) / F.lit(200.0)
    return F.when((a >= 70) & (b >= 70), F.least(mean * 1.2, F.lit(1.0))).otherwise(mean)


def confidence(distance: Column, name: Column, kind: Column) -> Column:
    return F.least(F.lit(1.0), distance * 0.3 + name * 0.5 + kind * 0.2)


def population_weight(population: Column) -> Column:
    out = F.lit(1.0)
    for limit, value in reversed(POPULATION):
        out = F.when(F.coalesce(population, F.lit(0)) >= limit, F.lit(value)).otherwise(out)
    return out


def historical_confidence(distance: Column, priority: Column, name: Column, weight: Column) -> Column:
    return F.least(F.lit(1.0), distance * 0.4 + priority / F.lit(100.0) * 0.35 + name * 0.15 + (weight - 1.0) * 0.1)


def relation(profile: str, source_priority: Column, target_priority: Column, km: Column, conf: Column) -> Column:
    """Edge type of a link.  Confidence and distance are compared as rounded."""
    part = (source_priority < 60) & (target_priority >= 60) & (km <= 5)
    same = (conf >= 0.85) & (km <= 1)
    if profile == "canada":
        return F.when(part, "LOCATED_IN").otherwise("NEAR")
    if profile == "global":
        return F.when(part, "LOCATED_IN").when(same, "SAME_AS").otherwise("NEAR")
    return F.when(same, "SAME_AS").when(km <= 5, "NEAR").otherwise("LOCATED_IN")
