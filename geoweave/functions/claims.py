"""Claims of entity records: typed values of a property's statements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoweave.functions.text import amount, time_date

#: Where a value of each type stands in the raw JSON of a statement's value.
_PATH = {"wikibase-entityid": "$.id", "time": "$.time", "quantity": "$.amount", "monolingualtext": "$.text"}


def statements(claims: Column, prop: str) -> Column:
    """The statements of a property, an empty array where there are none."""
    got = F.try_element_at(claims, F.lit(prop))
    return F.coalesce(got, F.filter(got, lambda _: F.lit(False)), F.expr("array()").cast("array<struct<mainsnak:struct<snaktype:string,datavalue:struct<type:string,value:string>>>>"))


def raw(statement: Column, kind: str) -> Column:
    """Raw text of a statement's value if it has one of that type, else null."""
    snak = statement["mainsnak"]
    return F.when((snak["snaktype"] == "value") & (snak["datavalue"]["type"] == kind), snak["datavalue"]["value"])


def item(statement: Column) -> Column:
    return F.get_json_object(raw(statement, "wikibase-entityid"), "$.id")


def string(statement: Column) -> Column:
    """A string value, or the text of a text in one language."""
    return F.coalesce(raw(statement, "string"), F.get_json_object(raw(statement, "monolingualtext"), "$.text"))


def time(statement: Column) -> Column:
    return time_date(F.get_json_object(raw(statement, "time"), "$.time"))


def quantity(statement: Column) -> Column:
    """Whole number, cut toward zero; 0 counts as missing."""
    n = amount(F.get_json_object(raw(statement, "quantity"), "$.amount"))
    return F.when(n != 0, n)


def spot(statement: Column) -> Column:
    v = raw(statement, "globecoordinate")
    lat, lon = F.get_json_object(v, "$.latitude").try_cast("double"), F.get_json_object(v, "$.longitude").try_cast("double")
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def first(claims: Column, prop: str, read) -> Column:
    """Value of the property's first statement; null if that has none."""
    return read(F.get(statements(claims, prop), F.lit(0)))


def first_usable(claims: Column, prop: str, read) -> Column:
    return F.get(F.filter(F.transform(statements(claims, prop), read), lambda x: x.isNotNull()), F.lit(0))


def several(claims: Column, prop: str, read, most: int | None = None) -> Column:
    """Values of a property; at most ``most`` statements are looked at, then those without a value dropped; null if none."""
    s = statements(claims, prop)
    got = F.filter(F.transform(F.slice(s, 1, most) if most else s, read), lambda x: x.isNotNull())
    return F.when(F.size(got) > 0, got)


def has_any(claims: Column, props: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(F.map_keys(claims), F.array(*[F.lit(p) for p in props])), F.lit(False))
