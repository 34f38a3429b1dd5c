"""Small text functions of the loaders, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoweave.functions.ids import let

# Province names and the codes they are written with.
PROVINCES = {
    "Ontario": ["ON", "08"], "Quebec": ["QC", "PQ", "10"], "Nova Scotia": ["NS", "07"], "New Brunswick": ["NB", "04"], "Manitoba": ["MB", "03"],
    "British Columbia": ["BC", "02"], "Prince Edward Island": ["PE", "PEI", "09"], "Saskatchewan": ["SK", "11"], "Alberta": ["AB", "01"],
    "Newfoundland": ["NL", "NF", "05"], "Yukon": ["YT", "14"], "Northwest Territories": ["NT", "13"], "Nunavut": ["NU", "12"],
}


def non_empty(c: Column) -> Column:
    return let(F.trim(c), lambda x: F.when(x != "", x))


def split_names(c: Column) -> Column:
    """Comma-separated names as an array without blanks and empties; null gives none."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def office_name(c: Column) -> Column:
    """A post office's place name: lower case, without the words for the office and what follows."""
    # Fixed value: the words for a post office.
    return F.trim(F.regexp_replace(F.lower(F.trim(c)), r"\s+(post office|p\.?o\.?|m\.?p\.?o\.?).*$", ""))


def province_codes(c: Column) -> Column:
    table = F.create_map(*[x for k, v in PROVINCES.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))])
    return F.try_element_at(table, c)


def url_number(c: Column) -> Column:
    """The digits of a URL's last part as a number."""
    last = F.regexp_extract(F.regexp_replace(c, "/+$", ""), r"([^/]*)$", 1)
    return F.regexp_replace(last, "[^0-9]", "").try_cast("bigint")


def normal_date(c: Column) -> Column:
    """ISO prefix, else the first year of four digits, else as it is; dates stay strings."""
    iso = F.regexp_extract(c, r"^(-?\d{4}-\d{2}-\d{2})", 1)
    year = F.regexp_extract(c, r"(\d{4})", 1)
    return F.when(iso != "", iso).when(year != "", year).otherwise(c)


def time_date(c: Column) -> Column:
    """Date part of a claim's time value: no leading plus, nothing from T on."""
    return F.substring_index(F.regexp_replace(c, r"^\++", ""), "T", 1)


def amount(c: Column) -> Column:
    """A quantity as a whole number, cut toward zero."""
    return c.try_cast("double").try_cast("bigint")


def article_url(title: Column) -> Column:
    return F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace(title, F.lit(" "), F.lit("_")))


def occupation_role(label: Column) -> Column:
    """What stands before "occupation of"; Unknown where nothing does."""
    return let(F.regexp_extract(label, r"^(.+?)\s+occupation\s+of", 1), lambda x: F.when(x != "", x).otherwise("Unknown"))


def label_or(labels: Column, ident: Column) -> Column:
    """English label, else the first of any language, else the id."""
    return F.coalesce(F.try_element_at(labels, F.lit("en"))["value"], F.get(F.filter(F.transform(F.map_values(labels), lambda v: v["value"]), lambda v: v.isNotNull() & (v != "")), F.lit(0)), ident)
