"""One identifier, many notations: bare, prefixed, URI, brackets, case, blanks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is written where an identifier is missing.
FILLERS = ["", "-", "0", "none", "null", "unknown", "n/a", "na", "nan", "?"]


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _bare(c: Column) -> Column:
    """Without brackets, blanks, quotes and closing slashes."""
    return F.regexp_replace(c, r"[<>\[\](){}\"\s]|/+(?=[>\])}\"\s]*$)", "")


def _found(c: Column, pattern: str) -> Column:
    return let(F.regexp_extract(c, pattern, 1), lambda x: F.when(x != "", x))


def qid(c: Column) -> Column:
    """``Q`` and digits, or null; ``Q0`` is a filler."""
    return F.concat(F.lit("Q"), _found(_bare(c), r"(?i)(?:^|[:/])Q([1-9][0-9]*)$"))


def number_id(c: Column) -> Column:
    """The trailing digits without leading zeros (authority or gazetteer numbers), or null."""
    return _found(_bare(c), r"(?:^|[^0-9])0*([1-9][0-9]*)$")


def gazetteer_id(c: Column) -> Column:
    return number_id(c).try_cast("bigint")


def person_id(c: Column) -> Column:
    """``type:id`` in bare notation: lower case, but ``wd`` ids upper case; null for fillers."""
    s = F.regexp_replace(_bare(c), r"(?i)^.*?(?:^|/)([a-z]+)[:/]([^:/]+)$", "$1:$2")
    s = F.regexp_replace(s, r"(?i)^(?:.*[:/])?(?=Q[1-9][0-9]*$)", "wd:")
    s = F.regexp_replace(s, r"^(?=[0-9]{2,}$)", "viaf:")

    def cased(x: Column) -> Column:
        return F.when(F.lower(x).isin(FILLERS), None).when(x.rlike("(?i)^wd:"), F.concat(F.lit("wd:"), F.upper(F.substr(x, F.lit(4))))).otherwise(F.lower(x))

    return let(s, cased)
