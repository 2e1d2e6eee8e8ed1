"""String and array helpers with the exact null, blank and order rules that the
profile operators rely on. All take and return columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode sees it, with the ASCII separators.
SPACE = r"[\s\x1c-\x1f]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085  ]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def lines(c: Column) -> Column:
    """The lines of a text; a closing line end opens no further line."""
    return let(F.split(c, LINE_END), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def truthy(c: Column) -> Column:
    """Null for the empty string, else the value."""
    return F.nullif(c, F.lit(""))


def or_empty(array: Column, element: str = "string") -> Column:
    return F.coalesce(array, F.array().cast(f"array<{element}>"))


def distinct_ignoring_case(array: Column) -> Column:
    """The first of each group of entries that are equal in lower case."""
    lowered = lambda a: let(F.transform(a, lambda y: F.lower(y)), lambda low: F.filter(a, lambda x, i: F.array_position(low, F.lower(x)) == i + 1))
    return let(array, lowered)


def safe_lower(c: Column) -> Column:
    return F.lower(c)


def without_nulls(m: Column) -> Column:
    """A map without its entries of null (nested values stay)."""
    return F.map_filter(m, lambda k, v: v.isNotNull())


def flatten_once(nested: Column) -> Column:
    return F.flatten(nested)
