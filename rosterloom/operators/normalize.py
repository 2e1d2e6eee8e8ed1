"""Normalisers of phones, dates, skills and locations: scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions.dims import CALLING_CODE, MONTHS, SKILL_ALIASES
from rosterloom.functions.text import distinct_ignoring_case, let, strip, truthy


def _lookup(table: dict[str, str], key: Column) -> Column:
    """The key's value. A map is searched entry by entry, so a large one is parted by
    the keys' first two characters."""
    mapped = lambda entries: F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)])
    if len(table) <= 64:
        return F.element_at(mapped({k: F.lit(v) for k, v in table.items()}), key)
    parts: dict[str, dict[str, Column]] = {}
    for k, v in table.items():
        parts.setdefault(k[:2], {})[k] = F.lit(v)
    return F.element_at(F.element_at(mapped({k: mapped(p) for k, p in parts.items()}), F.substring(key, 1, 2)), key)


def phone(raw: Column) -> Column:
    """struct<value, ok>: the number with its country code, +1 where none is
    given. What holds no plausible number stays as it is, with ok false. National
    prefixes of other countries are not resolved."""
    return let(F.struct(F.ltrim(F.coalesce(raw, F.lit(""))).alias("text"), F.regexp_replace(F.coalesce(raw, F.lit("")), r"\D", "").alias("digits")), lambda p: _phone(raw, p["text"], p["digits"]))


def _phone(raw: Column, text: Column, digits: Column) -> Column:
    plausible = text.rlike(r"^[+(]?[\d(][\d\s().\-/+]*$")
    abroad = lambda d: F.when(d.rlike(f"^(?:{CALLING_CODE})\\d{{4,14}}$"), F.concat(F.lit("+"), d))
    us = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 20)).otherwise(digits)
    plus = text.startswith("+") | text.startswith("(+")
    value = F.when(plus, abroad(digits)).when(digits.startswith("011"), abroad(F.substring(digits, 4, 20))).when(F.length(us).between(3, 15), F.concat(F.lit("+1"), us))
    return let(F.when(plausible, value), lambda v: F.struct(F.coalesce(v, raw).alias("value"), v.isNotNull().alias("ok")))


def phone_list(raw: Column) -> Column:
    return F.transform(raw, phone)


_DAY, _NUMBER = r"(?:0?[1-9]|[12]\d|3[01])", r"(0?[1-9]|1[0-2])"
_NTH = rf"{_DAY}(?:st|nd|rd|th)?"
#: Shapes of dates in lower case, with the groups of their year and month: year first, month and year, month or day first (a number over 12 is the day).
_NUMERIC = (
    (rf"^(\d{{4}})[-/.]{_NUMBER}(?:[-/.]{_DAY})?$", 1, 2), (rf"^{_NUMBER}[-/.](\d{{4}})$", 2, 1),
    (rf"^{_NUMBER}[-/.]{_DAY}[-/.](\d{{4}})$", 2, 1), (rf"^(?:1[3-9]|2\d|3[01])[-/.]{_NUMBER}[-/.](\d{{4}})$", 2, 1),
)
_NAMED = ((rf"^(?:{_NTH}(?: of)?\s+)?([a-z]+)\.?,?\s+(?:{_NTH},?\s+)?(\d{{4}})$", 2, 1), (r"^(\d{4}),?\s+([a-z]+)\.?$", 1, 2))


def date(raw: Column) -> Column:
    """struct<value, ok>: YYYY-MM of a date with a month, in numbers or by its English
    name, a bare year, or null for what still goes on. Missing input gives (null,
    false), anything else itself and false."""
    text = strip(raw)
    low = F.lower(text)
    part = lambda shape, group: truthy(F.regexp_extract(low, shape, group))
    found = [F.concat(part(shape, y), F.lit("-"), F.lpad(part(shape, m), 2, "0")) for shape, y, m in _NUMERIC]
    found += [F.concat(part(shape, y), F.lit("-"), _lookup(MONTHS, part(shape, m))) for shape, y, m in _NAMED]
    month = F.coalesce(*found)
    year = low.rlike(r"^\d{4}$")
    missing, going = raw.isNull() | (text == ""), low.isin("present", "current", "now")
    value = F.when(missing | going, F.lit(None)).when(year, low).otherwise(F.coalesce(month, raw))
    ok = ~missing & (going | year | month.isNotNull())
    return F.struct(value.alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))


def date_range(start: Column, end: Column) -> Column:
    """struct<start_date, end_date, ok>: either part is enough."""
    a, b = date(start), date(end)
    return F.struct(a["value"].alias("start_date"), b["value"].alias("end_date"), (a["ok"] | b["ok"]).alias("ok"))


def skill(raw: Column) -> Column:
    return F.coalesce(_lookup(SKILL_ALIASES, F.lower(strip(raw))), strip(raw))


def skill_list(raw: Column) -> Column:
    """Canonical names, one of each whatever the case, in code-point order."""
    return F.array_sort(distinct_ignoring_case(F.transform(raw, skill)))


def country(raw: Column, codes: dict[str, str]) -> Column:
    """The two-letter code where the name is known, else the input."""
    return F.coalesce(_lookup(codes, F.lower(strip(raw))), raw) if codes else raw


def location(raw: Column, codes: dict[str, str]) -> Column:
    """struct<city, state, country> from "city, state, country"; more parts are
    ignored, empty ones are null."""
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), ","), strip)
    at = lambda ps, i: truthy(F.get(ps, F.lit(i)))
    return let(parts, lambda ps: F.struct(at(ps, 0).alias("city"), at(ps, 1).alias("state"), country(at(ps, 2), codes).alias("country")))
