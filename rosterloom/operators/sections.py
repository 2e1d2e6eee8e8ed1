"""A document's text to its sections: narrow expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions.dims import SECTION_HEADERS
from rosterloom.functions.text import let, lines, strip

#: A header stands alone on its line; only certifications may go on.
HEADER = "(?i)^(" + "|".join(h for h in SECTION_HEADERS if not h.startswith("CERT")) + r"|CERTIFICATIONS.*)[:\-\s]*$"
_LONGEST = "^(" + "|".join(sorted(SECTION_HEADERS, key=len, reverse=True)) + ")"


def parse_sections(text: Column) -> Column:
    """array<struct<key, body>> in order of first appearance. What precedes the
    first header is HEADER, which is always there; of a repeated header the last
    body counts. A null or blank text is one empty HEADER."""
    blank = F.array(F.struct(F.lit("HEADER").alias("key"), F.lit("").alias("body")))
    whole = let(lines(text), lambda ls: let(_heads(ls), lambda heads: let(_bodies(ls, heads), _last_of_each)))
    return F.when(text.isNull() | (strip(text) == ""), blank).otherwise(whole)


def _heads(ls: Column) -> Column:
    numbered = F.transform(ls, lambda x, i: F.struct(i.alias("i"), strip(x).alias("line")))
    return F.filter(numbered, lambda h: h["line"].rlike(HEADER))


def _bodies(ls: Column, heads: Column) -> Column:
    body = lambda start, end: strip(F.array_join(F.slice(ls, start + 1, F.greatest(end - start, F.lit(0))), "\n"))
    end_of = lambda k: F.coalesce(F.get(heads, k)["i"], F.size(ls))
    key = lambda line: F.regexp_extract(F.regexp_replace(F.upper(line), r"[:\- ]+$", ""), _LONGEST, 1)
    first = F.struct(F.lit("HEADER").alias("key"), body(F.lit(0), end_of(F.lit(0))).alias("body"))
    return F.concat(F.array(first), F.transform(heads, lambda h, k: F.struct(key(h["line"]).alias("key"), body(h["i"] + 1, end_of(k + 1)).alias("body"))))


def _last_of_each(found: Column) -> Column:
    keys = F.array_distinct(F.transform(found, lambda s: s["key"]))
    return F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(found, lambda s: s["key"] == k), -1)["body"].alias("body")))


def section(sections: Column, *keys: str) -> Column:
    """The body of the first of ``keys`` that isn't empty, else the empty string."""

    def body(key: str) -> Column:
        return F.nullif(F.get(F.filter(sections, lambda s: s["key"] == key), F.lit(0))["body"], F.lit(""))

    return F.coalesce(*map(body, keys), F.lit(""))
