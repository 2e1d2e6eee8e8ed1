"""Merge rules of a matched pair, as expressions over one row.

Lists are merged in an order on which the outcome depends, so they stay within the
row: no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions.dims import EDUCATION_THRESHOLD, EXPERIENCE_THRESHOLD, SKILL_THRESHOLD
from rosterloom.functions.similarity import fuzzy_union, greedy_picks
from rosterloom.functions.text import distinct_ignoring_case, truthy


def priority(config: dict | None, field: str) -> list[str]:
    """The order of sources for a scalar field, resolved while the plan is built;
    anything but a list means the default."""
    order = ((config or {}).get("source_priority") or {}).get(field)
    return order if isinstance(order, list) else ["ats", "resume"]


def scalar(values: dict[str, Column], order: list[str], default: Column | None = None) -> Column:
    """The first truthy value in the order of sources."""
    picks = [truthy(values[s]) for s in order if s in values]
    return F.coalesce(*picks, *([default] if default is not None else []), F.lit(None).cast("string"))


def string_union(ats: Column, resume: Column) -> Column:
    """One of each value whatever the case, the ATS's spelling first, sorted."""
    return F.array_sort(distinct_ignoring_case(F.concat(ats, resume)))


def location_fill(ats: Column, resume: Column) -> Column:
    """Each part from the ATS map unless null, else from the résumé's struct."""
    part = lambda k: F.coalesce(F.element_at(ats, k), resume[k]).alias(k)
    return F.struct(part("city"), part("state"), part("country"))


def map_union(ats: Column, resume: Column) -> Column:
    """Both maps' entries; the ATS wins, the résumé's keys come first."""
    ours, theirs = F.coalesce(ats, F.create_map().cast("map<string,string>")), F.coalesce(resume, F.create_map().cast("map<string,string>"))
    has = lambda m, k: F.array_contains(F.map_keys(m), k)
    kept = F.transform_values(theirs, lambda k, v: F.when(has(ours, k), F.element_at(ours, k)).otherwise(v))
    return F.map_concat(kept, F.map_filter(ours, lambda k, v: ~has(theirs, k)))


def skill_union(ats: str, resume: str) -> Column:
    """The ATS's skills as they are, and each résumé skill that is like none so far."""
    return fuzzy_union(F.col(ats), F.col(resume), SKILL_THRESHOLD)


def greedy_match(ats: str, resume: str, key, threshold: float) -> Column:
    """For each ATS entry in turn, the number of the best résumé entry that is still
    free and alike enough (ties: the first), or -1."""
    return greedy_picks(F.transform(ats, key), F.transform(resume, key), threshold)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def experience_picks(ats: str, resume: str) -> Column:
    return greedy_match(ats, resume, lambda e: F.concat(_text(e["title"]), F.lit(" "), _text(e["company"])), EXPERIENCE_THRESHOLD)


def experience_merge(ats: Column, resume: Column, picks: Column) -> Column:
    """Of a matched pair the record with the longer description stays whole, the
    ATS's on a tie; bullets come from the résumé. Latest start first."""
    fields = ("title", "company", "start_date", "end_date", "description")

    def of(r: Column, bullets: Column) -> Column:
        return F.struct(_text(r["title"]).alias("title"), _text(r["company"]).alias("company"), *[r[f].alias(f) for f in fields[2:]], bullets.alias("bullets"))

    none = F.array().cast("array<string>")

    def merged(e: Column, i: Column) -> Column:
        r = F.get(resume, F.get(picks, i))
        richer = F.length(_text(e["description"])) >= F.length(_text(r["description"]))
        bullets = F.array_distinct(F.coalesce(r["bullets"], none))
        return F.when(F.get(picks, i) < 0, of(e, none)).when(richer, of(e, bullets)).otherwise(of(r, bullets))

    rest = F.transform(F.filter(resume, lambda r, i: ~F.array_contains(picks, i)), lambda r: of(r, F.coalesce(r["bullets"], none)))
    placed = F.transform(F.concat(F.transform(ats, merged), rest), lambda r, i: F.struct(_text(r["start_date"]).alias("s"), (-i).alias("i"), r.alias("r")))
    order = lambda a, b: F.when((a["s"] > b["s"]) | ((a["s"] == b["s"]) & (a["i"] > b["i"])), -1).otherwise(1)
    return F.transform(F.array_sort(placed, order), lambda p: p["r"])


def education_picks(ats: str, resume: str) -> Column:
    return greedy_match(ats, resume, lambda e: _text(e["institution"]), EDUCATION_THRESHOLD)


def education_merge(ats: Column, resume: Column, picks: Column) -> Column:
    """Field by field, the ATS first; in the ATS's order, then the unmatched."""
    def of(e: Column, r: Column | None) -> Column:
        both = lambda f: F.coalesce(truthy(e[f]), r[f]) if r is not None else e[f]
        study = F.coalesce(truthy(e["field_of_study"]), truthy(r["field_of_study"])) if r is not None else e["field_of_study"]
        return F.struct(_text(both("institution")).alias("institution"), _text(both("degree")).alias("degree"), study.alias("field_of_study"), both("start_date").alias("start_date"), both("end_date").alias("end_date"))

    merged = F.transform(ats, lambda e, i: F.when(F.get(picks, i) < 0, of(e, None)).otherwise(of(e, F.get(resume, F.get(picks, i)))))
    rest = F.transform(F.filter(resume, lambda r, i: ~F.array_contains(picks, i)), lambda r: of(r, None))
    return F.concat(merged, rest)
