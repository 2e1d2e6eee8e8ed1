"""Provenance and confidence: which sources stand behind each field, as columns
derived from the pair itself; nothing is recorded on the side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions.dims import AGREEMENT_BOOST, DEFAULT_WEIGHT, FAILURE_PENALTY, FIELD_IMPORTANCE, MAX_CONFIDENCE, SOURCE_WEIGHTS

#: Fields in the order of their names.
FIELDS = tuple(sorted(FIELD_IMPORTANCE))


def register(entries: Column) -> Column:
    """From array<struct<field, source, weight>>, the greatest weight of each field
    and source, in order of first appearance."""
    keys = F.array_distinct(F.transform(entries, lambda e: F.struct(e["field"].alias("field"), e["source"].alias("source"))))
    most = lambda k: F.array_max(F.transform(F.filter(entries, lambda e: (e["field"] == k["field"]) & (e["source"] == k["source"])), lambda e: e["weight"]))
    return F.transform(keys, lambda k: F.struct(k["field"].alias("field"), k["source"].alias("source"), most(k).alias("weight")))


def sources_of(registered: Column, field: str) -> Column:
    return F.transform(F.filter(registered, lambda e: e["field"] == field), lambda e: e["source"])


def weight_of(registered: Column, field: str, source: str) -> Column:
    hit = F.filter(registered, lambda e: (e["field"] == field) & (e["source"] == source))
    return F.coalesce(F.get(hit, F.lit(0))["weight"], F.lit(0.0))


def pair_sources(ats: dict[str, Column], resume: dict[str, Column]) -> dict[str, Column]:
    """For each field the array of sources that count, given both sides' values.
    Experience and education always count for the ATS, and years of experience
    for the résumé where the ATS has none."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    full = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    yes, no = F.lit(True), F.lit(False)
    part = lambda a, r: F.filter(F.array(F.when(a, "ats"), F.when(r, "resume")), lambda s: s.isNotNull())
    years = ats["years_experience"].isNotNull()
    return {
        "candidate_id": part(yes, no), "full_name": part(some(ats["full_name"]), no),
        "emails": part(some(ats["email"]), full(resume["emails"])), "phones": part(some(ats["phone"]), full(resume["phones"])),
        "location": part(full(F.map_keys(ats["location"])), resume["location"].isNotNull()), "links": part(full(F.map_keys(ats["links"])), no),
        "headline": part(some(ats["headline"]), no), "years_experience": part(years, ~years),
        "skills": part(full(ats["skills"]), full(resume["skills"])), "experience": part(yes, full(resume["experience"])),
        "education": part(yes, full(resume["education"])), "certifications": part(no, full(resume["certifications"])),
    }


def source_weight(source: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in SOURCE_WEIGHTS.items() for x in kv])
    return F.coalesce(F.element_at(table, source), F.lit(DEFAULT_WEIGHT))


def field_confidence(sources: Column, failed: Column) -> Column:
    """0 without sources; else the best source's weight, raised where sources agree
    and lowered where normalisation failed, within 0 and the maximum."""
    best = F.array_max(F.transform(sources, source_weight))
    raised = best + F.when(F.size(sources) > 1, AGREEMENT_BOOST).otherwise(0.0) - F.when(failed, FAILURE_PENALTY).otherwise(0.0)
    return F.when(F.size(sources) == 0, 0.0).otherwise(F.round(F.least(F.lit(MAX_CONFIDENCE), F.greatest(F.lit(0.0), raised)), 4))


def overall(confidences: dict[str, Column], registered: dict[str, Column]) -> Column:
    """The mean by importance over the fields that have sources."""
    top, below = F.lit(0.0), F.lit(0.0)
    for f, c in confidences.items():
        w = F.when(registered[f], FIELD_IMPORTANCE.get(f, DEFAULT_WEIGHT)).otherwise(0.0)
        top, below = top + c * w, below + w
    # the exact binary value decides ties, as a conversion through text would not
    mean = F.least(F.lit(MAX_CONFIDENCE), F.greatest(F.lit(0.0), top / below))
    return F.when(below == 0, 0.0).otherwise(F.round(mean, 4))


def winners(ats: dict[str, Column]) -> dict[str, Column]:
    some = lambda c: F.when(F.coalesce(c, F.lit("")) != "", "ats").otherwise("resume")
    fixed = {f: F.lit("ats") for f in FIELDS} | {"certifications": F.lit("resume")}
    return fixed | {"full_name": some(ats["full_name"]), "emails": some(ats["email"]), "phones": some(ats["phone"]), "headline": some(ats["headline"])}


def provenance(sources: dict[str, Column], won: dict[str, Column]) -> Column:
    """Entries of the fields with sources, by name. The confidence is the best
    source's weight, not the field's score."""
    entry = lambda f: F.when(F.size(sources[f]) > 0, F.struct(F.lit(f).alias("field"), sources[f].alias("sources"), won[f].alias("winning_source"), F.array_max(F.transform(sources[f], source_weight)).alias("confidence"), F.concat(won[f], F.lit(" preferred per config")).alias("note")))
    return F.filter(F.array(*[entry(f) for f in FIELDS]), lambda e: e.isNotNull())
