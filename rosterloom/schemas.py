"""Schemas of records and profiles."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L = T.StringType(), lambda t: T.ArrayType(t)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


ATS_EXPERIENCE = _strings("title", "company", "start_date", "end_date", "description")
ATS_EDUCATION = _strings("institution", "degree", "field_of_study", "start_date", "end_date")
EXPERIENCE = T.StructType([*ATS_EXPERIENCE.fields, T.StructField("bullets", _L(_S))])
EDUCATION = ATS_EDUCATION
LOCATION = _strings("city", "state", "country")
SECTION = _strings("key", "body")

ATS = T.StructType([
    T.StructField("candidate_id", _S), T.StructField("full_name", _S), T.StructField("email", _S), T.StructField("phone", _S),
    T.StructField("status", _S), T.StructField("headline", _S), T.StructField("years_experience", T.DoubleType()),
    T.StructField("location", T.MapType(_S, _S)), T.StructField("links", T.MapType(_S, _S)), T.StructField("skills", _L(_S)),
    T.StructField("experience", _L(ATS_EXPERIENCE)), T.StructField("education", _L(ATS_EDUCATION)),
])

RESUME = T.StructType([
    T.StructField("resume_id", _S), T.StructField("raw_text", _S), T.StructField("emails", _L(_S)), T.StructField("phones", _L(_S)),
    T.StructField("skills", _L(_S)), T.StructField("experience", _L(EXPERIENCE)), T.StructField("education", _L(EDUCATION)),
    T.StructField("certifications", _L(_S)), T.StructField("location", LOCATION), T.StructField("normalization_failures", _L(_S)),
])

PROVENANCE = T.StructType([T.StructField("field", _S), T.StructField("sources", _L(_S)), T.StructField("winning_source", _S), T.StructField("confidence", T.DoubleType()), T.StructField("note", _S)])

#: Columns of a canonical profile, in order.
CANONICAL = ("candidate_id", "full_name", "emails", "phones", "location", "links", "headline", "years_experience", "skills", "experience", "education", "certifications", "provenance", "overall_confidence")
