"""Validation of profiles: constraints as columns, errors as an array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def errors() -> Column:
    """Messages ``place: reason`` of what a profile lacks."""
    need = lambda c: F.when(F.col(c).isNull(), f"{c}: must be a string")
    unit = lambda c, place: F.when((c < 0) | (c > 1), F.concat(F.lit(place), F.lit(": must be between 0 and 1")))
    lists = [F.when(F.col(c).isNull(), f"{c}: must be a list") for c in ("emails", "phones", "skills", "experience", "education", "certifications", "provenance")]
    odd = F.exists("provenance", lambda p: (p["confidence"] < 0) | (p["confidence"] > 1))
    lacks = lambda c, f: F.when(F.exists(c, lambda e: e[f].isNull()), f"{c}.{f}: must be a string")
    nested = [lacks(c, f) for c, f in (("experience", "title"), ("experience", "company"), ("education", "institution"), ("education", "degree"))]
    found = F.array(need("candidate_id"), need("full_name"), unit(F.col("overall_confidence"), "overall_confidence"), *lists, *nested, F.when(odd, "provenance.confidence: must be between 0 and 1"))
    return F.filter(found, lambda e: e.isNotNull())


def validate(profiles: DataFrame) -> DataFrame:
    """``profiles`` with ``errors array<string>`` and ``valid boolean``."""
    return profiles.withColumn("errors", errors()).withColumn("valid", F.size("errors") == 0)
