"""The integration pipeline: records and documents to profiles.

Sections, extraction, normalisation, merging and scoring are narrow projections of
one row. The only shuffle of a batch is the join that brings pairs together.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions import dims
from rosterloom.functions.text import truthy
from rosterloom.operators import extract, match, merge, normalize, project, scoring, sections, validate
from rosterloom.schemas import CANONICAL


def extract_resumes(texts: DataFrame) -> DataFrame:
    """``texts`` (resume_id, raw_text) with sections and raw values."""
    rows = texts.withColumn("sections", sections.parse_sections(F.col("raw_text")))
    s = F.col("sections")
    return rows.withColumns({"emails": extract.emails(s), "raw_phones": extract.phones(s), "raw_skills": extract.skills(s), "raw_experience": extract.experience(s), "raw_education": extract.education(s), "certifications": extract.certifications(s), "header": sections.section(s, "HEADER")})


def normalize_resumes(rows: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    """Normalised values and the fields whose normalisation failed."""
    codes = dims.countries(rows.sparkSession) if countries is None else countries
    dated = lambda e, f: normalize.date(e[f])
    missing = lambda c: F.coalesce(c, F.lit("")) == ""
    rows = rows.withColumns({
        "_phones": normalize.phone_list(F.col("raw_phones")),
        "_ranges": F.transform("raw_experience", lambda e: normalize.date_range(e["start_date"], e["end_date"])),
        "_starts": F.transform("raw_education", lambda e: dated(e, "start_date")),
    })
    failed = F.array(
        F.when(F.exists("_phones", lambda p: ~p["ok"]), "phones"),
        F.when(F.exists(F.arrays_zip(F.col("_starts").alias("n"), F.col("raw_education").alias("e")), lambda z: ~z["n"]["ok"] & ~missing(z["e"]["start_date"])), "education"),
        F.when(F.exists(F.arrays_zip(F.col("_ranges").alias("n"), F.col("raw_experience").alias("e")), lambda z: ~z["n"]["ok"] & ~(missing(z["e"]["start_date"]) & missing(z["e"]["end_date"]))), "experience"),
    )
    place = normalize.location(F.get(F.split("header", "\n"), F.lit(1)), codes)
    some = place["city"].isNotNull() | place["state"].isNotNull() | place["country"].isNotNull()
    return rows.select(
        "resume_id", "raw_text", "emails", F.transform("_phones", lambda p: p["value"]).alias("phones"), normalize.skill_list(F.col("raw_skills")).alias("skills"),
        F.transform("raw_experience", lambda e, i: e.withField("start_date", F.get("_ranges", i)["start_date"]).withField("end_date", F.get("_ranges", i)["end_date"])).alias("experience"),
        F.transform("raw_education", lambda e: e.withField("start_date", dated(e, "start_date")["value"]).withField("end_date", dated(e, "end_date")["value"])).alias("education"),
        "certifications", F.when(some, place).alias("location"), F.filter(failed, lambda f: f.isNotNull()).alias("normalization_failures"),
    )


def resumes(texts: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    return normalize_resumes(extract_resumes(texts), countries)


def pair_up(ats: DataFrame, found: DataFrame, mode: str = "pair", on: str = "pair_id") -> DataFrame:
    """Rows of both sides, the résumé's columns prefixed by r_. In "pair" mode the
    caller's ids decide and every pair is merged, with its tier as a label; in
    "batch" mode pairs are matched, and unmatched records merge with nothing."""
    right = found.select(*[F.col(c).alias(f"r_{c}") for c in found.columns])
    if mode == "pair":
        rows = ats.join(right, F.col(on) == F.col(f"r_{on}"))
        return rows.withColumn("tier", match.pair_tier(F.col("email"), F.col("phone"), F.col("r_emails"), F.col("r_phones")))
    if mode != "batch":
        raise ValueError(f"unknown mode {mode!r}")
    pairs = match.match_tiered(ats, found).withColumnRenamed("resume_id", "r_resume_id")
    return ats.join(pairs, "candidate_id", "left").join(right, "r_resume_id", "left")


def merge_pairs(rows: DataFrame, config: dict | None = None) -> DataFrame:
    """Profiles of ``pair_up``'s rows: merged fields, provenance and confidence."""
    none = {"string": F.array().cast("array<string>")}
    listed = lambda c: F.coalesce(F.col(c), none["string"])
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType))
    number = normalize.phone(F.col("phone"))
    rows = rows.withColumns({
        "_phone": F.when(truthy(F.col("phone")).isNotNull() & number["ok"], number["value"]).otherwise(F.col("phone")),
        "_skills": listed("skills"), "_r_skills": listed("r_skills"), "_exp": empty("experience"), "_r_exp": empty("r_experience"), "_edu": empty("education"), "_r_edu": empty("r_education"),
    })
    rows = rows.withColumns({"_ep": merge.experience_picks("_exp", "_r_exp"), "_dp": merge.education_picks("_edu", "_r_edu")})
    one = lambda c: F.when(truthy(c).isNotNull(), F.array(c)).otherwise(none["string"])
    ats = {"full_name": F.col("full_name"), "email": F.col("email"), "phone": F.col("_phone"), "location": F.col("location"), "links": F.col("links"), "headline": F.col("headline"), "years_experience": F.col("years_experience"), "skills": F.col("_skills"), "experience": F.col("_exp"), "education": F.col("_edu")}
    resume = {"emails": listed("r_emails"), "phones": listed("r_phones"), "location": F.col("r_location"), "skills": F.col("_r_skills"), "experience": F.col("_r_exp"), "education": F.col("_r_edu"), "certifications": listed("r_certifications")}
    sources = scoring.pair_sources(ats, resume)
    failures = listed("r_normalization_failures")
    scores = {f: scoring.field_confidence(sources[f], F.array_contains(failures, f)) for f in scoring.FIELDS}
    name = lambda f: merge.scalar({"ats": F.col(f)}, merge.priority(config, f))
    merged = rows.select(
        *[c for c in ("pair_id", "tier") if c in rows.columns], "candidate_id", F.coalesce(name("full_name"), F.lit("")).alias("full_name"),
        merge.string_union(one(F.col("email")), resume["emails"]).alias("emails"), merge.string_union(one(F.col("_phone")), resume["phones"]).alias("phones"),
        merge.location_fill(F.col("location"), F.col("r_location")).alias("location"), merge.map_union(F.col("links"), F.lit(None).cast("map<string,string>")).alias("links"),
        name("headline").alias("headline"), "years_experience", merge.skill_union("_skills", "_r_skills").alias("skills"),
        merge.experience_merge(F.col("_exp"), F.col("_r_exp"), F.col("_ep")).alias("experience"), merge.education_merge(F.col("_edu"), F.col("_r_edu"), F.col("_dp")).alias("education"),
        F.array_distinct(resume["certifications"]).alias("certifications"), scoring.provenance(sources, scoring.winners(ats)).alias("provenance"),
        F.struct(*[F.when(F.size(sources[f]) > 0, scores[f]).alias(f) for f in scoring.FIELDS]).alias("field_confidences"),
    )
    by_field = {f: F.coalesce(F.col("field_confidences")[f], F.lit(0.0)) for f in scoring.FIELDS}
    return merged.withColumn("overall_confidence", scoring.overall(by_field, {f: F.col("field_confidences")[f].isNotNull() for f in scoring.FIELDS}))


def integrate(ats: DataFrame, texts: DataFrame, config: dict | None = None, mode: str = "pair", on: str = "pair_id", countries: dict[str, str] | None = None) -> DataFrame:
    """Profiles from ATS records and texts (resume_id, raw_text and, in pair mode,
    the pair's id on both sides), with validation columns."""
    found = resumes(texts, countries)
    if mode == "pair" and on not in found.columns:
        found = found.join(texts.select("resume_id", on), "resume_id") if on != "resume_id" else found
    return validate.validate(merge_pairs(pair_up(ats, found, mode, on), config))


def run_pair(spark: SparkSession, ats_path: str, resume_path: str, config_path: str, output: str) -> dict:
    """One record and one document to two JSON files; returns both."""
    import json

    from rosterloom.sources import config as configs
    from rosterloom.sources import readers, sinks

    config = configs.load(config_path)
    ats = readers.require_ids(readers.read_ats(spark, ats_path)).withColumn("pair_id", F.lit(1))
    if ats.limit(2).count() != 1:
        raise ValueError(f"{ats_path} must hold one record")
    reader = readers.read_texts if resume_path.lower().endswith(".txt") else readers.read_documents
    requested = spark.createDataFrame([(resume_path.rsplit("/", 1)[-1],)], "resume_id string")
    try:
        texts = readers.with_requested(reader(spark, resume_path), requested)
        texts = texts.select("resume_id", "raw_text")
        texts.schema
    except AnalysisException as error:  # a document that isn't there is an empty one
        if not readers.is_absent(error):
            raise
        texts = requested.withColumn("raw_text", F.lit(""))
    profiles = integrate(ats, texts.withColumn("pair_id", F.lit(1)), config).persist()
    canonical = profiles.select(F.to_json(F.struct(*CANONICAL), {"ignoreNullFields": "false"}).alias("j")).first()[0]
    transformed = project.project_json(profiles, config).first()["json"]
    profiles.unpersist()
    out = {"canonical": json.loads(canonical), "transformed": json.loads(transformed)}
    for name in out:
        sinks.write_json(out[name], f"{output}/{name}_profile.json")
    return out
