"""Record matching: three tiers as equi-joins, first hit wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIERS = ("email", "phone", "fallback")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\D", "")


def phone_key(c: Column) -> Column:
    """The last seven digits: numbers of seven digits or more match exactly if
    these agree, so the test for a common ending becomes a join key."""
    d = digits(c)
    return F.when(F.length(d) >= 7, F.right(d, F.lit(7)))


def pair_tier(email: Column, phone: Column, resume_emails: Column, resume_phones: Column) -> Column:
    """The tier at which one given pair matches; never null."""
    by_email = F.exists(resume_emails, lambda x: F.lower(x) == F.lower(email))
    by_phone = F.exists(resume_phones, lambda x: phone_key(x) == phone_key(phone))
    # an empty value is missing
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.when(has(email) & by_email, "email").when(has(phone) & by_phone, "phone").otherwise("fallback")


def match_email(ats: DataFrame, resumes: DataFrame) -> DataFrame:
    """(candidate_id, resume_id) of equal addresses in any case."""
    a = ats.where("email != ''").select("candidate_id", F.lower("email").alias("_k"))
    r = resumes.select("resume_id", F.explode("emails").alias("_e")).select("resume_id", F.lower("_e").alias("_k"))
    return a.join(r.distinct(), "_k").select("candidate_id", "resume_id").distinct()


def match_phone(ats: DataFrame, resumes: DataFrame) -> DataFrame:
    a = ats.select("candidate_id", phone_key(F.col("phone")).alias("_k")).where("_k is not null")
    r = resumes.select("resume_id", F.explode("phones").alias("_p")).select("resume_id", phone_key(F.col("_p")).alias("_k")).where("_k is not null")
    return a.join(r.distinct(), "_k").select("candidate_id", "resume_id").distinct()


def match_tiered(ats: DataFrame, resumes: DataFrame) -> DataFrame:
    """One-to-one pairs (candidate_id, resume_id, tier) of many records. A union of
    equi-joins stands for the disjunction, which would be a nested loop. A pair
    stays if it is the best of its candidate and of its résumé, by (tier, ids);
    what is left unmatched stays unmatched."""
    # both tiers' keys come from one pass over each side, so no document is parsed twice
    key = lambda t, k: F.struct(F.lit(t).alias("_t"), k.alias("_k"))
    one = F.array(key(0, F.when(F.col("email") != "", F.lower("email"))), key(1, phone_key(F.col("phone"))))
    many = F.concat(F.transform("emails", lambda e: key(0, F.lower(e))), F.transform("phones", lambda p: key(1, phone_key(p))))
    keys = lambda df, name, each: df.select(name, F.explode(each).alias("_e")).select(name, "_e.*").where("_k is not null").distinct()
    both = keys(ats, "candidate_id", one).join(keys(resumes, "resume_id", many), ["_t", "_k"])
    best = both.groupBy("candidate_id", "resume_id").agg(F.min("_t").alias("_t"))
    of = lambda a, b: F.row_number().over(Window.partitionBy(a).orderBy("_t", b))
    ranked = best.withColumn("_a", of("candidate_id", "resume_id")).withColumn("_r", of("resume_id", "candidate_id"))
    names = F.array(*[F.lit(t) for t in TIERS])
    return ranked.where("_a = 1 and _r = 1").select("candidate_id", "resume_id", F.get(names, F.col("_t")).alias("tier"))


def fallback_pair(ats: DataFrame, resumes: DataFrame) -> DataFrame:
    """The single pair of one record on each side; anything else is refused."""
    a, r = ats.select("candidate_id").limit(2), resumes.select("resume_id").limit(2)
    if a.count() != 1 or r.count() != 1:
        raise ValueError("the fallback tier needs exactly one record on each side")
    return a.crossJoin(r).withColumn("tier", F.lit("fallback"))
