"""Queries over the star-schema tables, each with the SQL that gives the same rows.

The tables hold no résumés, so both sides derive them from customers by one SQL
text that Spark and other engines read alike. Spark runs the operators on the
derived documents; the SQL side states the expected values from the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions import dims
from rosterloom.functions.dims import EMAIL, FIELD_IMPORTANCE, PHONE
from rosterloom.functions.similarity import pair_ratios
from rosterloom.operators import extract, match, merge, normalize, project, scoring, sections, validate
from rosterloom.plans import pipeline

_BASE = r"""
SELECT c_custkey AS k, concat('C', c_custkey) AS candidate_id, concat('R', c_custkey) AS resume_id, concat('Customer ', c_custkey) AS full_name, c_acctbal AS acctbal, c_mktsegment AS segment,
  concat('User', c_custkey, '@Mail.com') AS em1, CASE WHEN c_custkey % 3 = 0 THEN concat('alt', c_custkey % 100, '@work.org') END AS em2,
  CASE WHEN c_custkey % 5 <> 0 THEN concat('USER', c_custkey, '@mail.com') END AS ats_email,
  lpad(CAST(c_custkey % 10000 AS VARCHAR(9)), 4, '0') AS d,
  concat('City', c_custkey % 7, ', ST', CASE c_custkey % 4 WHEN 0 THEN ', India' WHEN 1 THEN ', Germany' WHEN 2 THEN ', Atlantis' ELSE '' END) AS place,
  CASE c_custkey % 3 WHEN 0 THEN 'js' WHEN 1 THEN 'typescript' ELSE 'Go' END AS lang,
  concat('Acme Corp ', c_custkey % 10) AS company, 2010 + c_custkey % 10 AS since, 1 + c_custkey % 9 AS mon,
  concat('University of Town ', c_custkey % 12) AS school
FROM customer
"""


def _joined(*lines: str) -> str:
    return "concat(" + ", chr(10), ".join(lines) + ")"


_PHONE = "CASE k % 4 WHEN 0 THEN concat('(415) 555-', d) WHEN 1 THEN concat('+44 20 7946 ', d) WHEN 2 THEN concat('415-555-', d) ELSE '' END"
_BODY = {
    "HEADER": _joined("full_name", "place", f"concat(em1, ' | ', coalesce(em2, ''), ' | ', {_PHONE})"),
    "EXPERIENCE": _joined("concat('Senior Engineer — ', company)", "concat('March ', since, ' – Present')", "concat('- Built thing ', k)", "'* Ran the team'", "''", "'Analyst at Beta Ltd'", "concat('2005-0', mon, ' – 2008')", "'plain words'"),
    "EDUCATION": _joined("school", "'B.S. Physics'", "CASE WHEN k % 2 = 0 THEN 'Optics' ELSE '-----' END", "'August 2001 – May 2005'", "'8.1 CGPA'", "''", "'Class XII (CBSE)'", "'1999'"),
    "SKILLS": _joined("'Programming'", "concat('Languages:  py, SQL, ', lang)", "concat('Tools: docker | git | Tool', k % 5)", "'rest, C'"),
    "CERTIFICATIONS": _joined("concat('- Cert ', k % 4)", "'• Scrum Master'", "concat('- Cert ', k % 4)"),
}
_TEXT = _joined(_BODY["HEADER"], "''", *[x for key in ("EXPERIENCE", "EDUCATION", "SKILLS", "CERTIFICATIONS") for x in (f"'{key.title()}:'" if key == "SKILLS" else f"'{key}'", _BODY[key], "''")])
_EXPECTED = f"WITH base AS ({_BASE})"


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_BASE.replace("FROM customer", "FROM {customer}"), customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).select("k", "resume_id", F.expr(_TEXT.replace("chr(10)", "char(10)")).alias("raw_text"))


def ats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ATS records of the same keys, with gaps of every kind."""
    return base(spark, sf_dir).selectExpr(
        "k", "candidate_id", "full_name", "ats_email AS email", "CASE WHEN k % 6 <> 0 THEN concat('+1 415 555 ', d) END AS phone", "'active' AS status",
        "CASE WHEN k % 4 = 0 THEN '' ELSE segment END AS headline", "CASE WHEN k % 3 <> 1 THEN CAST(k % 30 AS double) END AS years_experience",
        "CASE WHEN k % 2 = 0 THEN map('city', 'Town', 'country', 'India') END AS location", "map('site', concat('https://example.com/', k)) AS links",
        "array('Python', 'SQL', 'REST API') AS skills",
        "array(struct('Senior Engineer' AS title, concat('Acme Corporation ', k % 10) AS company, concat(since, '-01') AS start_date, CAST(NULL AS string) AS end_date, CASE WHEN k % 2 = 0 THEN 'A description that is longer than any of the others' END AS description)) AS experience",
        "array(struct(concat('UNIVERSITY OF TOWN ', k % 12) AS institution, 'Bachelor of Science' AS degree, CAST(NULL AS string) AS field_of_study, CASE WHEN k % 2 = 0 THEN '2001' END AS start_date, '' AS end_date)) AS education",
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("resume_id", sections.parse_sections(F.col("raw_text")).alias("s"))


def _text(c, by: str = "|"):
    return F.array_join(c, by)


# The outer generators keep Catalyst from evaluating the generated array once more in a filter below.


def emails_from_documents(spark, sf_dir):
    found = _documents(spark, sf_dir).select("doc_id", extract.emails_in(F.col("text")).alias("e"))
    return found.select("doc_id", F.size("e").cast("long").alias("n"), _text("e").alias("emails"))


def phones_from_documents(spark, sf_dir):
    found = _documents(spark, sf_dir).select("doc_id", extract.phones_in(F.col("text")).alias("p"))
    return found.select("doc_id", F.size("p").cast("long").alias("n"), _text("p").alias("phones"))


def urls_from_pages(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", extract.urls_in(F.col("url")).alias("u"))
    return found.select("page_id", F.size("u").cast("long").alias("n"), _text("u").alias("urls"))


def section_split(spark, sf_dir):
    return _sections(spark, sf_dir).select("resume_id", F.posexplode_outer("s").alias("pos", "x")).where("pos is not null").select("resume_id", F.col("pos").cast("long").alias("pos"), "x.key", "x.body")


def resume_emails(spark, sf_dir):
    return _sections(spark, sf_dir).select("resume_id", _text(extract.emails(F.col("s"))).alias("emails"))


def resume_phones(spark, sf_dir):
    numbers = normalize.phone_list(extract.phones(F.col("s")))
    return _sections(spark, sf_dir).select("resume_id", _text(F.transform(numbers, lambda p: p["value"])).alias("phones"), F.forall(numbers, lambda p: p["ok"]).alias("ok"))


def skills_tokens(spark, sf_dir):
    return _sections(spark, sf_dir).select("resume_id", _text(extract.skills(F.col("s"))).alias("skills"))


def skills_normalized(spark, sf_dir):
    return _sections(spark, sf_dir).select("resume_id", _text(normalize.skill_list(extract.skills(F.col("s")))).alias("skills"))


def certifications(spark, sf_dir):
    return _sections(spark, sf_dir).select("resume_id", _text(extract.certifications(F.col("s"))).alias("certifications"))


def experience_records(spark, sf_dir):
    each = _sections(spark, sf_dir).select("resume_id", F.posexplode_outer(extract.experience(F.col("s"))).alias("pos", "e")).where("pos is not null")
    return each.select("resume_id", F.col("pos").cast("long").alias("pos"), "e.title", "e.company", "e.start_date", "e.end_date", "e.description", F.size("e.bullets").cast("long").alias("n_bullets"))


def education_records(spark, sf_dir):
    each = _sections(spark, sf_dir).select("resume_id", F.posexplode_outer(extract.education(F.col("s"))).alias("pos", "e")).where("pos is not null")
    return each.select("resume_id", F.col("pos").cast("long").alias("pos"), "e.*")


_DATE = "CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m') WHEN 1 THEN strftime(o_orderdate, '%B %Y') WHEN 2 THEN strftime(o_orderdate, '%b %Y') WHEN 3 THEN 'Present' ELSE strftime(o_orderdate, '%Y') END"


def _order_dates(spark, sf_dir):
    style = lambda f: F.date_format("o_orderdate", f)
    n = F.col("o_orderkey") % 5
    raw = F.when(n == 0, style("yyyy-MM")).when(n == 1, style("MMMM yyyy")).when(n == 2, style("MMM yyyy")).when(n == 3, "Present").otherwise(style("yyyy"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", raw.alias("raw"))


def date_norm(spark, sf_dir):
    made = _order_dates(spark, sf_dir).withColumn("d", normalize.date(F.col("raw")))
    return made.select("o_orderkey", "raw", F.col("d.value").alias("value"), F.col("d.ok").alias("ok"))


def date_range_norm(spark, sf_dir):
    made = _order_dates(spark, sf_dir).withColumn("d", normalize.date_range(F.col("raw"), F.when(F.col("o_orderkey") % 2 == 0, "Summer 2020")))
    return made.select("o_orderkey", "d.*")


def location_norm(spark, sf_dir):
    made = base(spark, sf_dir).select("candidate_id", normalize.location(F.col("place"), dims.countries(spark)).alias("l"))
    return made.select("candidate_id", "l.*")


def _resumes(spark, sf_dir):
    return pipeline.resumes(texts(spark, sf_dir))


def match_email(spark, sf_dir):
    return match.match_email(ats(spark, sf_dir), _resumes(spark, sf_dir))


def match_phone(spark, sf_dir):
    return match.match_phone(ats(spark, sf_dir), _resumes(spark, sf_dir))


def match_tiered(spark, sf_dir):
    return match.match_tiered(ats(spark, sf_dir), _resumes(spark, sf_dir))


def part_similarity(spark, sf_dir):
    """Names of parts of one brand and size, each pair once."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("n"), "p_brand", "p_size")
    return pair_ratios(part, ["p_brand", "p_size"], "p_partkey", "n", 6)


def _pairs(spark, sf_dir):
    found = _resumes(spark, sf_dir).withColumn("pair_id", F.substring("resume_id", 2, 20))
    return pipeline.pair_up(ats(spark, sf_dir).withColumn("pair_id", F.substring("candidate_id", 2, 20)), found)


def profiles(spark, sf_dir, config=None):
    return pipeline.merge_pairs(_pairs(spark, sf_dir), config)


def skills_fuzzy_union(spark, sf_dir):
    return profiles(spark, sf_dir).select("candidate_id", _text("skills").alias("skills"))


def experience_merge(spark, sf_dir):
    each = profiles(spark, sf_dir).select("candidate_id", F.posexplode_outer("experience").alias("pos", "e")).where("pos is not null")
    return each.select("candidate_id", F.col("pos").cast("long").alias("pos"), "e.title", "e.company", "e.start_date", "e.end_date", "e.description", _text("e.bullets").alias("bullets"))


def education_merge(spark, sf_dir):
    each = profiles(spark, sf_dir).select("candidate_id", F.posexplode_outer("education").alias("pos", "e")).where("pos is not null")
    return each.select("candidate_id", F.col("pos").cast("long").alias("pos"), "e.*")


def scalar_merge(spark, sf_dir):
    return profiles(spark, sf_dir).select("candidate_id", "full_name", "headline", "years_experience")


def list_union(spark, sf_dir):
    return profiles(spark, sf_dir).select("candidate_id", _text("emails").alias("emails"), _text("phones").alias("phones"), _text("certifications").alias("certifications"))


def location_fill(spark, sf_dir):
    return profiles(spark, sf_dir).select("candidate_id", "location.*")


def links_merge(spark, sf_dir):
    theirs = F.create_map(F.lit("site"), F.lit("x"), F.lit("code"), F.concat(F.lit("https://example.org/"), F.col("k")))
    made = ats(spark, sf_dir).select("candidate_id", F.explode(merge.map_union(F.col("links"), theirs)).alias("name", "link"))
    return made


def provenance_long(spark, sf_dir):
    each = profiles(spark, sf_dir).select("candidate_id", F.explode_outer("provenance").alias("p")).where("p is not null")
    return each.select("candidate_id", "p.field", _text("p.sources", ",").alias("sources"), "p.winning_source", "p.confidence", "p.note")


def field_confidence(spark, sf_dir):
    table = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"field_confidences.{f}").alias("score")) for f in scoring.FIELDS])).alias("c")
    return profiles(spark, sf_dir).select("candidate_id", table).select("candidate_id", "c.*").where("score is not null")


def overall_confidence(spark, sf_dir):
    return profiles(spark, sf_dir).select("candidate_id", "overall_confidence")


_PROJECTION = {"fields": ["full_name", "headline", "email", "years_experience", "overall_confidence"], "rename": {"full_name": "name", "email": "mail"}, "include_confidence": False}


def _flat(df: DataFrame) -> DataFrame:
    return df.select(*[F.array_join(c, "|").alias(c) if t == "array<string>" else F.col(c) for c, t in df.dtypes])


def projection_null(spark, sf_dir):
    return _flat(project.project(profiles(spark, sf_dir), _PROJECTION))


def projection_default(spark, sf_dir):
    made = project.project(profiles(spark, sf_dir), _PROJECTION | {"missing_policy": "n/a", "fields": ["full_name", "headline", "years_experience"]})
    return _flat(made)


def projection_omit(spark, sf_dir):
    return project.project_json(profiles(spark, sf_dir), {"fields": ["headline", "years_experience", "email"], "rename": {"email": "mail"}, "missing_policy": "omit"})


def validation_errors(spark, sf_dir):
    made = profiles(spark, sf_dir).withColumn("full_name", F.expr("if(candidate_id like '%7', null, full_name)")).withColumn("overall_confidence", F.expr("if(candidate_id like '%9', 1.5D, overall_confidence)"))
    return validate.validate(made).select("candidate_id", "valid", _text("errors").alias("errors"))


def pair_tiers(spark, sf_dir):
    return _pairs(spark, sf_dir).select("candidate_id", "tier")


def canonical_profile(spark, sf_dir):
    """The flagship: profiles of all pairs, flat."""
    return profiles(spark, sf_dir).select(
        "candidate_id", "full_name", _text("emails").alias("emails"), _text("phones").alias("phones"), "headline", "years_experience", _text("skills").alias("skills"), _text("certifications").alias("certifications"),
        F.size("experience").cast("long").alias("n_experience"), F.size("education").cast("long").alias("n_education"), F.col("location.country").alias("country"), F.size("provenance").cast("long").alias("n_provenance"), "overall_confidence",
    )


QUERIES = {f.__name__: f for f in (emails_from_documents, phones_from_documents, urls_from_pages, section_split, resume_emails, resume_phones, skills_tokens, skills_normalized, certifications, experience_records, education_records, date_norm, date_range_norm, location_norm, match_email, match_phone, match_tiered, pair_tiers, part_similarity, skills_fuzzy_union, experience_merge, education_merge, scalar_merge, list_union, location_fill, links_merge, provenance_long, field_confidence, overall_confidence, projection_null, projection_default, projection_omit, validation_errors, canonical_profile)}


# The SQL side.

_FIRST = "list_filter(l, lambda x, i: list_position(l, x) = i)"


def _list_query(table: str, key: str, made: str, name: str) -> str:
    return f"WITH t AS (SELECT {key}, {made} AS l FROM {table}) SELECT {key}, len({_FIRST}) AS n, array_to_string({_FIRST}, '|') AS {name} FROM t"


_E164 = "CASE k % 4 WHEN 0 THEN concat('+1415555', d) WHEN 1 THEN concat('+44207946', d) WHEN 2 THEN concat('+1415555', d) ELSE '' END"
_MAILS = "concat(lower(em1), CASE WHEN em2 IS NULL THEN '' ELSE concat('|', em2) END)"
_DUCK = _EXPECTED
_LANG = "CASE lang WHEN 'js' THEN 'JavaScript' WHEN 'typescript' THEN 'TypeScript' ELSE lang END"
_OWN_SKILLS = f"list_sort(['Docker', 'Git', 'Python', 'REST APIs', 'SQL', concat('Tool', k % 5), {_LANG}])"
_UNION_SKILLS = f"list_sort(['Docker', 'Git', 'Python', 'REST API', 'SQL', concat('Tool', k % 5), {_LANG}])"
_ATS_E164 = "CASE WHEN k % 6 <> 0 THEN concat('+1415555', d) END"
_COUNTRY = "CASE k % 4 WHEN 0 THEN 'IN' WHEN 1 THEN 'DE' WHEN 2 THEN 'Atlantis' END"
_ALL_MAILS = f"array_to_string(list_sort(list_distinct(list_filter([CASE WHEN ats_email IS NOT NULL THEN ats_email ELSE lower(em1) END, em2], lambda x: x IS NOT NULL))), '|')"
_ALL_PHONES = f"array_to_string(list_sort(list_distinct(list_filter([{_ATS_E164}, nullif({_E164}, '')], lambda x: x IS NOT NULL))), '|')"
_HEADLINE = "CASE WHEN k % 4 <> 0 THEN segment END"
_YEARS = "CASE WHEN k % 3 <> 1 THEN CAST(k % 30 AS DOUBLE) END"

#: field, sources, winner of a pair, in SQL
_SOURCES = {
    "candidate_id": ("'ats'", "'ats'"), "full_name": ("'ats'", "'ats'"), "emails": ("CASE WHEN k % 5 <> 0 THEN 'ats,resume' ELSE 'resume' END", "CASE WHEN k % 5 <> 0 THEN 'ats' ELSE 'resume' END"),
    "phones": ("CASE WHEN k % 6 <> 0 AND k % 4 <> 3 THEN 'ats,resume' WHEN k % 6 <> 0 THEN 'ats' WHEN k % 4 <> 3 THEN 'resume' ELSE '' END", "CASE WHEN k % 6 <> 0 THEN 'ats' ELSE 'resume' END"),
    "location": ("CASE WHEN k % 2 = 0 THEN 'ats,resume' ELSE 'resume' END", "'ats'"), "links": ("'ats'", "'ats'"),
    "headline": ("CASE WHEN k % 4 <> 0 THEN 'ats' ELSE '' END", "CASE WHEN k % 4 <> 0 THEN 'ats' ELSE 'resume' END"),
    "years_experience": ("CASE WHEN k % 3 <> 1 THEN 'ats' ELSE 'resume' END", "'ats'"), "skills": ("'ats,resume'", "'ats'"), "experience": ("'ats,resume'", "'ats'"), "education": ("'ats,resume'", "'ats'"), "certifications": ("'resume'", "'resume'"),
}
_FIELD_ROWS = " UNION ALL ".join(f"SELECT k, candidate_id, '{f}' AS field, {s} AS sources, {w} AS winning_source, CAST({FIELD_IMPORTANCE[f]} AS DOUBLE) AS importance FROM base" for f, (s, w) in _SOURCES.items())
_SCORES = f"{_DUCK}, f AS ({_FIELD_ROWS}), c AS (SELECT *, CASE sources WHEN 'ats' THEN 0.95::DOUBLE WHEN 'resume' THEN 0.85::DOUBLE ELSE 0.99::DOUBLE END AS score FROM f WHERE sources <> '')"
_OVERALL = f"{_SCORES}, o AS (SELECT k, candidate_id, round(sum(score * importance) / sum(importance), 4) AS overall_confidence, count(*) AS n FROM c GROUP BY k, candidate_id)"
_LCS = "list_reduce(list_concat([list_transform(range(0, len(sb) + 1), lambda z: 0)], list_transform(string_split(sa, ''), lambda c: [ascii(c)])), lambda row, c: list_reduce(list_concat([[0]], list_transform(range(1, len(sb) + 1), lambda j: [j])), lambda acc, j: list_append(acc, CASE WHEN ascii(sb[j[1]]) = c[1] THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], acc[-1]) END)))[-1]"

ORACLES = {
    "emails_from_documents": _list_query("documents", "doc_id", f"list_transform(regexp_extract_all(text, '{EMAIL}'), lambda x: lower(x))", "emails"),
    "phones_from_documents": _list_query("documents", "doc_id", f"list_transform(regexp_extract_all(text, '{PHONE}'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))", "phones"),
    "urls_from_pages": _list_query("pages", "page_id", r"regexp_extract_all(url, 'https?://[^\s]+|(?:linkedin|github)\.com/[^\s|]+')", "urls"),
    "section_split": _DUCK + " " + " UNION ALL ".join(f"SELECT resume_id, CAST({i} AS BIGINT) AS pos, '{key}' AS key, {'rtrim(' + body + ')' if key == 'HEADER' else body} AS body FROM base" for i, (key, body) in enumerate(_BODY.items())),
    "resume_emails": f"{_DUCK} SELECT resume_id, {_MAILS} AS emails FROM base",
    "resume_phones": f"{_DUCK} SELECT resume_id, {_E164} AS phones, true AS ok FROM base",
    "skills_tokens": f"{_DUCK} SELECT resume_id, concat('py|SQL|', lang, '|docker|git|Tool', k % 5, '|rest') AS skills FROM base",
    "skills_normalized": f"{_DUCK} SELECT resume_id, array_to_string({_OWN_SKILLS}, '|') AS skills FROM base",
    "certifications": f"{_DUCK} SELECT resume_id, concat('Cert ', k % 4, '|Scrum Master') AS certifications FROM base",
    "experience_records": f"{_DUCK} SELECT resume_id, 0::BIGINT AS pos, 'Senior Engineer' AS title, company, concat('March ', since) AS start_date, 'Present' AS end_date, concat('Built thing ', k, ' Ran the team') AS description, 2::BIGINT AS n_bullets FROM base UNION ALL SELECT resume_id, 1, 'Analyst', 'Beta Ltd', concat('2005-0', mon), '2008', NULL, 0 FROM base",
    "education_records": f"{_DUCK} SELECT resume_id, 0::BIGINT AS pos, school AS institution, 'B.S. Physics' AS degree, CASE WHEN k % 2 = 0 THEN 'Optics' END AS field_of_study, 'August 2001' AS start_date, 'May 2005' AS end_date FROM base UNION ALL SELECT resume_id, 1, 'Class XII (CBSE)', 'Class XII', NULL, NULL, '1999' FROM base",
    "date_norm": f"SELECT o_orderkey, {_DATE} AS raw, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m') END AS value, true AS ok FROM orders",
    "date_range_norm": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m') END AS start_date, CASE WHEN o_orderkey % 2 = 0 THEN 'Summer 2020' END AS end_date, true AS ok FROM orders",
    "location_norm": f"{_DUCK} SELECT candidate_id, concat('City', k % 7) AS city, 'ST' AS state, {_COUNTRY} AS country FROM base",
    "match_email": f"{_DUCK} SELECT a.candidate_id, r.resume_id FROM base a JOIN base r ON lower(a.ats_email) = lower(r.em1)",
    "match_phone": f"{_DUCK}, a AS (SELECT candidate_id, right({_ATS_E164}, 7) AS p FROM base WHERE k % 6 <> 0), r AS (SELECT resume_id, right({_E164}, 7) AS p FROM base WHERE k % 4 <> 3) SELECT DISTINCT candidate_id, resume_id FROM a JOIN r USING (p)",
    "pair_tiers": f"{_DUCK} SELECT candidate_id, CASE WHEN k % 5 <> 0 THEN 'email' WHEN k % 6 <> 0 AND k % 4 IN (0, 2) THEN 'phone' ELSE 'fallback' END AS tier FROM base",
    "match_tiered": f"""{_DUCK}, a AS (SELECT candidate_id, lower(ats_email) AS e, CASE WHEN k % 6 <> 0 THEN right({_ATS_E164}, 7) END AS p FROM base),
        r AS (SELECT resume_id, lower(em1) AS e, CASE WHEN k % 4 <> 3 THEN right({_E164}, 7) END AS p FROM base),
        b AS (SELECT candidate_id, resume_id, min(t) AS t FROM (SELECT candidate_id, resume_id, 0 AS t FROM a JOIN r USING (e) UNION ALL SELECT candidate_id, resume_id, 1 FROM a JOIN r USING (p)) GROUP BY ALL),
        n AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY t, resume_id) AS i, row_number() OVER (PARTITION BY resume_id ORDER BY t, candidate_id) AS j FROM b)
        SELECT candidate_id, resume_id, CASE t WHEN 0 THEN 'email' ELSE 'phone' END AS tier FROM n WHERE i = 1 AND j = 1""",
    "part_similarity": f"""WITH p AS (SELECT p_partkey, p_brand, p_size, array_to_string(list_sort(string_split(concat_ws(' ', p_name, p_type), ' ')), ' ') AS s FROM part),
        q AS (SELECT a.p_partkey AS a_key, b.p_partkey AS b_key, a.s AS sa, b.s AS sb FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
        SELECT a_key, b_key, round(CASE WHEN sa = sb THEN 100.0 ELSE 200.0 * {_LCS} / (len(sa) + len(sb)) END::DOUBLE, 6) AS ratio FROM q""",
    "skills_fuzzy_union": f"{_DUCK} SELECT candidate_id, array_to_string({_UNION_SKILLS}, '|') AS skills FROM base",
    "experience_merge": f"""{_DUCK} SELECT candidate_id, 0::BIGINT AS pos, 'Senior Engineer' AS title, CASE WHEN k % 2 = 0 THEN concat('Acme Corporation ', k % 10) ELSE company END AS company,
        CASE WHEN k % 2 = 0 THEN concat(since, '-01') ELSE concat(since, '-03') END AS start_date, NULL AS end_date, CASE WHEN k % 2 = 0 THEN 'A description that is longer than any of the others' ELSE concat('Built thing ', k, ' Ran the team') END AS description, concat('Built thing ', k, '|Ran the team') AS bullets FROM base
        UNION ALL SELECT candidate_id, 1, 'Analyst', 'Beta Ltd', concat('2005-0', mon), '2008', NULL, '' FROM base""",
    "education_merge": f"""{_DUCK} SELECT candidate_id, 0::BIGINT AS pos, concat('UNIVERSITY OF TOWN ', k % 12) AS institution, 'Bachelor of Science' AS degree, CASE WHEN k % 2 = 0 THEN 'Optics' END AS field_of_study, CASE WHEN k % 2 = 0 THEN '2001' ELSE '2001-08' END AS start_date, '2005-05' AS end_date FROM base
        UNION ALL SELECT candidate_id, 1, 'Class XII (CBSE)', 'Class XII', NULL, NULL, '1999' FROM base""",
    "scalar_merge": f"{_DUCK} SELECT candidate_id, full_name, {_HEADLINE} AS headline, {_YEARS} AS years_experience FROM base",
    "list_union": f"{_DUCK} SELECT candidate_id, {_ALL_MAILS} AS emails, {_ALL_PHONES} AS phones, concat('Cert ', k % 4, '|Scrum Master') AS certifications FROM base",
    "location_fill": f"{_DUCK} SELECT candidate_id, CASE WHEN k % 2 = 0 THEN 'Town' ELSE concat('City', k % 7) END AS city, 'ST' AS state, CASE WHEN k % 2 = 0 THEN 'India' ELSE {_COUNTRY} END AS country FROM base",
    "links_merge": f"{_DUCK} SELECT candidate_id, 'site' AS name, concat('https://example.com/', k) AS link FROM base UNION ALL SELECT candidate_id, 'code', concat('https://example.org/', k) FROM base",
    "provenance_long": f"{_SCORES} SELECT candidate_id, field, sources, winning_source, CASE WHEN sources = 'resume' THEN 0.85::DOUBLE ELSE 0.95::DOUBLE END AS confidence, concat(winning_source, ' preferred per config') AS note FROM c",
    "field_confidence": f"{_SCORES} SELECT candidate_id, field, score FROM c",
    "overall_confidence": f"{_OVERALL} SELECT candidate_id, overall_confidence FROM o",
    "projection_null": f"{_DUCK} SELECT candidate_id, {_HEADLINE} AS headline, {_YEARS} AS years_experience, full_name AS name, {_ALL_MAILS} AS mail FROM base",
    "projection_default": f"{_DUCK} SELECT candidate_id, coalesce({_HEADLINE}, 'n/a') AS headline, coalesce(CAST({_YEARS} AS VARCHAR), 'n/a') AS years_experience, full_name AS name FROM base",
    "projection_omit": f"""{_DUCK} SELECT candidate_id, concat('{{', array_to_string(list_filter([CASE WHEN k % 4 <> 0 THEN concat('"headline":"', segment, '"') END, CASE WHEN k % 3 <> 1 THEN concat('"years_experience":', {_YEARS}) END, concat('"candidate_id":"', candidate_id, '"'), concat('"mail":["', replace({_ALL_MAILS}, '|', '","'), '"]')], lambda x: x IS NOT NULL), ','), '}}') AS json FROM base""",
    "validation_errors": f"{_DUCK} SELECT candidate_id, k % 10 NOT IN (7, 9) AS valid, CASE k % 10 WHEN 7 THEN 'full_name: must be a string' WHEN 9 THEN 'overall_confidence: must be between 0 and 1' ELSE '' END AS errors FROM base",
    "canonical_profile": f"""{_OVERALL} SELECT candidate_id, full_name, {_ALL_MAILS} AS emails, {_ALL_PHONES} AS phones, {_HEADLINE} AS headline, {_YEARS} AS years_experience, array_to_string({_UNION_SKILLS}, '|') AS skills, concat('Cert ', k % 4, '|Scrum Master') AS certifications,
        2::BIGINT AS n_experience, 2::BIGINT AS n_education, CASE WHEN k % 2 = 0 THEN 'India' ELSE {_COUNTRY} END AS country, n AS n_provenance, overall_confidence FROM base JOIN o USING (k, candidate_id)""",
}
