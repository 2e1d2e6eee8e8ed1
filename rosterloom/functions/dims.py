"""Fixed values of the profile domain, and small dimensions made from public rules."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession

# Canonical names of skills, by lower-case alias.
SKILL_ALIASES = {
    "py": "Python", "python3": "Python", "python 3": "Python",
    "js": "JavaScript", "javascript": "JavaScript", "es6": "JavaScript",
    "ts": "TypeScript", "typescript": "TypeScript",
    "postgres": "PostgreSQL", "postgresql": "PostgreSQL", "psql": "PostgreSQL",
    "mongo": "MongoDB", "mongodb": "MongoDB",
    "k8s": "Kubernetes", "kubernetes": "Kubernetes",
    "tf": "Terraform", "terraform": "Terraform",
    "aws": "AWS", "amazon web services": "AWS", "gcp": "GCP", "google cloud": "GCP",
    "ml": "Machine Learning", "machine learning": "Machine Learning",
    "dl": "Deep Learning", "deep learning": "Deep Learning",
    "rest": "REST APIs", "rest apis": "REST APIs", "restful": "REST APIs",
    "sql": "SQL", "nosql": "NoSQL",
    "docker": "Docker", "react": "React", "django": "Django", "flask": "Flask", "redis": "Redis", "graphql": "GraphQL",
    "bash": "Bash", "shell": "Bash", "linux": "Linux",
    "git": "Git", "github": "Git", "ci/cd": "CI/CD",
    "agile": "Agile", "scrum": "Scrum",
}

# Labels in a skills section that are no skills.
CATEGORY_LABELS = ("programming", "ai/ml", "data", "web", "core cs", "other", "languages", "frameworks", "databases", "devops", "tools", "soft skills", "skills", "technical", "technologies")

# Section headers, and those that may go on after the word.
SECTION_HEADERS = ("EXPERIENCE", "WORK EXPERIENCE", "EMPLOYMENT", "EDUCATION", "SKILLS", "CERTIFICATIONS AND LICENSES", "CERTIFICATIONS", "SUMMARY", "OBJECTIVE", "PROJECTS", "ACHIEVEMENTS", "AWARDS", "PUBLICATIONS", "VOLUNTEER", "LANGUAGES", "INTERESTS", "HOBBIES")

# Reliability of sources, weight of fields, adjustments.
SOURCE_WEIGHTS = {"ats": 0.95, "resume": 0.85, "recruiter": 0.70}
FIELD_IMPORTANCE = {"candidate_id": 1.0, "full_name": 1.0, "emails": 1.0, "phones": 0.9, "location": 0.7, "skills": 0.85, "experience": 0.9, "education": 0.85, "certifications": 0.75, "headline": 0.5, "years_experience": 0.6, "links": 0.5}
DEFAULT_WEIGHT = 0.5
FAILURE_PENALTY, AGREEMENT_BOOST, MAX_CONFIDENCE = 0.15, 0.05, 0.99
SKILL_THRESHOLD, EXPERIENCE_THRESHOLD, EDUCATION_THRESHOLD = 85, 80, 80

# Patterns of contacts, dates and bullets.
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE = r"[\+\(]?[0-9][0-9\s\-\.\(\)]{7,}[0-9]"
URL = r"https?://[^\s]+|(?:linkedin|github)\.com/[^\s|]+"
DATE_RANGE = r"(?i)([A-Za-z]+\s+\d{4}|\d{4}-\d{2}|\d{4})\s*[–\-—to]+\s*([A-Za-z]+\s+\d{4}|\d{4}-\d{2}|\d{4}|[Pp]resent|[Cc]urrent|[Nn]ow)"
BULLET = r"^\s*[-•*]\s+(.+)"
TITLE_COMPANY = r"(?i)\s+[—–\-]\s+|\s+at\s+"
DEGREE = r"(?i)\b(B\.?[Tt]ech|B\.?E\.?|B\.?S\.?|M\.?S\.?|B\.?A\.?|M\.?A\.?|Ph\.?D\.?|Bachelor|Master|Associate|Doctor|M\.?Tech|MBA|BCA|MCA)\b"
SCHOOL_BOARD = r"(?i)\b(CBSE|ICSE|State Board|ISC)\b|^Class\s+(?:X{1,3}|IX|VIII|VII)"
SCHOOL_CLASS = r"(?i)^(Class\s+(?:XII|XI|X|IX|VIII|VII|VI|V|IV|III|II|I))\b"

MONTHS = {name: f"{i:02d}" for i, full in enumerate(("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"), 1) for name in (full, full[:3])} | {"sept": "09"}

#: Country calling codes by the zones of the international numbering plan.
CALLING_CODE = r"1|7|2[07]|2[1-689]\d|3[0-469]|3[578]\d|4[013-9]|42\d|5[09]\d|5[1-8]|6[0-6]|6[789]\d|8[1246]|8[058]\d|9[0-58]|9[679]\d"


@lru_cache(1)
def _countries(gateway) -> dict[str, str]:
    locale = gateway.jvm.java.util.Locale
    english, out = locale.ENGLISH, {}
    for code in locale.getISOCountries():
        of = locale("", code)
        for name in (of.getDisplayCountry(english), of.getISO3Country(), code):
            out[name.lower()] = code
    return out


def countries(spark: SparkSession) -> dict[str, str]:
    """Two-letter codes by lower-case English name, three-letter and two-letter
    code, from the Java platform's own ISO 3166 table."""
    return _countries(spark.sparkContext._gateway)
