import pytest
from pyspark.sql import functions as F

from rosterloom.operators import extract, sections

RESUME = """Pat Example
Springfield, IL  |  Pat.X@Example.com  |  (415) 555-0192

EXPERIENCE
Senior Engineer — Acme Corp
March 2021 – Present
- Built things.
* Ran things.

Analyst at Beta
- Started 2015-01 – 2016

EDUCATION
Example University
B.S. Computer Science
August 2014 – May 2018

SKILLS
Languages:   py, SQL, SQL
AI/ML
C, Rust | Go

CERTIFICATIONS
- Example Certified Developer
• Example Certified Developer
"""


@pytest.fixture(scope="module")
def got(spark):
    def run(text, **columns):
        s = sections.parse_sections(F.col("t"))
        made = spark.createDataFrame([(text,)], "t string").withColumn("s", s)
        return made.select(*[f(F.col("s")).alias(n) for n, f in columns.items()]).first().asDict(recursive=True)

    return run


@pytest.mark.parametrize("text", [None, "", "   \n "])
def test_blank_text_is_an_empty_header(got, text):
    assert got(text, s=lambda s: s)["s"] == [{"key": "HEADER", "body": ""}]


def test_sections(got):
    found = {x["key"]: x["body"] for x in got(RESUME, s=lambda s: s)["s"]}
    assert list(found) == ["HEADER", "EXPERIENCE", "EDUCATION", "SKILLS", "CERTIFICATIONS"]
    assert found["HEADER"].startswith("Pat Example\nSpringfield")


@pytest.mark.parametrize(("line", "key"), [("Languages:", "LANGUAGES"), ("Certifications I hold: AWS", "CERTIFICATIONS"), ("certifications and licenses -", "CERTIFICATIONS AND LICENSES"), ("Work Experience", "WORK EXPERIENCE")])
def test_headers(got, line, key):
    assert [x["key"] for x in got(f"a\n{line}\nb", s=lambda s: s)["s"]] == ["HEADER", key]


@pytest.mark.parametrize("line", ["Languages: Python", "TECHNICAL SKILLS", "Professional Experience", "EXPERIENCE —"])
def test_not_headers(got, line):
    assert len(got(f"a\n{line}\nb", s=lambda s: s)["s"]) == 1


def test_repeated_header_keeps_place_and_last_body(got):
    found = got("SKILLS\none\nEDUCATION\nx\nSKILLS\ntwo", s=lambda s: s)["s"]
    assert [(x["key"], x["body"]) for x in found] == [("HEADER", ""), ("SKILLS", "two"), ("EDUCATION", "x")]


def test_values(got):
    found = got(RESUME, e=extract.emails, p=extract.phones, s=extract.skills, c=extract.certifications)
    assert found["e"] == ["pat.x@example.com"]
    assert found["p"] == ["(415) 555-0192"]
    assert found["s"] == ["py", "SQL", "Rust", "Go"]
    assert found["c"] == ["Example Certified Developer"]


def test_experience(got):
    first, second = got(RESUME, x=extract.experience)["x"]
    assert (first["title"], first["company"], first["start_date"], first["end_date"]) == ("Senior Engineer", "Acme Corp", "March 2021", "Present")
    assert first["bullets"] == ["Built things.", "Ran things."] and first["description"] == "Built things. Ran things."
    # a bullet with a range gives the dates and is no bullet
    assert (second["title"], second["start_date"], second["end_date"], second["bullets"], second["description"]) == ("Analyst", "2015-01", "2016", [], None)


def test_work_experience_is_the_fallback(got):
    assert got("WORK EXPERIENCE\nDev — Co\n2019 - 2020", x=extract.experience)["x"][0]["company"] == "Co"


def test_education(got):
    assert got(RESUME, x=extract.education)["x"] == [{"institution": "Example University", "degree": "B.S. Computer Science", "field_of_study": None, "start_date": "August 2014", "end_date": "May 2018"}]


def test_education_fold(got):
    text = "EDUCATION\nA University\nB.Tech\nComputer Science\nIgnored line\n2016 – 2020\n2017 – 2018\n9.1 CGPA\nM.Tech\nB University\nClass XII (CBSE)\n2015\n2014\na university\n"
    found = got(text, x=extract.education)["x"]
    assert [(r["institution"], r["degree"], r["field_of_study"], r["start_date"], r["end_date"]) for r in found] == [
        ("A University", "B.Tech", "Computer Science", "2016", "2020"),
        ("B University", "M.Tech", None, None, None),
        ("Class XII (CBSE)", "Class XII", "a university", None, "2015"),
    ]


def test_nothing_to_extract(got):
    found = got("", e=extract.emails, p=extract.phones, s=extract.skills, c=extract.certifications, x=extract.experience, d=extract.education)
    assert all(v == [] for v in found.values())


def test_urls(spark):
    made = spark.createDataFrame([("see https://a.example/x and github.com/me|",)], "t string")
    assert made.select(extract.urls_in(F.col("t"))).first()[0] == ["https://a.example/x", "github.com/me"]
