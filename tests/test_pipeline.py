import json

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from rosterloom.plans import pipeline, queries
from rosterloom.streaming import profiles as streaming

SF = "/root/testdata/sf0.001"
ATS = {"candidate_id": "C1", "full_name": "Pat Example", "email": "PAT@example.com", "phone": "415-555-0192", "headline": "", "years_experience": 4.0, "location": {"city": "Pune", "country": "India"}, "links": {"a": "b"}, "skills": ["Python"], "experience": [{"title": "Dev", "company": "Acme"}], "education": [], "unknown": 1}
RESUME = "Pat Example\nPune, MH, India\npat@example.com | (415) 555-0192\nEXPERIENCE\nDev — Acme\nMay 2020 – Present\n- Work\nSKILLS\npy, Go\n"


@pytest.fixture
def files(tmp_path):
    (tmp_path / "ats.json").write_text(json.dumps(ATS))
    (tmp_path / "resume.txt").write_text(RESUME)
    (tmp_path / "config.yaml").write_text("fields: [full_name, email, skills]\nrename: {full_name: name}\nmissing_policy: omit\n")
    return tmp_path


def test_one_pair(spark, files):
    out = pipeline.run_pair(spark, str(files / "ats.json"), str(files / "resume.txt"), str(files / "config.yaml"), str(files / "out"))
    c = out["canonical"]
    assert c["emails"] == ["PAT@example.com"] and c["phones"] == ["+14155550192"]
    assert c["location"] == {"city": "Pune", "state": "MH", "country": "India"}
    assert c["skills"] == ["Go", "Python"] and c["headline"] is None and c["education"] == []
    assert c["experience"] == [{"title": "Dev", "company": "Acme", "start_date": "2020-05", "end_date": None, "description": "Work", "bullets": ["Work"]}]
    assert [p["field"] for p in c["provenance"]] == ["candidate_id", "education", "emails", "experience", "full_name", "links", "location", "phones", "skills", "years_experience"]
    assert list(out["transformed"]) == ["emails", "skills", "candidate_id", "name"]
    assert json.loads((files / "out/canonical_profile.json").read_text()) == c


def test_unreadable_inputs(spark, files):
    (files / "bad.json").write_text("{nothing")
    out = pipeline.run_pair(spark, str(files / "bad.json"), str(files / "none.txt"), str(files / "none.yaml"), str(files / "out"))
    assert out["canonical"]["candidate_id"] == "UNKNOWN" and out["canonical"]["full_name"] == ""


def test_stream_of_resumes(spark, files, tmp_path):
    ats = spark.createDataFrame([("C1", "Pat", "pat@example.com")], "candidate_id string, full_name string, email string")
    rest = queries.ats(spark, SF).limit(0).drop("k")
    ats = ats.join(rest, ["candidate_id", "full_name", "email"], "left").select(*rest.columns)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text(RESUME)
    run = streaming.write_profiles(streaming.read_texts(spark, str(folder)), ats, str(tmp_path / "out"), str(tmp_path / "check"))
    run.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [r["candidate_id"] for r in rows] == ["C1"] and rows[0]["skills"] == ["Go", "Python"]


@pytest.mark.parametrize("name", ["emails_from_documents", "phones_from_documents", "section_split", "education_records", "match_tiered", "part_similarity", "experience_merge", "projection_omit", "canonical_profile"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "customer", "orders", "part"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.execute(entry.oracle_sql()[name]).df(), entry.queries()[name](spark, SF).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(want.columns)
    norm = lambda d: d[columns].astype(object).where(d[columns].notna(), None).astype(str).sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(norm(got), norm(want))


def test_entry(spark):
    assert entry.entry(spark).count() == 150
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_record_that_is_not_there(spark, files):
    from rosterloom.sources import readers

    row = readers.read_ats(spark, str(files / "none.json")).first()
    assert row["candidate_id"] == readers.UNKNOWN and row["full_name"] is None and not row["invalid"]
    out = pipeline.run_pair(spark, str(files / "none.json"), str(files / "none.txt"), str(files / "config.yaml"), str(files / "absent"))
    assert out["canonical"]["candidate_id"] == readers.UNKNOWN


def test_two_records_in_one_file_are_refused(spark, files):
    (files / "two.json").write_text(json.dumps([ATS, ATS]))
    with pytest.raises(ValueError, match="one record"):
        pipeline.run_pair(spark, str(files / "two.json"), str(files / "resume.txt"), str(files / "config.yaml"), str(files / "out2"))
