import random

import pytest
from pyspark.sql import functions as F

from rosterloom.functions.similarity import token_sort_ratio
from rosterloom.operators import match, merge, project, scoring, validate
from rosterloom.plans import pipeline
from rosterloom.plans import queries as q
from rosterloom.sources import config

SF = "/root/testdata/sf0.001"


def plain_ratio(a, b):
    a, b = (" ".join(sorted(x.split())) for x in (a, b))
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return 200 * row[-1] / (len(a) + len(b))


def test_ratio_is_that_of_a_plain_version(spark):
    rng = random.Random(1)
    pairs = [("GitHub", "Git"), ("MySQL", "SQL"), ("REST APIs", "REST API"), ("", ""), ("", "a"), ("b a", "a b")]
    pairs += [("".join(rng.choice("ab c") for _ in range(rng.randint(0, 9))), "".join(rng.choice("ab c") for _ in range(rng.randint(0, 9)))) for _ in range(60)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", token_sort_ratio("a", "b").alias("r")).collect()
    assert all(abs(r["r"] - plain_ratio(r["a"], r["b"])) < 1e-9 for r in rows)


def test_skill_union_keeps_ats_list_and_adds_the_unlike(spark):
    made = spark.createDataFrame([(["Python", "Python", "REST APIs"], ["REST API", "Go", "Golang", "python"])], "a array<string>, b array<string>")
    assert made.select(merge.skill_union("a", "b")).first()[0] == ["Go", "Golang", "Python", "Python", "REST APIs"]


_EXP = "array<struct<title:string,company:string,start_date:string,end_date:string,description:string,bullets:array<string>>>"


def test_experience_takes_the_best_free_entry_and_sorts(spark):
    a = [("Engineer", "Acme", "2019", None, "short", []), ("Engineer", "Acme", None, None, None, [])]
    r = [("Engineer", "Acme", "2020-01", None, "a longer one", ["x", "x"]), ("Chef", "Cafe", "2021", None, None, ["y", "y"])]
    made = spark.createDataFrame([(a, r)], f"a {_EXP}, r {_EXP}").withColumn("p", merge.experience_picks("a", "r"))
    row = made.select("p", merge.experience_merge(F.col("a"), F.col("r"), F.col("p")).alias("m")).first()
    assert row["p"] == [0, -1]
    assert [(m["title"], m["start_date"], m["description"], m["bullets"]) for m in row["m"]] == [("Chef", "2021", None, ["y", "y"]), ("Engineer", "2020-01", "a longer one", ["x"]), ("Engineer", None, None, [])]


def test_links_of_the_ats_win(spark):
    made = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"})], "a map<string,string>, r map<string,string>")
    assert made.select(merge.map_union(F.col("a"), F.col("r"))).first()[0] == {"a": "1", "b": "2", "c": "4"}


def test_priority():
    assert merge.priority({"source_priority": {"full_name": ["resume"]}}, "full_name") == ["resume"]
    assert merge.priority({"source_priority": {"full_name": {"merge": "union"}}}, "full_name") == ["ats", "resume"]
    assert merge.priority({"source_priority": None}, "full_name") == ["ats", "resume"]


@pytest.mark.parametrize(("email", "phone", "emails", "phones", "tier"), [("A@x.com", None, ["a@X.com"], [], "email"), (None, "+14155550192", [], ["(415) 555-0192"], "phone"), (None, "+14155550192", [], ["4155550192"], "phone"), ("", "555", ["a@x.com"], ["555"], "fallback"), (None, None, [], [], "fallback")])
def test_pair_tier(spark, email, phone, emails, phones, tier):
    made = spark.createDataFrame([(email, phone, emails, phones)], "e string, p string, es array<string>, ps array<string>")
    assert made.select(match.pair_tier(F.col("e"), F.col("p"), F.col("es"), F.col("ps"))).first()[0] == tier


def test_register_keeps_the_greatest_weight(spark):
    made = spark.createDataFrame([([("f", "ats", 0.9), ("g", "ats", 0.5), ("f", "ats", 0.95), ("f", "ats", 0.8)],)], "e array<struct<field:string,source:string,weight:double>>")
    row = made.select(scoring.register(F.col("e")).alias("r")).select("r", scoring.weight_of(F.col("r"), "f", "ats").alias("w"), scoring.weight_of(F.col("r"), "f", "x").alias("z"), scoring.sources_of(F.col("r"), "f").alias("s")).first()
    assert (row["w"], row["z"], row["s"]) == (0.95, 0.0, ["ats"])
    assert [x["field"] for x in row["r"]] == ["f", "g"]


@pytest.mark.parametrize(("sources", "failed", "want"), [([], False, 0.0), (["ats"], False, 0.95), (["ats"], True, 0.8), (["resume"], True, 0.7), (["ats", "resume"], False, 0.99), (["ats", "resume"], True, 0.85), (["other"], False, 0.5)])
def test_field_confidence(spark, sources, failed, want):
    made = spark.createDataFrame([(sources, failed)], "s array<string>, f boolean")
    assert made.select(scoring.field_confidence(F.col("s"), F.col("f"))).first()[0] == want


def test_selection_order():
    of = lambda **c: [n for _, n in project.selected(c)]
    assert of(fields=["full_name", "email", "nothing"], rename={"full_name": "name"}) == ["emails", "candidate_id", "name"]
    assert of(fields=["candidate_id", "overall_confidence"], include_confidence=False) == ["candidate_id"]
    assert of(fields=["phone", "email"], rename={"phone": "x", "x": "emails"}) == ["emails", "candidate_id"]
    assert len(of()) == 14


def test_config_rules(tmp_path):
    assert config.check({"fields": []}) == []
    wrong = {"source_priority": {"a": "x", "b": {"merge": "no"}, "c": ["ats"]}, "missing_policy": 1, "rename": [], "include_confidence": 1, "include_provenance": "y"}
    assert len(config.check(wrong)) == 7
    assert config.load(tmp_path / "none.yaml") == {}
    (tmp_path / "a.yaml").write_text("- 1\n")
    assert config.load(tmp_path / "a.yaml") == {}
    (tmp_path / "a.yaml").write_text("fields: [a]\n")
    assert config.load(tmp_path / "a.yaml") == {"fields": ["a"]}


def test_batch_mode_keeps_unmatched_records(spark):
    ats = q.ats(spark, SF).where("k in (5, 6, 7)")
    found = pipeline.resumes(q.texts(spark, SF).where("k in (6, 8)").select("resume_id", "raw_text"))
    rows = {r["candidate_id"]: r for r in pipeline.merge_pairs(pipeline.pair_up(ats, found, "batch")).collect()}
    assert {k: r["tier"] for k, r in rows.items()} == {"C5": None, "C6": "email", "C7": None}
    assert rows["C7"]["certifications"] == [] and rows["C6"]["certifications"]
    assert all(0 < r["overall_confidence"] <= 0.99 for r in rows.values())


def test_validation(spark):
    made = q.profiles(spark, SF).limit(2)
    assert all(r["valid"] for r in validate.validate(made).select("valid").collect())


def test_pairs_of_a_group_over_several_blocks(spark, monkeypatch):
    from rosterloom.functions import similarity

    monkeypatch.setattr(similarity, "BLOCK", 4)
    names = ["", " ", "hot bolt", "bolt hot", "Ärger ring", "a" * 70 + " b", "b " + "a" * 64, "x" * 64, "x" * 63 + "y", "new \U0001f600 rod", "hot bolt", "rod"]
    rows = [(None if i == 5 else i // 2 if i < 4 else i, n, "B" if g else "A", None if g == 2 else g) for g in range(3) for i, n in enumerate(names)]
    part = spark.createDataFrame(rows, "p long, n string, brand string, size int")
    got = similarity.pair_ratios(part, ["brand", "size"], "p", "n", 6)
    want = [(x[0], y[0], round(similarity.ratio(x[1], y[1]), 6)) for x in rows for y in rows if None not in (x[0], y[0], x[3]) and x[2:] == y[2:] and x[0] < y[0]]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_names_are_compared_once_however_many_rows_have_them(monkeypatch):
    from rosterloom.functions import similarity

    compared, plain = [], similarity.common_subsequences
    monkeypatch.setattr(similarity, "common_subsequences", lambda a, b: compared.append(len(a) * len(b)) or plain(a, b))
    known, names = similarity._Ratios(6, 40), [f"part {i}" for i in range(20)]
    first = known.of(names, names)
    assert all((known.of(names[::-1], names[:k]) == first[::-1, :k]).all() for k in range(1, 20)) and sum(compared) == 400
    # with more names than are kept it starts anew
    more = known.of([f"bolt {i}" for i in range(30)], names[:10])
    assert more[3, 4] == round(similarity.ratio("bolt 3", "part 4"), 6) and (known.of(names, names) == first).all()
