import pytest
from pyspark.sql import functions as F

from rosterloom.functions import dims, text
from rosterloom.operators import normalize


@pytest.fixture(scope="module")
def one(spark):
    def run(f, *values):
        made = spark.createDataFrame([values], ", ".join(f"c{i} {'array<string>' if isinstance(v, list) else 'string'}" for i, v in enumerate(values)))
        found = made.select(f(*[F.col(c) for c in made.columns]).alias("x")).first()["x"]
        return tuple(found) if hasattr(found, "asDict") else found

    return run


@pytest.mark.parametrize(("raw", "value", "ok"), [("2021-03", "2021-03", True), ("March 2021", "2021-03", True), ("Sept 2021", "2021-09", True), ("mar. 2021", "2021-03", True), ("Present", None, True), ("current", None, True), ("Now", None, True), ("", None, False), (None, None, False), ("2019", "2019", True), ("Summer 2020", "Summer 2020", False), ("2021-13", "2021-13", False)])
def test_date(one, raw, value, ok):
    assert one(normalize.date, raw) == (value, ok)


@pytest.mark.parametrize(("raw", "value", "ok"), [
    ("03/2021", "2021-03", True), ("3-2021", "2021-03", True), ("2021/03", "2021-03", True), ("2021-03-15", "2021-03", True), ("2021.3.5", "2021-03", True),
    ("03/15/2021", "2021-03", True), ("15/03/2021", "2021-03", True), ("15 March 2021", "2021-03", True), ("March 15, 2021", "2021-03", True), ("1st of Sept. 2020", "2020-09", True),
    ("2021 March", "2021-03", True), ("13/2021", "13/2021", False), ("2021-13", "2021-13", False), ("Summer 2020", "Summer 2020", False), ("32 March 2021", "32 March 2021", False),
])
def test_other_shapes_of_dates(one, raw, value, ok):
    assert one(normalize.date, raw) == (value, ok)


@pytest.mark.parametrize(("a", "b", "want"), [("March 2021", "June 2023", ("2021-03", "2023-06", True)), ("March 2021", "Present", ("2021-03", None, True)), (None, None, (None, None, False)), (None, "December 2022", (None, "2022-12", True))])
def test_date_range(one, a, b, want):
    assert one(normalize.date_range, a, b) == want


@pytest.mark.parametrize(("raw", "value", "ok"), [("+1-415-555-0192", "+14155550192", True), ("(415) 555-0192", "+14155550192", True), ("1 415 555 0192", "+14155550192", True), ("+44 20 7946 0958", "+442079460958", True), ("011 44 20 7946 0958", "+442079460958", True), ("not-a-phone", "not-a-phone", False), ("", "", False), (None, None, False)])
def test_phone(one, raw, value, ok):
    assert one(normalize.phone, raw) == (value, ok)


def test_skills(one):
    assert one(normalize.skill_list, ["py", "python3", "k8s", "Go", "GO", " github ", "python"]) == ["Git", "Go", "Kubernetes", "Python"]


def test_location(one, spark):
    codes = dims.countries(spark)
    place = lambda c: normalize.location(c, codes)
    assert one(place, "Pune, MH, India, x") == ("Pune", "MH", "IN")
    assert one(place, "Pune, MH, Atlantis") == ("Pune", "MH", "Atlantis")
    assert one(place, "Pune, MH") == ("Pune", "MH", None)
    assert one(place, "") == (None, None, None)
    assert one(place, None) == (None, None, None)
    assert one(place, " , ,usa") == (None, None, "US")


def test_text_helpers(one):
    assert one(text.lines, "a\r\nb\rc\x0bd\x1ce\n") == ["a", "b", "c", "d", "e"]
    assert one(text.strip, "  a b\t\n") == "a b"
    assert one(text.distinct_ignoring_case, ["A", "b", "a", "B"]) == ["A", "b"]
    assert one(text.truthy, "") is None
