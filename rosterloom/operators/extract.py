"""Typed values from sections. Every extractor is an expression over one row's
sections; order and repetition follow the rules stated in each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions.dims import BULLET, CATEGORY_LABELS, DATE_RANGE, DEGREE, EMAIL, PHONE, SCHOOL_BOARD, SCHOOL_CLASS, TITLE_COMPANY, URL
from rosterloom.functions.text import let, lines, strip
from rosterloom.operators.sections import section

_RULER = r"^[-–—=]+$"


def _found(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def emails(sections: Column) -> Column:
    """Lower-case addresses, header first, then the other sections in order."""
    header = F.filter(sections, lambda s: s["key"] == "HEADER")
    others = F.filter(sections, lambda s: s["key"] != "HEADER")
    each = F.transform(F.concat(header, others), lambda s: _found(s["body"], EMAIL))
    return F.array_distinct(F.transform(F.flatten(each), lambda x: F.lower(x)))


def emails_in(text: Column) -> Column:
    return F.array_distinct(F.transform(_found(text, EMAIL), lambda x: F.lower(x)))


def phones_in(text: Column) -> Column:
    return F.array_distinct(F.transform(_found(text, f"(?U){PHONE}"), strip))


def phones(sections: Column) -> Column:
    """Phone-like strings of the header."""
    return phones_in(section(sections, "HEADER"))


def urls_in(text: Column) -> Column:
    """Links (an optional extractor; profiles don't take links from texts)."""
    return F.array_distinct(_found(text, URL))


def _kept_lines(text: Column, ruler: str = _RULER) -> Column:
    return F.filter(F.transform(lines(text), strip), lambda x: (x != "") & ~x.rlike(ruler))


def skills(sections: Column) -> Column:
    """Tokens of the skills section as written: labels before a colon and lines or
    tokens that are category labels go, and so do tokens of one character."""
    labels = F.array(*[F.lit(x) for x in CATEGORY_LABELS])
    cleaned = F.transform(_kept_lines(section(sections, "SKILLS"), r"^[-–—=*#]+$"), lambda x: strip(F.regexp_replace(x, r"^[A-Za-z0-9 /&]+:\s*", "")))
    real = F.filter(cleaned, lambda x: ~F.array_contains(labels, F.lower(x)))
    tokens = F.transform(F.flatten(F.transform(real, lambda x: F.split(x, r"[,|\t]"))), strip)
    return F.array_distinct(F.filter(tokens, lambda t: (F.char_length(t) >= 2) & ~F.array_contains(labels, F.lower(t))))


def certifications(sections: Column) -> Column:
    body = section(sections, "CERTIFICATIONS", "CERTIFICATIONS AND LICENSES")
    cleaned = F.transform(lines(body), lambda x: strip(F.regexp_replace(x, r"(?U)^\s*[-•*]\s*", "")))
    return F.array_distinct(F.filter(cleaned, lambda x: (x != "") & ~x.rlike(_RULER)))


def _range_part(line: Column, group: int) -> Column:
    return F.regexp_extract(line, DATE_RANGE, group)


def experience(sections: Column) -> Column:
    """Records from the lines that part a title and a company. Up to the next such
    line, the first range gives the dates and bullets the description."""
    heading = lambda x: x.rlike(TITLE_COMPANY) & ~x.startswith("-") & ~x.rlike(DATE_RANGE.replace("(?i)", "(?i)^"))
    heads = lambda ls: F.filter(F.transform(ls, lambda x, i: F.struct(i.alias("i"), x.alias("line"))), lambda h: heading(h["line"]))
    body = lambda ls, hs, h, k: F.slice(ls, h["i"] + 2, F.coalesce(F.get(hs, k + 1)["i"], F.size(ls)) - h["i"] - 1)
    records = lambda ls, hs: F.transform(hs, lambda h, k: let(body(ls, hs, h, k), lambda b: _experience_record(h["line"], b)))
    return let(_kept_lines(section(sections, "EXPERIENCE", "WORK EXPERIENCE")), lambda ls: let(heads(ls), lambda hs: records(ls, hs)))


def _experience_record(heading: Column, body: Column) -> Column:
    parts = F.split(heading, TITLE_COMPANY, 2)
    bullet = f"(?U){BULLET}"

    def of(dated: Column) -> Column:
        line = F.get(body, (dated - 1).cast("int"))
        found = F.transform(F.filter(body, lambda x, i: (i + 1 != dated) & x.rlike(bullet)), lambda x: strip(F.regexp_extract(x, bullet, 1)))
        dates = [F.when(dated > 0, _range_part(line, g)).alias(n) for g, n in ((1, "start_date"), (2, "end_date"))]
        described = lambda b: F.struct(strip(parts[0]).alias("title"), strip(parts[1]).alias("company"), *dates, F.when(F.size(b) > 0, F.array_join(b, " ")).alias("description"), b.alias("bullets"))
        return let(found, described)

    return let(F.array_position(F.transform(body, lambda x: x.rlike(DATE_RANGE)), F.lit(True)), of)


_RECORD = "struct<institution:string,degree:string,field_of_study:string,start_date:string,end_date:string>"


def _state(s: Column, out: Column | None = None, empty: Column | None = None, **new: Column) -> Column:
    """The fold's state with some fields replaced; where ``empty`` holds, the
    others start afresh."""
    fresh = {"institution": F.lit(""), "degree": F.lit("")}
    keep = lambda n: s[n] if empty is None else F.when(empty, fresh.get(n, F.lit(None).cast("string"))).otherwise(s[n])
    fields = [new[n].alias(n) if n in new else keep(n).alias(n) for n in ("institution", "degree", "field_of_study", "start_date", "end_date")]
    return F.struct(*fields, (s["out"] if out is None else out).alias("out"))


def _record(s: Column) -> Column:
    return F.struct(*[s[n].alias(n) for n in ("institution", "degree", "field_of_study", "start_date", "end_date")])


def _education_step(s: Column, x: Column) -> Column:
    has, degree, study = s["institution"] != "", s["degree"] != "", F.coalesce(s["field_of_study"], F.lit("")) != ""
    flushed = F.when(has, F.array_append(s["out"], _record(s))).otherwise(s["out"])
    both = has & degree
    after_degree = F.when(both, F.array_append(s["out"], _record(s))).otherwise(s["out"])
    level = F.regexp_extract(x, SCHOOL_CLASS, 1)
    school = F.when(level != "", level).otherwise(F.when(has, F.lit("")).otherwise(s["degree"]))
    return (
        F.when(x.rlike(DATE_RANGE), F.when(s["start_date"].isNull(), _state(s, start_date=_range_part(x, 1), end_date=_range_part(x, 2))).otherwise(_state(s)))
        .when(x.rlike(r"^\d{4}$"), F.when(has & s["end_date"].isNull(), _state(s, end_date=x)).otherwise(_state(s)))
        .when(x.rlike(r"^\d"), _state(s))
        .when(x.rlike(DEGREE), _state(s, out=after_degree, empty=both, degree=x))
        .when(x.rlike(SCHOOL_BOARD), _state(s, out=flushed, empty=has, institution=x, degree=school))
        .when(~has, _state(s, institution=x))
        .when(~degree | ~study, _state(s, field_of_study=x))
        .otherwise(_state(s))
    )


def education(sections: Column) -> Column:
    """Records by a fold over the section's lines; of records with the same
    institution the one with most filled fields stays, at the first one's place."""
    none = F.lit(None).cast("string")
    start = F.struct(F.lit("").alias("institution"), F.lit("").alias("degree"), none.alias("field_of_study"), none.alias("start_date"), none.alias("end_date"), F.array().cast(f"array<{_RECORD}>").alias("out"))
    end = lambda s: F.when(s["institution"] != "", F.array_append(s["out"], _record(s))).otherwise(s["out"])
    records = F.aggregate(_kept_lines(section(sections, "EDUCATION")), start, _education_step, end)
    filled = lambda r: sum(((F.coalesce(r[n], F.lit("")) != "").cast("int") for n in ("institution", "degree", "field_of_study", "start_date", "end_date")), F.lit(0))
    ranked = F.transform(records, lambda r, i: F.struct(F.lower(strip(r["institution"])).alias("key"), filled(r).alias("n"), (-i).alias("i"), r.alias("r")))
    best = lambda rows, k: F.array_max(F.transform(F.filter(rows, lambda r: r["key"] == k), lambda r: F.struct(r["n"].alias("n"), r["i"].alias("i"), r["r"].alias("r"))))["r"]
    return let(ranked, lambda rows: F.transform(F.array_distinct(F.transform(rows, lambda r: r["key"])), lambda k: best(rows, k)))
