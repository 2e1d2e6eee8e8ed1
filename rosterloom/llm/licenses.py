"""Licence scans by ordered signature rules, in DataFrame functions only.

Texts are brought to a canonical form (lower case, one space between words); a
keyword prefilter picks the rules worth trying; their matches become intervals;
a match that lies within a match of a stronger rule, or of an equally strong one
that is longer or listed earlier, is suppressed. Everything is an expression over
one row, so the scan neither shuffles nor leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.license_rules import RULES, Rule, keyword_words

#: What parts words: every ASCII character but digits and, after lower-casing, letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def canonical(text: Column) -> Column:
    """Words parted by single spaces, with a space at either end."""
    # lower() also changes letters beyond A-Z, which stay word characters and stand in no rule; the Kelvin sign alone would become a letter k
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u039a")))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, BETWEEN, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _strings(values: list[str] | None) -> Column:
    return F.lit(None).cast("array<string>") if values is None else F.array(*map(F.lit, values))


def _table(rules: list[Rule]) -> Column:
    """The rules as one constant array."""
    entry = lambda i, r: F.struct(F.lit(i).alias("n"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), _strings(keyword_words(r)).alias("words"), F.lit(f"(?<= ){'(?:' + r.regex + ')'}(?= )").alias("regex"), F.lit(r.base).alias("base"))
    return F.array(*[entry(i, r) for i, r in enumerate(rules)])


#: Matches that are handled together: places add up within a block, then over blocks, so that long texts cost little more a match.
_BLOCK = 64

#: One rule's matches: a fold over the text between them keeps the place in characters and in words.
_SPANS = """
aggregate(
  transform(array(
    transform(filter(arrays_zip(regexp_extract_all({c}, r.regex, 0), split({c}, r.regex, -1)), z -> z['0'] is not null),
      z -> struct(length(z['1']) as gap, length(z['1']) - length(replace(z['1'], ' ', '')) as gaps, length(z['0']) as hit, length(z['0']) - length(replace(z['0'], ' ', '')) as hits))),
    m -> transform(sequence(0, size(m) div {block}), b -> slice(m, b * {block} + 1, {block})))[0],
  struct(0 as at, 0 as word, {none} as found),
  (state, some) -> aggregate(some, struct(state.at as at, state.word as word, {none} as found),
    (e, m) -> struct(
      e.at + m.gap + m.hit as at,
      e.word + m.gaps + m.hits as word,
      array_append(e.found, struct(r.n as n, r.priority as priority, r.label as label, r.base as base,
        e.at + m.gap as start, e.at + m.gap + m.hit as end, e.word + m.gaps - 1 as word)) as found),
    e -> struct(e.at as at, e.word as word, concat(state.found, e.found) as found)),
  state -> state.found)
"""
_NONE = "cast(array() as array<struct<n: int, priority: int, label: string, base: boolean, start: int, end: int, word: int>>)"

#: A match stays unless a stronger one covers it; blocks that reach over neither of its ends are passed over.
_KEPT = """
transform(array(
  transform(sequence(0, size({all}) div {block}), b -> transform(array(slice({all}, b * {block} + 1, {block})),
    s -> struct(s as some, array_min(transform(s, x -> x.start)) as first, array_max(transform(s, x -> x.end)) as last))[0])),
  blocks -> filter({all}, a -> not exists(blocks, k -> k.first <= a.start and k.last >= a.end and exists(k.some, b -> b.start <= a.start and b.end >= a.end and b.n != a.n and (
    b.priority < a.priority or b.priority = a.priority and (b.end - b.start > a.end - a.start or b.end - b.start = a.end - a.start and b.n < a.n))))))[0]
"""


def scan(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``n_words long`` and ``detections``, an array of (label,
    priority, base, start, end, word): places in the canonical text, ``word``
    counted from 0. Base rules are never suppressed.

    A null text is empty and has no words and no detections; texts of any length
    are read whole; other columns pass through (columns of the two names are
    replaced); an empty table gives an empty result.
    """
    from itertools import count

    rest = docs.drop("n_words", "detections")
    own = next(f"_{i}" for i in count() if not any(c.startswith(f"_{i}") for c in docs.columns))
    c, tried, every, kept = (own + n for n in ("canonical", "tried", "all", "kept"))
    rows = rest.withColumn(c, canonical(F.col(text)))
    # one hashed look over a document's words finds the words in which rules can have their keyword; most documents have few of them
    rules = rules or RULES
    asked = sorted({w for r in rules for w in keyword_words(r) or ()})
    there = lambda r, present: (F.isnull(r["words"]) | F.arrays_overlap(r["words"], present)) & F.contains(F.col(c), r["keyword"])
    # bound by a lambda, so that the look is taken once and not again for each rule
    present = F.array_intersect(_strings(asked), F.split(c, " ")) if asked else F.array().cast("array<string>")
    rows = rows.withColumn(tried, F.transform(F.array(present), lambda p: F.filter(_table(rules), lambda r: there(r, p)))[0])
    rows = rows.withColumn("n_words", F.when(F.trim(c) == "", 0).otherwise(_spaces(F.col(c)) - 1).cast("long"))
    rows = rows.withColumn(every, F.expr(f"flatten(transform({tried}, r -> {_SPANS.format(c=c, none=_NONE, block=_BLOCK)}))"))
    rows = rows.withColumn(kept, F.expr(_KEPT.format(all=every, block=_BLOCK)))
    # base rules aren't suppressed, but they suppress
    found = F.concat(F.filter(kept, lambda k: ~k["base"]), F.filter(every, lambda k: k["base"]))
    return rows.select(*rest.columns, "n_words", found.alias("detections"))


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document from ``scan``'s detections. The score is the strength
    of the strongest rule that stays, from 0 (none) to 1."""
    base = F.filter("detections", lambda d: d["base"])
    names = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")
    words = F.transform(base, lambda d: d["word"].cast("long"))
    strongest = F.array_min(F.transform("detections", lambda d: d["priority"]))
    return scanned.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"), names(base).alias("base_labels"), names(F.col("detections")).alias("labels"), F.coalesce(1 - strongest / 100.0, F.lit(0.0)).alias("score"))
