"""Token-sort similarity: twice the longest common subsequence over the sum of
lengths, in percent, of the sorted tokens.

The subsequence's length is found bit by bit: one number holds a whole row of the
table, so a comparison costs a few operations for each character. Built-in
functions can only fold over the table's cells, which costs their square in
copies; so comparisons run over Arrow batches, and each greedy merge of a record
crosses to Python once.

All pairs of a group's rows are compared block by block: a group's rows are sorted
by key and cut into blocks, each pair of blocks is a row of its own, so a large
group spreads over tasks. Names that differ are compared once a task (as long as
``2 * BLOCK`` of them are about), one against a whole block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and pairs of an Arrow batch on its way back.
BLOCK, PAIRS = 1024, 1 << 17


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for c in b:
        met = row & at.get(c, 0)
        row = (row + met | row - met) & whole
    return len(a) - row.bit_count()


def common_subsequences(left: list[str], right: list[str]) -> np.ndarray:
    """Lengths for each of ``left`` with each of ``right``: the rows of all strings of
    ``left`` side by side, each in one 64-bit number. Longer ones go one by one."""
    out = np.zeros((len(left), len(right)), np.int64)
    short = [i for i, a in enumerate(left) if len(a) <= 64]
    for i in {*range(len(left))} - {*short}:
        out[i] = [common_subsequence(left[i], b) for b in right]
    met_in = set("".join(right))
    bits: dict[str, list[int]] = {}
    for n, i in enumerate(short):
        for k, c in enumerate(left[i]):
            if c in met_in:
                bits.setdefault(c, [0] * len(short))[n] |= 1 << k
    at = {c: np.array(x, np.uint64) for c, x in bits.items()}
    for j, b in enumerate(right):
        row = np.full(len(short), (1 << 64) - 1, np.uint64)
        for c in b:
            if c in at:
                met = row & at[c]
                # bits beyond a string's end stay set
                row = row + met | row - met
        out[short, j] = np.bitwise_count(~row)
    return out


def tokens(text: str) -> str:
    return " ".join(sorted(text.split()))


@lru_cache(100_000)
def _sorted_ratio(a: str, b: str, least: float) -> float:
    if a == b:
        return 100.0
    total = len(a) + len(b)
    # lengths alone bound the ratio
    if not a or not b or 200.0 * min(len(a), len(b)) / total < least:
        return 0.0
    return 200.0 * common_subsequence(a, b) / total


def ratio(a: str | None, b: str | None, least: float = 0) -> float | None:
    """The ratio of two strings, 0 to 100; null if one is. Pairs whose lengths alone
    keep them under ``least`` give 0 without a comparison; equal ones give 100."""
    return None if a is None or b is None else _sorted_ratio(tokens(a), tokens(b), least)


def token_sort_ratio(a: str, b: str) -> Column:
    """Ratio of two columns, by name."""

    @F.pandas_udf("double")
    def each(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([ratio(x, y) for x, y in zip(left, right)], dtype="float64")

    return each(F.col(a), F.col(b))


def _rounded(x: float, digits: int) -> float:
    """As Spark rounds: half up, by the shortest decimal form."""
    return float(Decimal(repr(float(x))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


class _Ratios:
    """Rounded ratios of names (tokens sorted), each found once; beyond ``most`` names
    it starts anew."""

    def __init__(self, digits: int, most: int):
        self.digits, self.most = digits, most
        self.ids: dict[str, int] = {}
        self.known = np.full((most, most), np.nan)

    def of(self, left: list[str], right: list[str]) -> np.ndarray:
        """Of each of ``left`` (in rows) with each of ``right``; ``most`` names at most."""
        if len(self.ids.keys() | {*left, *right}) > self.most:
            self.ids.clear()
            self.known.fill(np.nan)
        i, j = (np.array([self.ids.setdefault(x, len(self.ids)) for x in side]) for side in (left, right))
        open_ = np.isnan(self.known[np.ix_(i, j)])
        rows, columns = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
        if len(rows):
            found = self._compare([left[r] for r in rows], [right[c] for c in columns])
            self.known[np.ix_(i[rows], j[columns])] = found
            self.known[np.ix_(j[columns], i[rows])] = found.T
        return self.known[np.ix_(i, j)]

    def _compare(self, left: list[str], right: list[str]) -> np.ndarray:
        total = np.array([len(a) for a in left])[:, None] + np.array([len(b) for b in right])
        got = 200.0 * common_subsequences(left, right) / np.maximum(total, 1)
        # equal ones, both empty too
        got[np.array(left, object)[:, None] == np.array(right, object)] = 100.0
        values, place = np.unique(got, return_inverse=True)
        return np.array([_rounded(x, self.digits) for x in values])[place].reshape(got.shape)


def pair_ratios(rows: DataFrame, groups: list[str], key: str, name: str, digits: int) -> DataFrame:
    """``a_key long, b_key long, ratio double`` (rounded) of each pair of rows of one
    group with a_key < b_key. Rows with a null among ``groups`` or as key pair with
    none; names aren't null. A group of which all pairs can be had fits a row."""
    session = rows.sparkSession
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if bound not in session.conf.getAll:
        session.conf.set(bound, "4m")
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    whole = rows.dropna(subset=[*groups, key]).groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct(F.col(key).cast("long").alias("k"), F.col(name).alias("n")))).alias("all"))
    first = whole.select(*groups, "all", F.explode(F.sequence(F.lit(1), F.size("all"), F.lit(BLOCK))).alias("i"))
    blocks = first.select(*groups, "all", "i", F.explode(F.sequence("i", F.size("all"), F.lit(BLOCK))).alias("j"))
    sides = [F.slice("all", at, BLOCK).alias(side) for side, at in (("a", F.col("i")), ("b", F.col("j")))]
    # a fixed number of tasks: a block's work is the square of its bytes
    spread = blocks.select(*groups, "i", "j", *sides).repartition(tasks, *groups, "i", "j")
    sent = spread.select("i", "j", *(F.col(f"{s}.{f}").alias(f"{s}_{f}") for s in "ab" for f in "kn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ratios(digits, 2 * BLOCK)
        for batch in batches:
            for r in range(batch.num_rows):
                own = batch.column("i")[r].as_py() == batch.column("j")[r].as_py()
                keys, names = ([batch.column(f"{s}_{f}")[r].values for s in "ab"] for f in "kn")
                a, b = (k.to_numpy(zero_copy_only=False) for k in keys)
                coded = [n.dictionary_encode() for n in names]
                table = known.of(*([tokens(x) for x in n.dictionary.to_pylist()] for n in coded))
                left, right = (n.indices.to_numpy(zero_copy_only=False) for n in coded)
                step = max(1, PAIRS // len(b))
                for at in range(0, len(a), step):
                    # within a block, only what comes after pairs
                    over = at if own else 0
                    x, y = np.broadcast_arrays(a[at : at + step, None], b[over:])
                    pairs = x < y
                    ratio = table[left[at : at + step]][:, right[over:]]
                    yield pa.RecordBatch.from_arrays([pa.array(v[pairs]) for v in (x, y, ratio)], ["a_key", "b_key", "ratio"])

    return sent.mapInArrow(run, "a_key long, b_key long, ratio double")


def fuzzy_union(first: Column, more: Column, threshold: float) -> Column:
    """The strings of ``first`` as they are and each of ``more`` that is like none so
    far, whatever the case; sorted."""

    def one(known: list, new: list) -> list:
        out = list(known)
        low = [None if x is None else tokens(x.lower()) for x in out]
        for x in new:
            key = None if x is None else tokens(x.lower())
            if key is None or not any(k is not None and _sorted_ratio(k, key, threshold) >= threshold for k in low):
                out.append(x)
                low.append(key)
        return sorted(out, key=lambda x: (x is None, x or ""))

    @F.pandas_udf("array<string>")
    def each(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else one(x, y) for x, y in zip(left, right)], dtype=object)

    return each(first, more)


def greedy_picks(left: Column, right: Column, threshold: float) -> Column:
    """For each string of ``left`` in turn, the number of the best one of ``right`` that
    is still free and alike enough (ties: the first), or -1."""

    def one(ours: list, theirs: list) -> list[int]:
        keys, free, out = [tokens(t.lower()) for t in theirs], list(range(len(theirs))), []
        for x in ours:
            key, best, at = tokens(x.lower()), threshold, -1
            for i in free:
                score = _sorted_ratio(key, keys[i], threshold)
                if score > best or score == best and at < 0:
                    best, at = score, i
            out.append(at)
            if at >= 0:
                free.remove(at)
        return out

    @F.pandas_udf("array<int>")
    def each(ours: pd.Series, theirs: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else one(x, y) for x, y in zip(ours, theirs)], dtype=object)

    return each(left, right)
