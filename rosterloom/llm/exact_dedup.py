"""Exact deduplication by content-defined chunk recipes.

A text without white space is cut where a rolling hash of its last bytes says so,
so equal passages are cut alike wherever they stand. A document becomes a recipe:
the ordered list of its chunks' identifiers. Documents are equal exactly if their
recipes are, and only recipes, eight bytes for about a kilobyte of text, move to
be compared.

Identifiers are verified before any comparison counts: each comes with the
SHA-256 of its chunk's content, every pair once per map task, and where two
contents share an identifier the digests take its place in the recipes. So a text
is read once, where it lies, and no chunk ever moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.common import BLANKS, cut, digest, keep_rows, mapped, slices, texts_of

MEAN_BITS = 10
LEAST, MOST = 256, 8192
_GEAR = np.random.default_rng(6).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes that end at each position, by doubling."""
    h = _GEAR[data]
    for span in (1, 2, 4, 8, 16):
        older = np.zeros_like(h)
        older[span:] = h[:-span] << np.uint32(span)
        h = h + older
    return h


def edges(data: bytes, bits: int = MEAN_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of ``data``; they depend on nearby bytes only."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    top = np.flatnonzero(rolling(np.frombuffer(data, np.uint8)) >> np.uint32(32 - bits) == 0) + 1
    ends, start = [], 0
    for e in [*top.tolist(), n]:
        while e - start > most:
            start += most
            ends.append(start)
        if e - start >= least or (e == n and e > start):
            start = e
            ends.append(e)
    return ends


def chunks(data: bytes, **sizes) -> list[bytes]:
    ends = edges(data, **sizes)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def squeeze(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(None, BLANKS.encode())


def _recipes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, recipe, sums, sha = texts_of(batch), [], [], []
            for text in texts:
                data = squeeze(text)
                parts = chunks(data)
                each = [hashlib.sha256(c).digest() for c in parts]
                recipe.append(b"".join(d[:width] for d in each))
                sums.append(b"".join(each))
                sha.append(each[0].hex() if len(each) == 1 else hashlib.sha256(data).hexdigest())
            columns = [batch.column("doc_id"), batch.column("digest"), pa.array([len(t) for t in texts], pa.int64()), pa.array(recipe, pa.binary()), pa.array(sums, pa.binary()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_points", "recipe", "sums", "text_sha256"])

    return run


def recipes(docs: DataFrame, width: int = 8) -> DataFrame:
    """(doc_id, digest, n_points, recipe, sums, text_sha256) for every row: the ordered
    identifiers of its chunks, ``width`` bytes each, and their SHA-256."""
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", digest().alias("digest"))
    return mapped(rows, _recipes(width), f"doc_id {key}, digest binary, n_points long, recipe binary, sums binary, text_sha256 string")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "sums"):
        found = {s[i : i + 32] for s in batch.column("sums").to_pylist() for i in range(0, len(s), 32)}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], ["sum"])


def clashes(made: DataFrame, width: int = 8) -> DataFrame:
    """Identifiers with more than one content (normally none). Partial aggregation
    leaves a passage of a third of all rows once for each map task."""
    found = mapped(made.select("sums"), _pairs, "sum binary").distinct()
    return found.groupBy(F.substring("sum", 1, width).alias("chunk_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("chunk_id")


def _renamed(bad: list[bytes], width: int):
    """Recipes in which identifiers that clash are replaced by whole digests."""
    worst = set(bad)

    def name(d: bytes) -> bytes:
        return b"\1" + d if d[:width] in worst else b"\0" + d[:width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sums"):
            out = [b"".join(name(s[i : i + 32]) for i in range(0, len(s), 32)) for s in batch.column("sums").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("recipe"), "recipe", pa.array(out, pa.binary()))

    return run


def _grouped(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept, text_sha256) for every row."""
    made = cut(recipes(docs, width))
    bad = [bytes(r[0]) for r in clashes(made, width).limit(100_001).collect()]
    if len(bad) > 100_000:
        # so narrow an identifier can't serve; a wider one takes its place
        return _grouped(docs, width * 2)
    if bad:
        made = cut(mapped(made, _renamed(bad, width), made.schema))
    # a long document's recipe is compared by the digest of its ordered identifiers and their number
    made = made.select("doc_id", "digest", "n_points", "text_sha256", F.unhex(F.sha2("recipe", 256)).alias("_r"), F.length("recipe").alias("_len"), F.monotonically_increasing_id().alias("_row"))
    best = F.min(F.struct((-F.col("n_points")).alias("a"), F.isnull("doc_id").alias("b"), F.col("doc_id").alias("c"), F.col("_row").alias("d")))
    groups = made.groupBy("_r", "_len").agg(best.alias("_best"), F.count(F.lit(1)).alias("group_size"))
    # a group may hold a third of all rows: the join deals such a key out over tasks (AQE), the aggregation combines it before the shuffle
    return made.join(groups, ["_r", "_len"]).select("doc_id", "digest", F.col("_best.c").alias("keep_id"), "group_size", (F.col("_row") == F.col("_best.d")).alias("kept"), "text_sha256")


def exact_groups(docs: DataFrame, width: int = 8) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when they are identical without white space; null counts as
    empty, and all empty texts are equal. The row with most code points stays,
    then that with the smallest doc_id. Of rows that also share a doc_id, one is
    marked kept. A null doc_id comes after all others. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    return _grouped(docs, width).drop("digest")


def drop_copies(docs: DataFrame, width: int = 8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; outcomes for nulls,
    ties, repeated rows and empty tables are those of ``exact_groups``."""
    return keep_rows(docs, _grouped(docs, width).select("doc_id", "digest", F.col("kept").alias("stays")))
