"""Best-fit decreasing packing of token sequences.

Documents become token ids; those longer than a sequence are cut into full
pieces and a rest. Full pieces fill a sequence each. The others are packed
longest first, each into the open bin with the least room that still fits, which
a segment tree over remaining capacities finds in logarithmic time.

Pieces of one length are alike, so the whole table is packed by its lengths'
histogram, at most ``SEQUENCE`` numbers: as long as pieces of one length go to
bins of one room, they are placed together. What comes out is a list of runs,
"so many pieces of this length, from that bin on", whose number depends on the
sequence's size but not on the table's; each piece finds its place by its rank
among those of its length. The packing is that of all pieces at once.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.llm import words
from rosterloom.llm.common import cut, kept, mapped, slices, texts_of

SEQUENCE = 2048


class Capacities:
    """A segment tree over capacities 0..size. At each capacity stand ranges of
    open bins with just that much room; ``tightest(n)`` is the least capacity of n
    or more that has any."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, first: int, bins: int) -> None:
        self.ranges[capacity].append((first, bins))
        self._add(capacity, 1)

    def take(self, capacity: int) -> tuple[int, int]:
        self._add(capacity, -1)
        return self.ranges[capacity].pop()

    def tightest(self, least: int) -> int | None:
        node = least + self.leaves
        if self.count[node]:
            return least
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def plan(counts: dict[int, int], size: int = SEQUENCE) -> np.ndarray:
    """Runs (length, first, bin, each, offset), sorted: from its ``first``-th piece
    on, pieces of ``length`` stand ``each`` to a bin, from ``bin`` on, the first of
    a bin at ``offset``. ``counts`` are the numbers of pieces by length."""
    if any(n < 1 or n > size for n in counts):
        raise ValueError(f"lengths must be from 1 to {size}")
    tree, opened, runs = Capacities(size), 0, []
    for n in sorted(counts, reverse=True):
        done, left = 0, counts[n]
        while left:
            room = tree.tightest(n)
            # a bin that takes a piece is the tightest one for the next, as long as that fits
            if room is None:
                room = size
                first, bins = opened, -(-left // (size // n))
                opened += bins
            else:
                first, bins = tree.take(room)
            each = room // n
            runs.append((n, done, first, each, size - room))
            used = min(bins, -(-left // each))
            whole, some = (used, 0) if left >= used * each else divmod(left, each)
            if whole and room - each * n:
                tree.put(room - each * n, first, whole)
            if some and room - some * n:
                tree.put(room - some * n, first + whole, 1)
            if bins > used:
                tree.put(room, first + used, bins - used)
            done, left = done + min(left, used * each), left - min(left, used * each)
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def places(runs: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of pieces by length and rank among those of their length."""
    key = lambda n, r: n.astype(np.int64) << 44 | r
    at = np.searchsorted(key(runs[:, 0], runs[:, 1]), key(length, rank), "right") - 1
    _, first, bins, each, offset = runs[at].T
    return bins + (rank - first) // each, offset + (rank - first) % each * length


def best_fit_decreasing(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. Equal lengths keep their order."""
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(lengths, kind="stable")
    values, first, counts = np.unique(lengths[order], return_index=True, return_counts=True)
    rank = np.zeros(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths)) - np.repeat(first, counts)
    return places(plan(dict(zip(values.tolist(), counts.tolist())), size), lengths, rank)


@lru_cache(2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: How the vocabulary splits Latin-1 text in lower case; any other text goes to the tokenizer as it is.
_LETTER, _DIGIT, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
_SPLIT = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}{_SPACE}]+")
#: The same for bytes: each one's kind (0 space, 1 letter, 2 digit, 3 mark) and its lower case.
_KIND = np.array([0 if re.match(f"[{_SPACE}]", chr(c)) else 1 if re.match(f"[{_LETTER}]", chr(c)) else 2 if re.match(f"[{_DIGIT}]", chr(c)) else 3 for c in map(ord, (chr(i).lower() for i in range(256)))], np.uint8)
_LOW = np.array([ord(chr(i).lower()) for i in range(256)], np.uint8)
_OF_LOW = words.CASELESS[_LOW]


def _borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts that ``_SPLIT`` finds, for texts side by side."""
    kind = _KIND[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    quotes = np.flatnonzero((data == 39) & new[:-1])
    if len(quotes):
        # an apostrophe that starts a part takes some endings along; what follows is a part of its own
        next1, next2 = _LOW[data[np.minimum(quotes + 1, len(data) - 1)]], _LOW[data[np.minimum(quotes + 2, len(data) - 1)]]
        one = np.isin(next1, np.frombuffer(b"stmd", np.uint8))
        two = ((next1 == 114) | (next1 == 118)) & (next2 == 101) | (next1 == 108) & (next2 == 108)
        new[quotes[one | two] + 1] = False
        new[quotes[one] + 2] = True
        new[quotes[two] + 3] = True
    edges = np.flatnonzero(new)
    some = kind[edges[:-1]] > 0
    return edges[:-1][some], edges[1:][some]


class Encoder:
    """Ids of texts. The vocabulary splits texts into words, digits, marks and runs
    of marks; each distinct part is encoded once. The store of known parts is
    emptied when it is full."""

    def __init__(self, path: str, most: int = 700_000):
        self.tokenizer, self.most = _tokenizer(path), most
        self._empty()

    def _empty(self) -> None:
        # parts of Latin-1 texts by hash, any others as they are
        self.table, self.known = words.Table(), {}
        # each part's first id and number of ids; all ids
        self.first, self.sizes, self.ids = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), array("I")
        self.count = 0

    def _learn(self, parts: list[str]) -> np.ndarray:
        """The numbers of new parts."""
        numbers, at = np.arange(self.count, self.count + len(parts)), self.count
        while len(self.first) < at + len(parts):
            self.first, self.sizes = np.concatenate([self.first, np.zeros_like(self.first)]), np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        for i in range(0, len(parts), 8192):
            got = [e.ids for e in self.tokenizer.encode_batch_fast(parts[i : i + 8192], add_special_tokens=False)]
            sizes, start, end = np.fromiter(map(len, got), np.int32, len(got)), len(self.ids), at + len(got)
            self.ids.extend(chain.from_iterable(got))
            self.sizes[at:end] = sizes
            self.first[at:end] = start + np.cumsum(sizes) - sizes
            at = end
        self.count = at
        return numbers

    def _of_bytes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of parts of Latin-1 texts."""
        keys = words.hashes(data, starts, ends, _OF_LOW)
        got = self.table.get(keys)
        missing = np.flatnonzero(got < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            raw = data.tobytes()
            parts = [raw[a:b].decode("latin-1").lower() for a, b in zip(starts[missing[first]].tolist(), ends[missing[first]].tolist())]
            self.table.add(new, self._learn(parts).astype(np.int32))
            got[missing] = self.table.get(keys[missing])
        return got

    def _of_strings(self, parts: list[str]) -> np.ndarray:
        new = [p for p in dict.fromkeys(parts) if p not in self.known]
        self.known.update(zip(new, self._learn(new).tolist()))
        return np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with id 0 after them."""
        if self.count > self.most:
            self._empty()
        plain, numbers = [], [None] * len(texts)
        for i, t in enumerate(texts):
            latin = _latin(t)
            if latin is None or b"<|" in latin:
                # unusual characters are left to the tokenizer, within the run between blanks
                numbers[i] = self._of_strings([p for w in _BLANK.split(t) if w for p in ([w] if "<|" in w or _latin(w) is None else _SPLIT.findall(w.lower()))])
            else:
                plain.append((i, latin))
        if plain:
            data, bounds = words.side_by_side([x for _, x in plain])
            starts, ends = _borders(data)
            got, at = self._of_bytes(data, starts, ends), np.searchsorted(starts, bounds)
            for (i, _), a, b in zip(plain, at.tolist(), at[1:].tolist()):
                numbers[i] = got[a:b]
        ids, out = np.array(self.ids, np.uint32) if self.count < 4096 else np.frombuffer(self.ids, np.uint32), []
        for of in numbers:
            first, n = self.first[of], self.sizes[of]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(of) else 0
            made = np.zeros(total + 1, np.uint32)
            if total:
                made[:-1] = ids[np.arange(total) + np.repeat(first - ends + n, n)]
            out.append(made)
        return out


_BLANK = re.compile("[ \t\n\x0b\x0c\r]+")


def _latin(text: str) -> bytes | None:
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def _pieces(path: str, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            # for all tasks that a worker runs
            encoder = kept(f"parts of {path}", lambda: Encoder(path))
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, got in enumerate(encoder.encode(texts_of(batch))):
                got = got.astype("<u4", copy=False)
                for k, a in enumerate(range(0, len(got), size)):
                    part = got[a : a + size]
                    rows.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part.view(np.int32))
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """One row per piece of each document of ``docs`` (doc_id, text): its number,
    its place in the document, its length, the crc32 of its ids as little-endian
    unsigned 32-bit numbers and, if wanted, the ids. A null text is empty, and an
    empty one is the single id 0."""
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return mapped(docs.select("doc_id", "text"), _pieces(tokenizer, size, with_ids), schema)


def pack(made: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``made`` (of ``pieces``) with ``sequence_id`` and ``offset``. Sequences are
    gapless from offset 0 and never longer than ``size``. Rows that share doc_id
    and piece are packed as separate pieces; other columns pass through (columns
    of the two names are replaced); an empty table gives an empty result."""
    rest = [f for f in made.schema.fields if f.name not in ("sequence_id", "offset")]
    # columns are numbered, so that no name can clash with those used here
    own = made.select(*(F.col(f.name).alias(f"c{i}") for i, f in enumerate(rest)), F.col("length").alias("_n"))
    own = cut(own.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()))
    # a piece's rank among those of its length: its place in its partition, after all partitions before
    per = cut(own.groupBy("_n", "_part").agg(F.count(F.lit(1)).alias("_c")))
    counts = {r[0]: r[1] for r in per.groupBy("_n").agg(F.sum("_c")).collect()}
    before = F.sum("_c").over(Window.partitionBy("_n").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = per.select(F.col("_n").alias("_n2"), F.col("_part").alias("_part2"), F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = own.withColumn("_at", F.row_number().over(Window.partitionBy("_n", "_part").orderBy("_id")) - 1)
    ranked = ranked.join(starts, (F.col("_n") == F.col("_n2")) & (F.col("_part") == F.col("_part2"))).withColumn("_rank", F.col("_before") + F.col("_at"))
    sent = made.sparkSession.sparkContext.broadcast(plan(counts, size))
    schema = T.StructType([*rest, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = places(sent.value, *(np.asarray(batch.column(c), np.int64) for c in ("_n", "_rank")))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *map(pa.array, got)], schema.names)

    return mapped(ranked.select(*(f"c{i}" for i in range(len(rest))), "_n", "_rank"), run, schema)
