"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network sees the tokens on both sides of a place, not the one that stands
there, and gives each token of the vocabulary a probability for it. A document's
score is the sum of the logarithms over all its places.

Counts of all words of the corpus stay in a distributed table. A word's
probability has two levels: the network gives its class (the most frequent words
are classes of their own, all others share buckets by hash), and the counts give
the word within its class, so that every word is predicted as itself; one count
in each class is left for words that the corpus doesn't hold. Each executor holds
the counts of the ``KNOWN`` most frequent words; those of all others are joined
from the table. Around a place, words of ``LEAST`` occurrences or more (the
``VECTORS`` most frequent at most) have vectors of their own; rarer words share
their bucket's. Words are told apart by 64-bit hashes of their lower case.

The network is trained in numpy where the documents are: every task masks every
``ROUNDS``-th place of each of its documents and trains a copy; the copies are
averaged, weighted by places, in a tree of aggregations, and the next round goes
on from the average with the next places, until each place has been a target once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.llm.common import cut, mapped, slices, texts_of
from rosterloom.llm.words import Table, words_of

WORDS, BUCKETS, WIDTH = 256, 64, 16
SIDE = 3
#: Occurrences from which a word has a vector of its own, and how many have one at most: the network's size, which every copy has.
LEAST, VECTORS = 2000, 16_384
#: Words whose counts the executors hold; a bound on memory, not on the words that are counted.
KNOWN = 65_536
#: One place in so many is masked in each round, in each round others.
ROUNDS = 2
BATCH, RATE = 2048, 0.05
#: Copies that one step of averaging takes together.
FAN = 16
#: Distinct words that a task counts before it passes them on.
HELD = 200_000


def hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of the words of all texts (lower case, parted by space, tab to carriage return),
    and the number of words before each text (and in all)."""
    return words_of([t.lower().encode("utf-8", "surrogatepass") for t in texts])


class Vocabulary:
    """``known`` are the hashes of the most frequent words, the first ``vectors`` of
    which are tokens of their own and the first ``classes`` of these classes of
    their own; ``bucket_sizes`` are the occurrences of all words that aren't."""

    def __init__(self, known: np.ndarray, counts: np.ndarray, bucket_sizes: list[int], vectors: int | None = None, classes: int = WORDS):
        known, self.buckets = np.asarray(known, np.uint64), len(bucket_sizes)
        self.words = len(known) if vectors is None else vectors
        self.table = Table()
        self.table.add(known, np.arange(len(known), dtype=np.int32))
        #: the last token stands for the places before and after a text
        self.size = self.words + self.buckets + 1
        own = min(self.words, classes)
        self.classes = own + self.buckets + 1
        bucket = self._bucket(known)
        #: class of each token
        self.class_of = np.array([*range(own), *(own + bucket[own : self.words]), *range(own, self.classes)], np.int32)
        whole = np.log(np.asarray(bucket_sizes, float) + 1)
        #: of each known word: token, and log probability in its class
        place = np.arange(len(known))
        self.token_of = np.where(place < self.words, place, self.words + bucket).astype(np.int32)
        self.share_of = np.where(place < own, 0.0, np.log(np.maximum(counts, 1)) - whole[bucket]) if len(known) else np.zeros(0)
        #: of a word that isn't known; its count comes on top
        self.share_of_rare = -whole

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(self.buckets - 1)).astype(np.int32)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words by hash: tokens, log probabilities within their classes, and which
        of them aren't known."""
        at, bucket = self.table.get(keys), self._bucket(keys)
        rare = at < 0
        tokens, share = self.words + bucket, self.share_of_rare[bucket]
        tokens[~rare], share[~rare] = self.token_of[at[~rare]], self.share_of[at[~rare]]
        return tokens, share, rare

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        keys, first = hashes(texts)
        return np.split(self.look_up(keys)[0], first[1:-1]) if texts else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def together() -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)

    def row() -> pa.RecordBatch:
        keys, n = together()
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["h", "n"])

    held, size = [], 0
    for batch in slices(batches, "text", 1 << 20):
        held.append(np.unique(hashes(texts_of(batch))[0], return_counts=True))
        size += len(held[-1][0])
        if size > HELD:
            held = [together()]
            size = len(held[0][0])
            if 2 * size > HELD:
                yield row()
                held, size = [], 0
    if held:
        yield row()


def vocabulary(docs: DataFrame, words: int = WORDS, buckets: int = BUCKETS, least: int = LEAST, vectors: int = VECTORS, known: int = KNOWN) -> tuple[Vocabulary, DataFrame]:
    """From the counts of all words of all documents, with a table (h, n) of the
    hashes and counts of those that aren't known. Only the ``known`` most frequent
    words and one number for each bucket (a power of two) reach the driver."""
    sums = mapped(docs, _counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = cut(sums)
    # the least count from which there are at most so many words, by a histogram of counts
    steps = counts.groupBy(F.floor(F.log2("n") * 16).alias("s")).agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n")).orderBy(F.desc("s")).collect()
    fits = [r["n"] for r, upto in zip(steps, accumulate(r["c"] for r in steps)) if upto <= known]
    often = F.col("n") >= (fits[-1] if fits else (1 << 62))
    top = sorted(((r["h"], r["n"]) for r in counts.where(often).collect()), key=lambda x: (-x[1], x[0]))
    sizes = {r[0]: r[1] for r in counts.groupBy(F.col("h").bitwiseAND(F.lit(buckets - 1))).agg(F.sum("n")).collect()}
    vectors = min(vectors, sum(n >= least for _, n in top))
    for h, n in top[: min(words, vectors)]:
        sizes[h & (buckets - 1)] -= n
    made = Vocabulary(np.array([h for h, _ in top], np.int64).view(np.uint64), np.array([n for _, n in top]), [int(sizes.get(b, 0)) for b in range(buckets)], vectors, words)
    return made, counts.where(~often)


class Network:
    """Log-bilinear window network with one hidden layer:
    softmax(out @ tanh(sum over sides of place[side] * vector[token]) + bias),
    over ``classes`` (default: all tokens)."""

    def __init__(self, size: int, width: int = WIDTH, side: int = SIDE, seed: int = 5, classes: int | None = None):
        rng = np.random.default_rng(seed)
        self.size, self.width, self.side = size, width, side
        self.vector = rng.normal(0, 0.3, (size, width)).astype(np.float32)
        self.place = rng.normal(1.0 / (2 * side), 0.1, (2 * side, width)).astype(np.float32)
        self.out = rng.normal(0, 0.1, (classes or size, width)).astype(np.float32)
        self.bias = np.zeros(classes or size, np.float32)
        self._rooms: dict[str, np.ndarray] = {}

    def parameters(self) -> list[np.ndarray]:
        return [self.vector, self.place, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for p in self.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """Memory that is used again: fresh pages cost more than what is written to them."""
        found = self._rooms.get(name)
        if found is None or len(found) < shape[0]:
            found = self._rooms[name] = np.empty(shape, np.float32)
        return found[: shape[0]]

    def _spread(self) -> np.ndarray:
        """Each side's ``place`` on a diagonal, one below the other: a product with all
        vectors around, side by side, weighs and adds them."""
        return (self.place[:, :, None] * np.eye(self.width, dtype=np.float32)).reshape(-1, self.width)

    def _beside(self) -> np.ndarray:
        """``out`` and, as its last column, ``bias``."""
        return np.concatenate([self.out, self.bias[:, None]], 1)

    def _hidden(self, around: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and a column of ones, and the vectors around, side by side."""
        n = len(around)
        near = self.vector.take(around, 0, out=self._room("near", n, 2 * self.side, self.width), mode="clip").reshape(n, -1)
        h = self._room("hidden", n, self.width + 1)
        np.tanh(np.matmul(near, spread, out=self._room("total", n, self.width)), out=h[:, :-1])
        h[:, -1] = 1
        return h, near

    def _safe(self) -> bool:
        """Hidden values are within 1, so this bounds all logits; small ones need no shift."""
        return float((np.abs(self.out).sum(1) + np.abs(self.bias)).max()) < 60

    def log_probs(self, around: np.ndarray, target: np.ndarray, part: int = 512) -> np.ndarray:
        """Of each target given what stands around, in parts that fit a core's cache."""
        got = np.zeros(len(target), np.float32)
        safe, spread, beside = self._safe(), self._spread(), self._beside()
        ones = np.ones(len(beside), np.float32)
        for a in range(0, len(target), part):
            own = target[a : a + part]
            h, _ = self._hidden(around[a : a + part], spread)
            logit = np.matmul(h, beside.T, out=self._room("logit", len(own), len(beside)))
            if not safe:
                logit -= logit.max(1, keepdims=True)
            got[a : a + part] = logit[np.arange(len(own)), own]
            got[a : a + part] -= np.log(np.exp(logit, out=logit) @ ones)
        return got

    def step(self, around: np.ndarray, target: np.ndarray, sums: list[np.ndarray], rate: float, part: int = 512) -> None:
        """One Adagrad step on the mean loss of a batch."""
        n, safe, spread, beside = len(target), self._safe(), self._spread(), self._beside()
        h, near = self._hidden(around, spread)
        down, both, ones = self._room("down", n, self.width), np.zeros_like(beside), np.ones(len(beside), np.float32)
        for a in range(0, n, part):
            some, own = h[a : a + part], target[a : a + part]
            p = np.matmul(some, beside.T, out=self._room("logit", len(own), len(beside)))
            if not safe:
                p -= p.max(1, keepdims=True)
            total = np.exp(p, out=p) @ ones
            # the narrow sides of the products are scaled, not p
            p[np.arange(len(own)), own] -= total
            scale = (1 / (n * total))[:, None]
            np.multiply(p @ self.out, scale, out=down[a : a + part])
            both += p.T @ (some * scale)
        down *= 1 - h[:, :-1] ** 2
        place = np.einsum("jkj->kj", (down.T @ near).reshape(self.width, 2 * self.side, self.width))
        parts = np.matmul(down, spread.T, out=self._room("parts", n, 2 * self.side * self.width)).reshape(-1, self.width)
        # vectors that stand nowhere around have no gradient and stay
        flat = around.ravel()
        # few enough tokens are sorted by their digits
        order = np.argsort(flat.astype(np.uint16) if self.size < 1 << 16 else flat, kind="stable")
        flat = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        apart = parts.take(order, 0, out=self._room("sorted", *parts.shape), mode="clip")
        # two numbers are added at a time, where the width allows that
        pairs = apart.view(np.complex64) if self.width % 2 == 0 else apart
        used, vector = flat[starts], np.add.reduceat(pairs, starts).view(np.float32)
        met = sums[0].take(used, 0) + vector * vector
        sums[0][used] = met
        self.vector[used] -= rate * vector / np.sqrt(met + 1e-8)
        for w, g, s in zip(self.parameters()[1:], (place, both[:, :-1], both[:, -1]), sums[1:]):
            s += g * g
            w -= rate * g / np.sqrt(s + 1e-8)


def windows(ids: list[np.ndarray], edge: int, turn: int = 0, turns: int = 1, side: int = SIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of all texts (with ``turns``, every ``turns``-th of each text from
    the ``turn``-th on): the tokens around, the token, and the text's number.
    Texts are parted by enough edge tokens that no window reaches over."""
    gap, outside = np.full(side, edge, np.int32), np.full(side, -1, np.int32)
    flat = np.concatenate([gap, *(p for x in ids for p in (np.asarray(x, np.int32), gap))])
    owner = np.concatenate([outside, *(p for i, x in enumerate(ids) for p in (np.full(len(x), i, np.int32), outside))])
    at = np.flatnonzero(owner >= 0)
    if turns > 1:
        sizes = np.array([len(x) for x in ids], np.int64)
        first = np.cumsum(sizes + side) - sizes
        at = at[(at - first[owner[at]]) % turns == turn]
    offsets = np.array([*range(-side, 0), *range(1, side + 1)])
    return flat[at[:, None] + offsets], flat[at], owner[at]


def _train(words: Vocabulary, flat: np.ndarray | None, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        net = Network(words.size, classes=words.classes)
        if flat is not None:
            net.load(flat)
        sums = [np.full_like(p, 1e-4) for p in net.parameters()]
        places, held = 0, []

        def learn(last: bool) -> list:
            around, target = (np.concatenate(x) for x in zip(*held))
            n = len(target) if last else len(target) // BATCH * BATCH
            for a in range(0, n, BATCH):
                net.step(around[a : a + BATCH], target[a : a + BATCH], sums, RATE)
            return [(around[n:], target[n:])] if n < len(target) else []

        for batch in slices(batches, "ids", 1 << 20):
            ids = [np.frombuffer(x, np.int32) for x in batch.column("ids").to_pylist()]
            around, target, _ = windows(ids, words.size - 1, turn, ROUNDS)
            held.append((around, words.class_of[target]))
            places += len(target)
            if sum(len(t) for _, t in held) >= 4 * BATCH:
                held = learn(False)
        if held and sum(len(t) for _, t in held):
            learn(True)
        if places:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([places], pa.int64()), pa.array([(net.flat().astype(np.float64) * places).tobytes()], pa.binary())], ["part", "places", "sums"])

    return run


def _add_up(key, rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float64) for x in rows["sums"])
    return pd.DataFrame({"part": [key[0]], "places": [rows["places"].sum()], "sums": [total.tobytes()]})


def average(copies: DataFrame, parts: int) -> np.ndarray | None:
    """The weighted mean of the copies; none of the groups that are added up, nor
    what the driver gets, holds more than ``FAN`` copies."""
    while parts > 1:
        parts = math.ceil(parts / FAN)
        level = copies.withColumn("part", F.floor(F.col("part") / FAN))
        copies = level.groupBy("part").applyInPandas(_add_up, "part long, places long, sums binary")
    rows = copies.collect()
    return (sum(np.frombuffer(r["sums"], np.float64) for r in rows) / sum(r["places"] for r in rows)).astype(np.float32) if rows else None


def _encoded(words: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in words.encode(texts_of(batch))], pa.binary())], ["ids"])

    return run


def fit(docs: DataFrame) -> tuple[Vocabulary, DataFrame, np.ndarray | None]:
    """Vocabulary, counts of rare words and parameters from all texts of ``docs``;
    None without words."""
    texts = docs.select("text").where("text is not null")
    (words, rare), flat = vocabulary(texts), None
    ids = cut(mapped(texts, _encoded(words), "ids binary"))
    parts = ids.rdd.getNumPartitions()
    for turn in range(ROUNDS):
        copies = mapped(ids, _train(words, flat, turn), "part long, places long, sums binary")
        got = average(copies, parts)
        flat = flat if got is None else got
    return words, rare, flat


def score(docs: DataFrame, model: tuple[Vocabulary, DataFrame, np.ndarray | None], without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``n_tokens long``, ``log_likelihood double`` (the sum over all
    places) and ``mean_log_prob double``. A null text is empty; an empty one has
    0 tokens and zeros. Columns of these names are replaced, others pass through
    but those in ``without``."""
    words, counts, flat = model
    sent = docs.sparkSession.sparkContext.broadcast((words, flat))
    rest = docs.drop("n_tokens", "log_likelihood", "mean_log_prob")
    kept = [f for f in rest.schema.fields if f.name not in without]
    # passed columns are numbered, so that their names can't clash with those used here
    own = "n long, sum double, rare array<long>"
    schema = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)), *T._parse_datatype_string(own).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, flat = sent.value
        net = Network(words.size, classes=words.classes)
        if flat is not None:
            net.load(flat)
        for batch in slices(batches, "text", 1 << 20):
            keys, first = hashes(texts_of(batch))
            ids, share, unknown = words.look_up(keys)
            around, target, owner = windows(np.split(ids, first[1:-1]), words.size - 1)
            sums = np.bincount(owner, net.log_probs(around, words.class_of[target]) + share, minlength=batch.num_rows)
            # rare words of each text, side by side
            before = np.concatenate([[0], np.cumsum(unknown)])[first]
            rare = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(keys[unknown].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(np.diff(first).astype(np.int64)), pa.array(sums), rare], schema.names)

    made = cut(mapped(rest, run, schema).withColumn("row", F.monotonically_increasing_id()))
    # the KNOWN words before are all more frequent, so no key is heavy
    met = made.select("row", F.explode("rare").alias("h")).join(counts, "h")
    more = met.groupBy("row").agg(F.sum(F.log(F.col("n").cast("double"))).alias("more"))
    total = F.col("sum") + F.coalesce("more", F.lit(0.0))
    columns = [F.col(f"c{i}").alias(f.name) for i, f in enumerate(kept)]
    return made.drop("rare").join(more, "row", "left").select(*columns, F.col("n").alias("n_tokens"), total.alias("log_likelihood"), (total / F.greatest("n", F.lit(1))).alias("mean_log_prob"))
