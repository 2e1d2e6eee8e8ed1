"""Toxicity by subword bags: words share the vectors of their character n-grams,
a text is the average of its words, and a linear softmax reads it.

Vectors and softmax are trained jointly in numpy on a bounded sample of labelled
rows. For scoring, the model folds to one number for each n-gram bucket, which
goes to the executors; each distinct word of a batch is scored once.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.llm.common import crc_of_id, give_back, kept, mapped, slices, texts_of

#: Labelled rows to train on at most, drawn by a hash of doc_id; a bound on the driver's work.
SAMPLE = 12_000
BUCKETS, WIDTH, GRAMS = 1 << 18, 8, (3, 4, 5, 6)
#: Averages are small where a few words of hundreds matter; the softmax reads them on this scale.
SCALE = 40.0
#: Words without a vector that each average holds besides, so that a few words alone say little.
PRIOR = 20
_EDGE = ".,;:!?\"'()[]{}<>|*#%&$-_/\\"


#: A longer run without blanks counts as several words, each of so many characters at most; neighbours overlap by the longest n-gram but one.
LONGEST = 64


def words_of(text: str) -> list[str]:
    words = [w for w in (x.strip(_EDGE) for x in text.lower().split()) if w]
    if len(text) <= LONGEST or max(map(len, words), default=0) <= LONGEST:
        return words
    step = LONGEST - GRAMS[-1] + 1
    return [w[a : a + LONGEST] for w in words for a in range(0, max(len(w) - GRAMS[-1] + 1, 1) if len(w) > LONGEST else 1, step)]


def grams_of(word: str) -> list[int]:
    """Buckets of a word and of its n-grams."""
    data = f"<{word}>"
    found = {zlib.crc32(data.encode("utf-8", "surrogatepass"))}
    for n in GRAMS:
        found.update(zlib.crc32(data[i : i + n].encode("utf-8", "surrogatepass")) for i in range(len(data) - n + 1))
    return [x & (BUCKETS - 1) for x in found]


class Bags:
    """Words as sparse rows of buckets. Sums go over some ``PART`` buckets at a time."""

    PART = 1 << 20

    def __init__(self, words: list[str]):
        flat, sizes = array("i"), array("i")
        for w in words:
            found = grams_of(w)
            flat.extend(found)
            sizes.append(len(found))
        self.flat, self.sizes = np.array(flat, np.int32), np.array(sizes, np.int32)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])

    def _parts(self) -> Iterator[tuple[slice, slice]]:
        a = 0
        while a < len(self.sizes):
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + self.PART, "right")) - 1)
            yield slice(a, b), slice(self.starts[a], self.starts[b])
            a = b

    def mean(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.sizes))
        for some, own in self._parts():
            out[some] = np.add.reduceat(values[self.flat[own]], self.starts[some] - own.start) / self.sizes[some]
        return out

    def spread(self, values: np.ndarray, buckets: int) -> np.ndarray:
        """The transpose of ``mean``."""
        total = np.zeros(buckets)
        for some, own in self._parts():
            total += np.bincount(self.flat[own], np.repeat(values[some] / self.sizes[some], self.sizes[some]), minlength=buckets)
        return total


class Model:
    """``weights``: of each bucket, for label 1 over label 0; ``bias``."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)
        #: scores of words met before
        self.known: dict[str, float] = {}

    def score(self, texts: list[str]) -> np.ndarray:
        counts = [Counter(words_of(t)) for t in texts]
        if len(self.known) > 400_000:
            self.known.clear()
        new = list(dict.fromkeys(w for of in counts for w in of if w not in self.known))
        for a in range(0, len(new), 20_000):
            some = new[a : a + 20_000]
            self.known.update(zip(some, Bags(some).mean(self.weights).tolist()))
        mean, of_word = np.zeros(len(texts)), self.known.__getitem__
        for i, of in enumerate(counts):
            if of:
                weight = np.sqrt(np.fromiter(of.values(), np.float64, len(of)))
                mean[i] = weight @ np.fromiter(map(of_word, of), np.float64, len(of)) / (weight.sum() + PRIOR)
        return 1 / (1 + np.exp(-np.clip(SCALE * mean + self.bias, -30, 30)))


def bag(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Of each text its distinct words: (text, word, weight) by number, the words,
    and each text's sum of weights. A word weighs the root of its count, so that
    one word said a thousand times isn't the whole text."""
    numbers: dict[str, int] = {}
    sizes, words, counts = np.zeros(len(texts), np.int64), array("i"), array("i")
    for i, text in enumerate(texts):
        of = Counter(words_of(text))
        sizes[i] = len(of)
        words.extend([numbers.setdefault(w, len(numbers)) for w in of])
        counts.extend(of.values())
    doc, weight = np.repeat(np.arange(len(texts), dtype=np.int32), sizes), np.sqrt(np.array(counts, np.float32))
    return doc, np.array(words, np.int32), weight, list(numbers), np.bincount(doc, weight, minlength=len(texts)) if len(doc) else np.zeros(len(texts))


def train(texts: list[str], labels: list[int], steps: int = 80, rate: float = 0.05, decay: float = 1e-5, floor: float = 1e-6, seed: int = 1) -> Model:
    """Fit by full-batch Adam on the log loss, on all words of all texts. The rarer
    label's errors weigh more, by the root of the labels' ratio. Without both
    labels the model gives everything the labels' mean."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        mean = float(np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99))
        return Model(np.zeros(BUCKETS), np.log(mean / (1 - mean)))
    doc, word, weight, distinct, sums = bag(texts)
    bags, n_words = Bags(distinct), len(distinct)
    share = (weight / (sums + PRIOR)[doc]) * SCALE
    del weight, distinct

    rng = np.random.default_rng(seed)
    met = np.zeros(BUCKETS, bool)
    met[bags.flat] = True
    used = np.flatnonzero(met)
    bags.flat = (np.cumsum(met, dtype=np.int32) - 1)[bags.flat]
    vec, read = rng.normal(0, 0.1, (len(used), WIDTH)).astype(np.float32), rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
    heavy = np.where(y > 0, np.sqrt((1 - y.mean()) / y.mean()), 1.0)
    heavy /= heavy.sum()
    bias = np.log(np.array([heavy @ (1 - y), heavy @ y]))
    first, second = [[np.zeros_like(p) for p in (vec, read, bias)] for _ in range(2)]
    for step in range(1, steps + 1):
        logit = np.bincount(doc, share * bags.mean(vec @ (read[:, 1] - read[:, 0]))[word], minlength=len(y)) + bias[1] - bias[0]
        off = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * heavy
        down = bags.spread(np.bincount(word, share * off[doc], minlength=n_words), len(used)).astype(np.float32)
        to_read = vec.T @ down
        grads = (np.outer(down, read[:, 1] - read[:, 0]) + decay * vec, np.stack([-to_read, to_read], 1) + decay * read, np.array([-off.sum(), off.sum()]))
        for p, m, v, g in zip((vec, read, bias), first, second, grads):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + floor)).astype(p.dtype)
    weights = np.zeros(BUCKETS)
    weights[used] = vec @ (read[:, 1] - read[:, 0])
    return Model(weights, bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` rows of ``labels`` (doc_id, toxic) that are not
    held out (crc32 of doc_id as text mod 3 is not 1) and have a document. Rows
    with a null label or text don't count."""
    some = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).where("_id is not null and _y is not null")
    some = some.where(crc_of_id("_id") % 3 != 1).orderBy(F.xxhash64(F.lit("tox"), "_id"), "_id", "_y").limit(sample)
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(i, t, y) for b in batches for i, t, y in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_y")))]
        found.sort()
        texts, labels = [t for _, t, _ in found], [y for *_, y in found]
        del found
        model = train(texts, labels)
        del texts
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    # the sample is bounded: one task trains on it, and only the model comes to the driver
    made = mapped(rows.repartition(1), run, "weights binary, bias double").first()
    return Model(np.frombuffer(made["weights"], np.float32), made["bias"]) if made else train([], [])


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score double`` (0 to 1) and ``predicted int``. Null and empty
    texts get the score of an empty bag, which is the model's bias; columns of
    the two names are replaced, others pass through."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    name = f"toxicity {uuid.uuid4().hex}"
    rest = docs.drop("score", "predicted")
    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            # one for each Python worker, over all tasks that it runs
            own = kept(name, lambda: Model(*sent.value))
            got = own.score(texts_of(batch))
            columns = [*batch.columns, pa.array(got, pa.float64()), pa.array((got >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "predicted"])

    return mapped(rest, run, schema)
