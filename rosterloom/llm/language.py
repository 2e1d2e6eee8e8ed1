"""Language identification by interpolated Kneser-Ney character models.

Each language has a model over runs of letters: for every order, the discounted
probabilities of its n-grams and the back-off weights of their contexts, in
arrays sorted by the n-gram's hash. A text gets the language of the lowest
cross-entropy per character. The confidence and the level above which a text is
rejected as none of the languages are calibrated on a part of the sample that
the models haven't seen.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.llm.common import crc_of_id, mapped, slices, texts_of

#: Documents of each language to learn from on average, drawn by a hash of doc_id.
SAMPLE = 400
ORDER, DISCOUNT = 4, 0.75
_MUL, _ZERO = np.uint64(0x9E3779B97F4A7C15), np.zeros(1, np.uint64)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts and the first place of each text: letters, with one
    space (0) in place of anything between them and at either end; a text without
    letters has a space only."""
    low = [t.lower() for t in texts]
    joined = "\n".join(["", *low, ""])
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kept = np.where(_letters()[chars], chars, 0)
    bounds = np.cumsum([0, *(len(t) + 1 for t in low)])
    keep = (kept != 0) | np.concatenate([[True], kept[:-1] != 0])
    keep[bounds] = True
    return kept[keep], (np.cumsum(keep) - 1)[bounds]


def hashes(chars: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For each order k, the hash of the k characters that end at each place."""
    mixed = (chars.astype(np.uint64) + np.uint64(1)) * _MUL
    mixed ^= mixed >> np.uint64(29)
    out = [mixed]
    for k in range(1, order):
        older = np.zeros_like(mixed)
        older[k:] = mixed[:-k] if k < len(mixed) else 0
        turn = np.uint64(13 * k)
        older = ((older << turn) | (older >> (np.uint64(64) - turn))) * _MUL
        out.append((out[-1] ^ older) + np.uint64(k))
    return out


class Sorted:
    """A map from hashes to numbers, as two arrays sorted by hash."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        at = np.argsort(keys)
        self.keys, self.values = keys[at], values[at].astype(np.float32)

    def get(self, keys: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), missing, np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.float32(missing))


class CharModel:
    """Interpolated Kneser-Ney over ``order`` characters."""

    def __init__(self, texts: list[str], order: int = ORDER, discount: float = DISCOUNT):
        chars, first = encode(texts)
        last = np.zeros(len(chars), bool)
        last[first] = True
        grams = hashes(chars, order)
        # an n-gram must not reach over the start of its text
        back = np.arange(len(chars)) - np.maximum.accumulate(np.where(last, np.arange(len(chars)), 0))
        self.order, self.seen, self.rest = order, [], []
        counts = None
        for k in range(order, 0, -1):
            ok = back >= k - 1 if k > 1 else ~last
            own, ctx = grams[k - 1][ok], (grams[k - 2] if k > 1 else np.zeros_like(grams[0]))
            ctx = np.concatenate([_ZERO, ctx[:-1]])[ok] if k > 1 else np.zeros(ok.sum(), np.uint64)
            keys, at, n = np.unique(own, return_index=True, return_counts=True)
            ctx = ctx[at]
            if k < order:
                # lower orders count the different characters before, not occurrences
                longer = back >= k
                pairs = np.unique(np.stack([grams[k - 1][longer], grams[k][longer]], 1), axis=0)[:, 0] if longer.any() else np.zeros(0, np.uint64)
                n = np.bincount(np.searchsorted(keys, pairs[np.isin(pairs, keys)]), minlength=len(keys))
            n = np.maximum(n, 0).astype(float)
            contexts, inverse = np.unique(ctx, return_inverse=True)
            total = np.bincount(inverse, n, minlength=len(contexts))
            kinds = np.bincount(inverse, n > 0, minlength=len(contexts))
            whole = np.maximum(total, 1e-9)
            self.seen.append(Sorted(keys, np.maximum(n - discount, 0) / whole[inverse]))
            self.rest.append(Sorted(contexts, np.where(total > 0, np.minimum(1, discount * kinds / whole), 1.0)))
            counts = len(keys)
        self.floor = 1.0 / (counts + 200 if counts else 200)

    def log_prob(self, grams: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Natural logarithms of the last characters' probabilities; hashes of
        each order and of the contexts before."""
        p = np.full(len(grams[0]), self.floor, np.float32)
        for k in range(1, self.order + 1):
            i = self.order - k
            p = self.seen[i].get(grams[k - 1], 0.0) + self.rest[i].get(contexts[k - 1], 1.0) * p
        return np.log(np.maximum(p, 1e-12))


class Identifier:
    def __init__(self, models: dict[str, CharModel], sharpness: float = 1.0, level: float = np.inf):
        self.models, self.sharpness, self.level = models, sharpness, level

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts by models) and numbers of characters."""
        chars, first = encode(texts)
        grams = hashes(chars)
        codes, _ = pd.factorize(grams[-1])
        rep = np.zeros(codes.max() + 1, np.int64)
        rep[codes[::-1]] = np.arange(len(codes))[::-1]
        before = [np.zeros_like(grams[0]), *(np.concatenate([_ZERO, g[:-1]]) for g in grams[:-1])]
        some, ctx = [g[rep] for g in grams], [b[rep] for b in before]
        n = np.maximum(np.diff(first) - 1, 0)
        out = np.zeros((len(texts), len(self.models)))
        for j, model in enumerate(self.models.values()):
            sums = np.concatenate([[0.0], np.cumsum(model.log_prob(some, ctx)[codes], dtype=np.float64)])
            # characters after the text's opening space
            out[:, j] = -(sums[first[1:]] - sums[first[:-1] + 1]) / np.maximum(n, 1)
        return out, n

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence and whether the text is rejected; ``und`` with 0 if
        a text has no letter or nothing was learned."""
        names = [*self.models]
        if not names or not texts:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n = self.entropies(texts)
        best = h.argmin(1)
        gap = -(h - h.min(1, keepdims=True)) * self.sharpness * np.sqrt(np.maximum(n, 1))[:, None]
        score = 1 / np.exp(gap).sum(1)
        none = np.array([not any(map(str.isalpha, t)) for t in texts]) if (n < 2).any() else n < 0
        lang = [names[b] if not e else "und" for b, e in zip(best, none)]
        return lang, np.where(none, 0.0, score), none | (h.min(1) > self.level)


def learn(texts: list[str], langs: list[str]) -> Identifier:
    """Models of each language from nine tenths of its texts; the rest calibrates.
    The level of rejection is what one in a thousand of those exceeds."""
    found: dict[str, list[str]] = {}
    for t, lang in zip(texts, langs):
        found.setdefault(lang, []).append(t)
    held = {lang: ts[::10] if len(ts) > 9 else [] for lang, ts in found.items()}
    made = Identifier({lang: CharModel([t for i, t in enumerate(ts) if i % 10 or len(ts) < 10]) for lang, ts in sorted(found.items())})
    test = [(t, lang) for lang, ts in held.items() for t in ts]
    if not test or len(found) < 2:
        return made
    h, n = made.entropies([t for t, _ in test])
    at = np.array([[*made.models].index(lang) for _, lang in test])
    loss = {}
    for s in (0.05, 0.1, 0.2, 0.5, 1, 2, 5, 10, 20):
        gap = -(h - h.min(1, keepdims=True)) * s * np.sqrt(np.maximum(n, 1))[:, None]
        p = np.exp(gap[np.arange(len(at)), at]) / np.exp(gap).sum(1)
        loss[s] = -np.log(np.maximum(p, 0.01)).mean()
    made.sharpness, made.level = min(loss, key=loss.get), float(np.quantile(h.min(1), 0.999)) * 1.05
    return made


def fit(docs: DataFrame, sample: int = SAMPLE) -> Identifier:
    """Learn from about ``sample`` documents of each language that are not held out
    (crc32 of doc_id as text mod 4 is not 2) and have a text and a language. Rows that
    agree in doc_id and text are drawn together; an empty table teaches nothing."""
    known = docs.select("doc_id", "text", F.col("lang").alias("_l")).where("text is not null and _l is not null").where(crc_of_id() % 4 != 2)
    counts = {r[0]: r[1] for r in known.groupBy("_l").count().collect()}
    if not counts:
        return Identifier({})
    part = lambda n: int(min(1.0, sample / n) * (1 << 30))
    rate = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, part(n))])
    some = known.where(F.pmod(F.xxhash64(F.lit("lang"), "doc_id", "text"), F.lit(1 << 30)) < rate[F.col("_l")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(i or 0, t, lang) for b in batches for i, t, lang in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_l")))]
        found.sort()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn([t for _, t, _ in found], [lang for *_, lang in found]))], pa.binary())], ["model"])

    # the sample is bounded: one task learns from it, and only the models come to the driver
    made = mapped(some.repartition(1), run, "model binary").first()
    return pickle.loads(made["model"]) if made else Identifier({})


def identify(docs: DataFrame, model: Identifier) -> DataFrame:
    """``docs`` with ``lang_pred string``, ``score double`` and ``rejected boolean``
    from its texts. ``und`` stands for null texts and those without a letter;
    columns of these names are replaced, others pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("lang_pred", "score", "rejected")
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            lang, score, rejected = sent.value.predict(texts_of(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return mapped(rest, run, schema)
