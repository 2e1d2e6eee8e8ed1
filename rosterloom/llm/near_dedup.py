"""Near-duplicate groups by min-max hashing.

A document is the set of its word shingles. For each random permutation both the
least and the greatest image of the set are kept, two values for one evaluation;
each agrees between two sets with the probability of their Jaccard similarity.
Bands of the values bring similar sets into common buckets, and a link counts
only when the full sets confirm it.

Equal sets are one node. Nodes that buckets connect form a cluster, and every
link lies within one, so clusters are settled one by one on full sets, without
pairs ever being listed:

1. a cluster of at most ``CHUNK`` shingles is settled by one task: a search goes
   from node to node through those that no component has yet;
2. a larger one is banded again, more sharply, which parts what only common
   passages hold together;
3. one that is still too large is dealt into chunks. Each is settled by itself,
   and some nodes, the hubs, visit all of them; what has then joined the largest
   component needs no more checks within it, and all others visit every chunk.

So no link between nodes of a cluster is lost. Two linked sets miss each other's
buckets with a probability below 1e-5 at similarity 0.8 (below 2e-5 where step 2
has been at work), less at any higher one. Documents' texts move only if they
share a bucket, once for each chunk that they visit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.llm.common import cut, digest, keep_rows, kept, mapped, sent, slices, texts_of
from rosterloom.llm.words import CASELESS, words_of

WORDS, THRESHOLD = 5, 80
#: Bands and values in each; the second pair is for clusters that are too large for one task.
LEVELS = ((50, 7), (210, 13))
#: Sets with fewer shingles have 8 bands for 5: there the least and the greatest image depend on each other.
SMALL = 48
#: Shingles that one task compares at a time, and nodes that visit all chunks first.
CHUNK, HUBS = 1 << 20, 32
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Of each text the sorted hashes of its distinct shingles of ``words`` words
    (A-Z in lower case, parted by ASCII blanks); a shorter text is one shingle, one
    without words none."""
    each, first = words_of([t.encode("utf-8", "surrogatepass") for t in texts], CASELESS)
    made = np.full(max(len(each) - words + 1, 0), words, np.uint64)
    for i in range(words):
        made = _joined(made, each[i : len(made) + i])
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(made[a : b - words + 1]))
        else:
            whole = np.full(min(b - a, 1), b - a, np.uint64)
            for i in range(a, b):
                whole = _joined(whole, each[i : i + 1])
            out.append(whole)
    return out


def _joined(made: np.ndarray, word: np.ndarray) -> np.ndarray:
    made = (made ^ word) * _MIX
    return made ^ (made >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    return shingle_sets([text or ""], words)[0]


@lru_cache(4)
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(9)
    # drawn in turn, so that fewer permutations are the first of more
    both = rng.integers(0, 1 << 63, (count, 2), dtype=np.uint64)
    return both[:, :1] * np.uint64(2) + np.uint64(1), both[:, 1:].copy()


def signature(made: np.ndarray, count: int) -> np.ndarray:
    """The least and the greatest image of the set under each of ``count``
    permutations: 2 * ``count`` values."""
    odd, plus = _permutations(count)
    low, high = np.full(count, np.iinfo(np.uint64).max, np.uint64), np.zeros(count, np.uint64)
    for a in range(0, len(made), 512):
        images = made[None, a : a + 512] * odd
        images += plus
        np.minimum(low, images.min(1), out=low)
        np.maximum(high, images.max(1), out=high)
    return np.stack([low, high], 1).ravel()


def band_keys(sign: np.ndarray, bands: int) -> np.ndarray:
    """A hash of each band's values and its number."""
    rows = sign.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _MIX
    for k in range(rows.shape[1]):
        key = (key ^ rows[:, k]) * _MIX
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def keys_of(made: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The buckets of a set."""
    bands = bands * 8 // 5 if len(made) < SMALL else bands
    return band_keys(signature(made, -(-bands * rows // 2))[: bands * rows], bands)


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= threshold * (len(a) + len(b) - both)


def _set_id(made: np.ndarray) -> bytes:
    return hashlib.blake2b(made.tobytes(), digest_size=16).digest()


def _sets(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            done = kept(f"bands {words} {bands} {rows}", dict)
            if len(done) > 20_000:
                done.clear()
            n, ids, keys = [], [], []
            for made in shingle_sets(texts_of(batch), words):
                n.append(len(made))
                ids.append(_set_id(made) if len(made) else None)
                if len(made) and ids[-1] not in done:
                    done[ids[-1]] = keys_of(made, bands, rows)
                keys.append(done[ids[-1]] if len(made) else None)
            columns = [batch.column("doc_id"), batch.column("digest"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_shingles", "set_id", "keys"])

    return run


def _fetched(words: int):
    """The sets of wanted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            made = [x.tobytes() for x in shingle_sets(texts_of(batch), words)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], ["node", "shingles"])

    return run


def _banded(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "shingles"):
            keys = [keys_of(np.frombuffer(x, np.uint64), bands, rows) for x in batch.column("shingles").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["node", "keys"])

    return run


class Chunk:
    """Sets that are compared with each other, and with visitors."""

    def __init__(self, sets: list[np.ndarray], threshold: int = THRESHOLD):
        self.threshold, self.sizes = threshold, np.array([len(s) for s in sets], np.int64)
        self.values, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.owner = flat, np.repeat(np.arange(len(sets)), self.sizes)
        self.mark = np.zeros(len(self.values), bool)

    def _linked(self, common: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
        return (common > 0) & (100 * common >= self.threshold * (n + sizes - common))

    def components(self) -> np.ndarray:
        """Of each set the number of the first one it is connected with."""
        label = np.arange(len(self.sizes))
        flat, owner, free = self.flat, self.owner, label
        while True:
            # shingles of one set alone link nothing; a set can link if enough of it is left
            often = np.bincount(flat, minlength=len(self.values)) > 1
            keep = often[flat]
            flat, owner = flat[keep], owner[keep]
            stays = 100 * np.bincount(owner, minlength=len(self.sizes)) >= self.threshold * self.sizes
            some = free[stays[free]]
            if len(some) == len(free):
                break
            free, keep = some, stays[owner]
            flat, owner = flat[keep], owner[keep]
        own = np.searchsorted(owner, np.arange(len(self.sizes) + 1))
        whole, found = flat, np.zeros(len(self.sizes), bool)
        found[free] = True
        queue: list[int] = []
        while len(free):
            if not queue:
                root = int(free[0])
                queue, found[root] = [root], False
                keep = owner != root
                flat, owner, free = flat[keep], owner[keep], free[1:]
            x = queue.pop()
            mine = whole[own[x] : own[x + 1]]
            self.mark[mine] = True
            common = np.bincount(owner[self.mark[flat]], minlength=len(self.sizes))[free]
            self.mark[mine] = False
            new = free[self._linked(common, self.sizes[x], self.sizes[free])]
            if len(new):
                label[new] = root
                queue.extend(new.tolist())
                found[new] = False
                keep = found[owner]
                flat, owner, free = flat[keep], owner[keep], free[found[free]]
        return label

    def visit(self, guest: np.ndarray) -> np.ndarray:
        """Numbers of the sets that ``guest`` is linked with."""
        at = np.minimum(np.searchsorted(self.values, guest), len(self.values) - 1)
        mine = at[self.values[at] == guest]
        self.mark[mine] = True
        common = np.bincount(self.owner[self.mark[self.flat]], minlength=len(self.sizes))
        self.mark[mine] = False
        return np.flatnonzero(self._linked(common, len(guest), self.sizes))


def _settle(threshold: int):
    """Rows (cluster, chunk, guest, node, comp, shingles), sorted by the first four,
    to links (a, b). Sets of one chunk that share a known ``comp`` aren't compared;
    where it is null, they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, comps, sets, chunk, out = None, [], [], [], None, ([], [])

        def add(a: int, b: int) -> None:
            out[0].append(a)
            out[1].append(b)

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])
            out[0].clear()
            out[1].clear()
            return made

        def close() -> Chunk | None:
            """Compares the sets at hand."""
            if len(sets) == 2 and comps[0] is None:
                if linked(*sets, threshold):
                    add(nodes[1], nodes[0])
            elif len(sets) > 1 and comps[0] is None:
                made = Chunk(sets, threshold)
                for i, root in enumerate(made.components().tolist()):
                    if i != root:
                        add(nodes[i], nodes[root])
                return made
            return None

        for batch in slices(batches, "shingles"):
            for cluster, part, guest, node, comp, made in zip(*(batch.column(c).to_pylist() for c in ("cluster", "chunk", "guest", "node", "comp", "shingles"))):
                if (cluster, part) != at:
                    if chunk is None:
                        close()
                    at, nodes, comps, sets, chunk = (cluster, part), [], [], [], None
                if not guest:
                    # a row that stands twice in the table is fetched twice
                    if not nodes or nodes[-1] != node:
                        nodes.append(node)
                        comps.append(comp)
                        sets.append(np.frombuffer(made, np.uint64))
                elif sets:
                    if chunk is None:
                        chunk = close() or Chunk(sets, threshold)
                    met = chunk.visit(np.frombuffer(made, np.uint64)).tolist()
                    # one link to each other component is enough
                    for i in met if comp is None else {comps[i]: i for i in met if comps[i] != comp}.values():
                        add(node, nodes[i])
            yield flush()
        if chunk is None:
            close()
        yield flush()

    return run


class Groups:
    """The state of one run over ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, levels=LEVELS, chunk: int = CHUNK):
        self.docs = docs.select("doc_id", "text", digest().alias("digest"))
        self.words, self.threshold, self.levels, self.chunk = words, threshold, levels, chunk
        key = docs.schema["doc_id"].dataType.simpleString()
        made = mapped(self.docs, _sets(words, *levels[0]), f"doc_id {key}, digest binary, n_shingles long, set_id binary, keys array<long>")
        self.made = cut(made.withColumn("row", F.monotonically_increasing_id()))
        own = self.made.where("n_shingles > 0").groupBy("set_id")
        # copies meet here as one node; partial aggregation combines them before the shuffle
        first = F.min_by(F.struct(F.col("n_shingles").alias("n"), "doc_id", "digest", "keys"), "row")
        self.nodes = cut(own.agg(F.min("row").alias("node"), F.min("doc_id").alias("low"), first.alias("f")).select("set_id", "node", "low", "f.*"))

    def fetch(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes in ``wanted``."""
        rows = wanted.select("node").join(self.nodes.select("node", F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")), "node")
        found = self.docs.join(sent(cut(rows)), F.col("digest").eqNullSafe(F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")))
        return mapped(found.select("node", "text"), _fetched(self.words), "node long, shingles binary")

    def clusters(self, banded: DataFrame) -> DataFrame:
        """(node, cluster): what buckets of ``banded`` (node, keys) connect; nodes
        alone are left out."""
        each = banded.select("node", F.explode("keys").alias("key"))
        full = each.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("_most")).where("least < _most").select("key", "least")
        edges = each.join(full, "key").where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b"))
        return components(edges).withColumnRenamed("comp", "cluster")

    def sizes(self, clusters: DataFrame) -> DataFrame:
        """(cluster, chunks): into how many chunks each is dealt."""
        total = clusters.join(self.nodes.select("node", "n"), "node").groupBy("cluster").agg(F.sum("n").alias("n"))
        return cut(total.select("cluster", F.ceil(F.col("n") / F.lit(self.chunk)).cast("int").alias("chunks")))

    def settle(self, rows: DataFrame) -> DataFrame:
        dealt = rows.repartition("cluster", "chunk").sortWithinPartitions("cluster", "chunk", "guest", "node")
        return mapped(dealt.select("cluster", "chunk", "guest", "node", "comp", "shingles"), _settle(self.threshold), "a long, b long")

    def run(self) -> DataFrame:
        """(node, comp): the least node of each node's component, for nodes with links."""
        clusters = self.clusters(self.nodes.select("node", "keys"))
        sizes = self.sizes(clusters)
        for level in self.levels[1:]:
            large = sizes.where("chunks > 1").select("cluster")
            if large.isEmpty():
                break
            again = clusters.join(large, "cluster", "left_semi")
            sharper = self.clusters(mapped(self.fetch(again), _banded(*level), "node long, keys array<long>"))
            clusters = cut(clusters.join(large, "cluster", "left_anti").select("node", "cluster").unionByName(sharper))
            sizes = self.sizes(clusters)

        placed = clusters.join(sizes, "cluster").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        sets = self.fetch(clusters).join(placed, "node").withColumn("guest", F.lit(False)).withColumn("comp", F.lit(None).cast("long"))
        if sizes.where("chunks > 1").isEmpty():
            # what a chunk links are stars already, whose middle is the least node
            stars = cut(self.settle(sets))
            return stars.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
        sets = cut(sets)
        whole = self.settle(sets.where("chunks = 1"))
        split = sets.where("chunks > 1").drop("guest", "comp")
        home = split.select("cluster", "chunk", F.lit(False).alias("guest"), "node", F.lit(None).cast("long").alias("comp"), "shingles")
        rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64(F.lit("hub"), "node"), "node"))
        hubs = split.join(split.select("cluster", "node").distinct().withColumn("_rank", rank).where(F.col("_rank") <= HUBS).select("node"), "node", "left_semi")
        comps = components(whole.unionByName(self.settle(home.unionByName(_visits(hubs, F.lit(None).cast("long"))))))
        # all pairs that are left have an end outside of the cluster's largest component
        labelled = split.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        labelled = cut(labelled)
        most = labelled.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("_n")).groupBy("cluster").agg(F.max(F.struct("_n", F.col("comp").alias("_c"))).alias("_m"))
        rest = labelled.join(most.select("cluster", F.col("_m._c").alias("_c")), "cluster").where("comp != _c").drop("_c")
        home = labelled.select("cluster", "chunk", F.lit(False).alias("guest"), "node", "comp", "shingles")
        return join_components(comps, cut(self.settle(home.unionByName(_visits(rest, F.col("comp"))))))


def _visits(rows: DataFrame, comp) -> DataFrame:
    """``rows`` as guests in all chunks of their cluster but their own."""
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("chunk"))
    return rows.withColumn("chunk", F.explode(others)).select("cluster", "chunk", F.lit(True).alias("guest"), "node", comp.alias("comp"), "shingles")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (a, b): comp is the least node that
    is connected. Alternates large and small stars; each is an aggregation and a
    join on keys, and the edges shrink to stars in a logarithmic number of turns."""
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    while True:
        # large star: each node's larger neighbours go to its least one
        ways = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: each node and its smaller neighbours go to its least one
        small = large.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("_most"))
        met = large.join(small, "a").select("a", "b", "m", (F.col("m") != F.col("_most")).alias("_moves"))
        each = F.explode(F.array(F.struct("a", F.col("m").alias("b"), "_moves"), F.struct(F.col("b").alias("a"), F.col("m").alias("b"), "_moves")))
        now = cut(met.select(each.alias("e")).select("e.*").where("a != b").groupBy("a", "b").agg(F.max("_moves").alias("_moves")))
        # where every node has one smaller neighbour and none of those has any, the edges are stars
        ends = now.select(F.col("b").alias("_end")).distinct()
        if now.where("_moves").isEmpty() and now.join(ends, F.col("a") == F.col("_end"), "left_semi").isEmpty():
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
            return cut(now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots))
        now = now.select("a", "b")


def join_components(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """``comps`` after more links between nodes."""
    of = lambda name: comps.select(F.col("node").alias(name), F.col("comp").alias(f"c_{name}"))
    lifted = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    moved = components(lifted).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    known = comps.unionByName(lifted.select(F.explode(F.array("a", "b")).alias("node")).withColumn("comp", F.col("node"))).distinct()
    return cut(known.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")).distinct())


def _labelled(docs: DataFrame, words: int, threshold: int, options: dict) -> tuple[DataFrame, DataFrame]:
    """``Groups.made``, and (set_id, comp, low) of every set."""
    groups = Groups(docs, words, threshold, **options)
    comps = groups.run()
    sets = groups.nodes.select("set_id", "node", "low").join(comps, "node", "left")
    return groups.made, sets.select("set_id", F.coalesce("comp", "node").alias("comp"), "low")


def near_groups(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Links join documents whose shingle sets have ``threshold`` percent in common or
    more; component_id is the smallest doc_id that is reachable. A document
    without words is linked with nothing and stays, and so does a row with a null
    doc_id that nothing smaller reaches. Equal texts are in one component, and
    rows that share a doc_id are separate documents. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    made, sets = _labelled(docs, words, threshold, options)
    lows = sets.groupBy("comp").agg(F.min("low").alias("component_id"))
    # a component may hold a third of all sets and a set a third of all rows: both joins can be split
    sets = sets.join(lows, "comp").select("set_id", "component_id")
    out = made.select("doc_id", "n_shingles", "set_id").join(sets, "set_id", "left")
    found = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", found.alias("component_id"), F.col("doc_id").eqNullSafe(found).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, **options) -> DataFrame:
    """One row of each group of ``docs``, with all columns: that whose doc_id is
    smallest (null comes last), then whose text's digest is. Of rows that agree in
    doc_id and text any one stays. Rows without words all stay; an empty table
    gives an empty result. Decisions are sent to the rows; texts don't move."""
    made, sets = _labelled(docs, words, threshold, options)
    rows = made.select("doc_id", "digest", "set_id").join(sets.select("set_id", "comp"), "set_id", "left")
    rank = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "digest")
    best = rows.where("comp is not null").groupBy("comp").agg(F.min(rank).alias("_best"))
    alike = rows.join(best, "comp").select("doc_id", "digest", rank.eqNullSafe(F.col("_best")).alias("stays"))
    return keep_rows(docs, alike)
