"""Mixing sources to target weights by weighted fair queueing.

Every document is a packet of its source's queue. A source's documents stand in
a shuffled order that a hash fixes; a document's virtual finish time is its
source's cumulative tokens up to it, divided by the source's target. Sorting all
queues by finish time interleaves the sources in proportion to their targets,
and the mix is the head of that order, up to the total budget.

No queue is handled by one task: a source's order is split into runs by the
leading bits of the hash, the runs' sums are added up first, and a document's
cumulative size is its run's start plus the sum within the run. The global order
is cut in the same way, by ranges of the finish time. Only identifiers and sizes
move between executors, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.llm.common import cut, sent

#: Words as the contract counts them; each is a token of the mix.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
EPOCHS = 2
#: Rows that a run of one source's order, or a range of finish times, holds on average.
RUN_ROWS = 4096


def word_count(column: str = "text"):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def fill(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets that divide ``share`` of all sizes by weight; what exceeds ``most``
    times a source's size is shared again among the others, until none exceeds it."""
    total = share * sum(sizes)
    targets, free = [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0]
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if total * weights[i] / whole > most * sizes[i]]
        if not over:
            for i in free:
                targets[i] = total * weights[i] / whole
            break
        for i in over:
            targets[i] = most * sizes[i]
            total -= targets[i]
        free = [i for i in free if i not in over]
    return targets


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, share: float = 1.5, most: int = EPOCHS, run_rows: int = RUN_ROWS) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) for every row.

    ``copies`` is how often the mix takes a document, 0 to ``most``; ``taken`` is
    copies times size. A null text is empty; a document without words has size 0
    and is never taken; an empty table gives an empty result. Rows that share a
    key are separate documents; ties in the hash fall to the key, then the size.
    Other columns are ignored, whatever their names.
    """
    sized = docs.select(F.col(key).alias("_k"), F.col(source).cast("string").alias("_s"), word_count(text).alias("size"))
    sized = cut(sized.withColumn("_h", F.xxhash64(F.lit("mix"), "_k")).withColumn("_sid", F.xxhash64("_s", F.isnull("_s"))))
    sizes = {(r[0] is not None, r[0] or ""): r[1:] for r in sized.groupBy("_s").agg(F.sum("size"), F.count(F.lit(1))).collect()}
    order = sorted(sizes, key=lambda s: (not s[0], s[1]))
    targets = dict(zip(order, fill([sizes[s][0] for s in order], [weights[i % len(weights)] for i in range(len(order))], share, most)))
    n, spark = sum(x[1] for x in sizes.values()), docs.sparkSession
    runs = max(1, n // run_rows)
    small = spark.createDataFrame([(s[1] if s[0] else None, int(sizes[s][0]), float(targets[s])) for s in order], "_src string, source_size long, target double")
    # one row a source; a set of sources too large to broadcast is joined by shuffle
    at = sized.join(F.broadcast(small) if len(order) <= 10_000 else small, F.col("_s").eqNullSafe(F.col("_src")))
    at = at.withColumn("_run", F.floor(F.shiftrightunsigned("_h", 33) * F.lit(float(runs)) / F.lit(float(1 << 31))).cast("long"))

    some = at.where("size > 0")
    starts = some.groupBy("_sid", "_run").agg(F.sum("size").alias("_sum"))
    up_to = Window.partitionBy("_sid").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("_sid", "_run", F.coalesce(F.sum("_sum").over(up_to), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_sid", "_run").orderBy("_h", "_k", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = some.withColumn("_cum", F.sum("size").over(within)).join(starts, ["_sid", "_run"])
    # the second epoch follows the first in the same order; a place in the global order is (finish time, source, epoch)
    place = lambda e: F.struct(((F.col("_start") + F.col("_cum") + e * F.col("source_size")) / F.col("target")).alias("finish"), F.col("_sid").alias("sid"), F.lit(e).alias("epoch"))
    queued = queued.withColumn("_places", F.array(*[place(e) for e in range(most)]))

    ranges = max(1, most * n // run_rows)
    range_of = lambda p: F.floor(p["finish"] * ranges).cast("long")
    packets = queued.select("size", F.explode("_places").alias("_p")).withColumn("_range", range_of(F.col("_p")))
    sums = packets.groupBy("_range").agg(F.sum("size").alias("_sum"))
    # two levels, so that no task sorts all ranges
    sums = cut(sums.withColumn("_part", F.floor(F.col("_range") / 1024)))
    parts = sums.groupBy("_part").agg(F.sum("_sum").alias("_psum"))
    parts = parts.select("_part", F.coalesce(F.sum("_psum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_pstart"))
    inside = Window.partitionBy("_part").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(inside), F.lit(0))).join(parts, "_part").withColumn("_before", F.col("_before") + F.col("_pstart"))
    budget = sum(targets.values())
    edge = sums.where(F.col("_before") + F.col("_sum") > F.lit(budget + 0.5)).orderBy("_range").select("_range", "_before").first()

    last = None
    if edge is not None:
        order = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        head = packets.where(F.col("_range") == edge[0]).withColumn("_at", F.sum("size").over(order))
        last = head.where(F.col("_at") + edge[1] <= F.lit(budget + 0.5)).agg(F.max("_p")).first()[0]
    within_budget = lambda p: F.lit(True) if edge is None else (range_of(p) < edge[0]) if last is None else p <= F.struct(F.lit(last[0]).alias("finish"), F.lit(last[1]).alias("sid"), F.lit(last[2]).alias("epoch"))
    copies = F.size(F.filter("_places", within_budget))
    taken = queued.withColumn("copies", copies).unionByName(at.where("size = 0").withColumn("copies", F.lit(0)), allowMissingColumns=True)
    return taken.select(F.col("_k").alias(key), F.col("_s").alias(source), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as taken. Rows that
    agree in key, source and size share their copies out by order of appearance.
    Nulls, documents without words and empty tables are as in ``mix``. Counts are
    sent to the rows; texts don't move while the counts can be broadcast."""
    key, text, source = (options.get(k, v) for k, v in (("key", "doc_id"), ("text", "text"), ("source", "source")))
    counts = cut(mix(docs, **options).select(F.col(key).alias("_k"), F.col(source).alias("_s"), F.col("size").alias("_n"), F.col("copies").alias("_c")))
    alike = counts.groupBy("_k", "_s", "_n").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_k2"), F.col(source).cast("string").alias("_s2"), word_count(text).alias("_n2"))
    met = F.expr("_k2 <=> _k and _s2 <=> _s and _n2 = _n")
    taken = rows.join(sent(cut(alike.where("_lo = _hi and _lo > 0").select("_k", "_s", "_n", F.col("_lo").alias("_c")))), met).select("_row", "_c")
    uneven = cut(alike.where("_lo < _hi").select("_k", "_s", "_n"))
    if not uneven.isEmpty():
        ranked = lambda df, cols, last: df.withColumn("_i", F.row_number().over(Window.partitionBy(*cols).orderBy(last)))
        some = ranked(counts.join(sent(uneven).select(F.col("_k").alias("_k2"), F.col("_s").alias("_s2"), F.col("_n").alias("_n2")), met, "left_semi"), ("_k", "_s", "_n"), F.desc("_c")).where("_c > 0")
        own = ranked(rows.join(sent(uneven), met, "left_semi"), ("_k2", "_s2", "_n2"), F.monotonically_increasing_id()).withColumnRenamed("_i", "_i2")
        taken = taken.unionByName(own.join(some, met & F.expr("_i2 = _i")).select("_row", "_c"))
    return taken.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("_c")))).select("_row.*")
