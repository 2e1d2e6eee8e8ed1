"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that the contracts name: space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of our own only where none is set and all
    tasks run on this machine."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    if own is None:
        if spark.sparkContext.getCheckpointDir() is None:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rosterloom-"))
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that was written for one run."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the folder that all executors share, so that a lost
    executor never forces (or changes) what has been computed before."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Rows (of identifiers and digests, under 100 bytes each) up to which a join broadcasts them; more are joined by shuffle.
MOST_BROADCAST = 500_000


def sent(rows: DataFrame) -> DataFrame:
    """``rows`` of bounded width (that are cut), broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows


def digest(column: str = "text"):
    """What rows are found again by, besides their doc_id: a table's rows needn't
    come in the same order twice."""
    return F.unhex(F.sha2(F.coalesce(F.col(column), F.lit("")), 256))


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns, by ``rows`` (doc_id, digest,
    stays), one for each. Rows that agree in doc_id and text are alike: of them as
    many stay as decisions say, one at most. Only decisions move, and only
    those that change something."""
    fate = rows.groupBy("doc_id", "digest").agg(F.max("stays").alias("_stays"), F.count(F.lit(1)).alias("_n")).where("not _stays or _n > 1")
    fate = cut(fate.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "_stays"))
    small = sent(fate)
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_own"), digest().alias("_key"))
    same = F.col("_key").eqNullSafe(F.col("_digest")) & F.col("_own").eqNullSafe(F.col("_id"))
    stay = own.join(small, same, "left_anti").select("_row.*")
    if fate.where("_stays").isEmpty():
        return stay
    again = own.join(small.where("_stays"), same).groupBy("_own", "_key").agg(F.first("_row").alias("_row"))
    return stay.unionByName(again.select("_row.*"))


def crc_of_id(column: str = "doc_id"):
    """crc32 of the identifier's decimal text (0 for a null identifier)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in runs of about ``limit`` bytes of ``column`` (one row at
    least), which bounds what a vectorised step holds at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n) + 64
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null is the empty string."""
    return [x or "" for x in batch.column(column).to_pylist()]


_STORES: dict[str, Any] = {}


def kept(name: str, make: Callable[[], Any], beside: tuple[str, ...] = ()) -> Any:
    """What ``make`` gives, kept for all tasks of one Python worker that ask for
    ``name``. Workers live longer than a query, so asking for another name lets
    go of the stores before (but those ``beside``) and returns their memory."""
    found = _STORES.get(name)
    if found is None:
        gone = [n for n in _STORES if n not in beside]
        for n in gone:
            del _STORES[n]
        if gone:
            give_back()
        found = _STORES[name] = make()
    return found


def give_back() -> None:
    """Free memory goes back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


#: Bytes of an Arrow batch on its way to Python or back, where the session sets no bound of its own.
BATCH_BYTES = "4m"


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of bounded bytes, after which a worker
    returns what it has freed."""
    bound, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if bound not in conf.getAll:
        conf.set(bound, BATCH_BYTES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)
