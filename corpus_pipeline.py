"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet to the folder that all executors share, and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rosterloom.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from rosterloom.llm.common import remove, shared_folder, table
from rosterloom.llm.queries import tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.where("predicted = 0").select(*docs.columns)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the longest as written stays."""
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; shingles of five words, similarity 0.8."""
    return near_dedup.drop_near_copies(docs, words=5, threshold=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document with its place in a sequence."""
    return packing.pack(packing.pieces(docs, tokenizer_path(), with_ids=False))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the classifier nor the packing; tests compare run() with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, read from its folder; the folders between are deleted."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
        if k:
            remove(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
