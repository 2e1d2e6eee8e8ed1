"""Résumés as a stream: extraction and normalisation are stateless, so new files
become rows as they arrive, and each micro-batch merges with the ATS table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterloom.plans import pipeline


def read_texts(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    rows = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder, wholetext=True)
    return rows.withColumn("path", F.input_file_name()).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("resume_id"), F.col("value").alias("raw_text"))


def resumes(texts: DataFrame, countries: dict[str, str] | None = None) -> DataFrame:
    return pipeline.resumes(texts, countries)


def write_profiles(texts: DataFrame, ats: DataFrame, folder: str, checkpoint: str, config: dict | None = None, once: bool = True) -> StreamingQuery:
    """Profiles of each batch's résumés that match a record, as Parquet by batch,
    so that a batch that is run again replaces its own output."""

    def merge(batch: DataFrame, number: int) -> None:
        found = pipeline.resumes(batch)
        rows = pipeline.pair_up(ats, found, "batch").where("tier is not null")
        pipeline.merge_pairs(rows, config).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = texts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
