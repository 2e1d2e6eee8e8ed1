"""Scans of ATS records and résumé documents. A file that can't be read is a row
with a defined value, never a failed job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.schemas import ATS

Reader = Callable[[SparkSession, str], DataFrame]
UNKNOWN = "UNKNOWN"


def is_absent(error: AnalysisException) -> bool:
    """Whether a path that isn't there is all that is wrong."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_ats(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row for each JSON object (one object a file). Unknown keys are dropped;
    a malformed file, or a path that isn't there, is the candidate UNKNOWN.
    ``invalid`` marks records without a candidate_id, which callers refuse (see
    ``require_ids``)."""
    schema = T.StructType([*ATS.fields, T.StructField("_corrupt", T.StringType())])
    try:
        raw = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        nothing = [F.lit(UNKNOWN if f.name == "candidate_id" else None).cast(f.dataType).alias(f.name) for f in ATS.fields]
        return spark.range(1).select(*nothing, F.lit(False).alias("invalid"), F.lit(str(path)).alias("path"))
    bad = F.col("_corrupt").isNotNull()
    rows = raw.withColumn("candidate_id", F.when(bad, UNKNOWN).otherwise(F.col("candidate_id")))
    nulled = [F.when(~bad, F.col(f.name)).alias(f.name) if f.name != "candidate_id" else F.col("candidate_id") for f in ATS.fields]
    return rows.select(*nulled, F.col("candidate_id").isNull().alias("invalid"), F.input_file_name().alias("path"))


def read_ats_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The batch form: JSON lines, which split over tasks; one record a line."""
    schema = T.StructType([*ATS.fields, T.StructField("_corrupt", T.StringType())])
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    rows = raw.withColumn("candidate_id", F.when(F.col("_corrupt").isNotNull(), UNKNOWN).otherwise(F.col("candidate_id")))
    return rows.drop("_corrupt").withColumn("invalid", F.col("candidate_id").isNull())


def require_ids(ats: DataFrame) -> DataFrame:
    """Fails the job at the first record without a candidate_id."""
    checked = F.when(F.col("candidate_id").isNull(), F.raise_error(F.lit("candidate_id is required"))).otherwise(F.col("candidate_id"))
    return ats.withColumn("candidate_id", checked.cast("string"))


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(resume_id, path, raw_text) of text files, each whole."""
    rows = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    return rows.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("resume_id"), "path", F.coalesce("value", F.lit("")).alias("raw_text"))


def read_documents(spark: SparkSession, path: str | list[str], pdf_text: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """Documents of any kind: .txt as it is; any other suffix goes to ``pdf_text``,
    which returns the texts of a file's pages and may be any installed library. A
    file that it can't read, or no such hook, is the empty text."""
    from collections.abc import Iterator

    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path, content in zip(f["path"], f["content"]):
                try:
                    text = content.decode("utf-8") if path.lower().endswith(".txt") else "\n".join(pdf_text(bytes(content))) if pdf_text else ""
                except Exception:  # any failure of a foreign reader is an unreadable file
                    text = ""
                out.append(text if text.strip() else "")
            yield pd.DataFrame({"resume_id": f["path"].str.rsplit("/", n=1).str[-1], "path": f["path"], "raw_text": out})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "resume_id string, path string, raw_text string")


def with_requested(texts: DataFrame, requested: DataFrame) -> DataFrame:
    """One row for each requested resume_id; those that weren't found are empty."""
    return requested.select("resume_id").join(texts, "resume_id", "left").withColumn("raw_text", F.coalesce("raw_text", F.lit("")))
