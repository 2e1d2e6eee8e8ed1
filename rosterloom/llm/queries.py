"""The queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm import exact_dedup, html_text, language, licenses, masked_lm, media, mixing, near_dedup, packing, toxicity
from rosterloom.llm.common import crc_of_id, table


def tokenizer_path() -> str:
    """The installed vocabulary file that the packing query names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (crc_of_id() % 3 == 1).alias("held_out"), "score", "predicted")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", (crc_of_id() % 4 == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = media.decode(media.encode(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return masked_lm.score(docs, masked_lm.fit(docs), without=("text",))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.digest(licenses.scan(docs))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
    return packing.pack(made)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=2, threshold=80)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_media_columns": op3_media_columns,
    "op4_mixing": op4_mixing,
    "op5_masked_lm": op5_masked_lm,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_near_dedup": op9_near_dedup,
    "op10_html_extraction": op10_html_extraction,
}

ORACLES = {
    "op6_exact_dedup": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
    # links over the full sets, then what they reach; the sets join on every shingle
    "op9_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) END AS s FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
        reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a),
        c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
    """,
}
