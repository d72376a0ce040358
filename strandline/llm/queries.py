"""Queries of the training-data operators, one per operator, and the pipeline; SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from strandline.llm import classifiers, conversation_repair, decontamination, embedding_dedup, exact_topk, license_scan, near_dup, periodic_runs, sentencepiece_spans, substring_dedup, suffix_array_dedup, url_filter
from strandline.llm.common import table

MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifiers.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifiers.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_words(table(spark, sf_dir, "documents")).drop("kept")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_spans.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("hits")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(table(spark, sf_dir, "conversations"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_quality_classifier": op1_quality_classifier,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_toxicity": op9_toxicity,
        "op2_decontamination": op2_decontamination,
        "op10_embedding_near_dedup": op10_embedding_near_dedup,
        "op3_url_filters": op3_url_filters,
        "op4_substring_dedup": op4_substring_dedup,
        "op6_suffix_array_dedup": op6_suffix_array_dedup,
        "op5_sentencepiece": op5_sentencepiece,
        "op7_license_scans": op7_license_scans,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_exact_topk": op12_exact_topk,
        "op13_periodic_runs": op13_periodic_runs,
    }


OP3_SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM split
), rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS k
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (page_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filters": OP3_SQL}
