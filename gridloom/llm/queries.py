"""The registered queries of this package: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm.common import read
from gridloom.llm import decontaminate, html, language, lexical, licenses, mixing, neardup, negatives, pii, quality, substrings, tokenfiles, vectors


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("notices_found")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("source", "epochs")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.encode_and_read(read(spark, sf_dir, "documents"), tokenizer_file())


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).drop("row")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).drop("kept_text")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents")).drop("redacted")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine_negatives(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_benchmark_decontamination, op3_source_mix, op4_quality_classifier, op5_token_files,
        op6_html_extraction, op7_minhash_near_dedup, op8_substring_dedup, op9_embedding_near_dedup, op10_personal_data,
        op11_language_id, op12_ranked_search, op13_hard_negatives,
    )
}
