"""Registered queries of the document operators, on whole tables, each with SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lintel.llm import bpe, centroids, codes, exact, idfile, language, multiset, packing, pii, quality, secretscan, simhash, warc
from lintel.llm.vocabulary import default_path

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_id_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.through_file(documents(spark, sf_dir), default_path("byte_bpe_50k.json"), end=0)


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(spark.read.parquet(f"{sf_dir}/pages.parquet")), ["page_id"])


def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(documents(spark, sf_dir))


def op5_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.edited_fingerprints(documents(spark, sf_dir))


def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), default_path("byte_bpe_50k.json"), with_ids=False)


def op8_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir)).drop("key")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), default_path("word_bpe_49k.json"), with_ids=False)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_active_entry_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.codes_with_digests(embeddings(spark, sf_dir))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secret_spans(documents(spark, sf_dir))


def op13_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters_with_digests(embeddings(spark, sf_dir))


def entries() -> dict[str, tuple[Query, str | None]]:
    return {
        "op1_token_id_file": (op1_token_id_file, None),
        "op2_warc_derivatives": (op2_warc_derivatives, None),
        "op3_compression_quality": (op3_compression_quality, None),
        "op4_kernel_language": (op4_kernel_language, None),
        "op5_multiset_fingerprints": (op5_multiset_fingerprints, None),
        "op6_simhash_near_duplicates": (op6_simhash_near_duplicates, None),
        "op7_best_fit_packing": (op7_best_fit_packing, None),
        "op8_exact_duplicates": (op8_exact_duplicates, exact.EXACT_SQL),
        "op9_personal_data": (op9_personal_data, None),
        "op10_bpe": (op10_bpe, None),
        "op11_active_entry_codes": (op11_active_entry_codes, codes.codes_sql()),
        "op12_secret_scan": (op12_secret_scan, None),
        "op13_va_file_clusters": (op13_va_file_clusters, centroids.clusters_sql()),
    }
