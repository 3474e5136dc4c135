"""From raw documents to packed training sequences, in five stages over the operators of lintel.llm.

Each stage takes what its predecessor kept. All but the last return the columns of documents; the last returns the
pieces of documents with their ids and their places in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lintel.llm import exact, packing, pii, quality, simhash
from lintel.llm.common import stored
from lintel.llm.vocabulary import default_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.7 or more; the classifier learns from labels (operator 3)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest, then smallest id, stays (operator 8)."""
    return exact.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash fingerprints that differ in 3 bits at most the smallest id stays (operator 6)."""
    return simhash.drop_near_duplicates(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, plain or disguised, is replaced by its kind; n_chars is counted anew (operator 9)."""
    return pii.mask_personal_data(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents of at most 1024 ids and their places in sequences (operator 7)."""
    return packing.pack_documents(docs, default_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("exact", without_exact_copies),
    ("near", without_near_copies),
    ("personal", without_personal_data),
    ("packing", packed_sequences),
]
#: A learned classifier, fingerprints and a tokenizer have no SQL; tests/llm/test_pipeline.py holds run() to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each one keeps is a table in the shared folder that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def entries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    return {"pipeline": (run, ORACLE_SQL)}
