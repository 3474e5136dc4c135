"""Small tables for the document operators, with the awkward cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TEST_DIR = "/root/testdata/sf0.001"
MEDIUM_DIR = "/root/testdata/sf0.01"


def docs_of(spark: SparkSession, texts: list, ids: list | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None, None, len(t or "")) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def awkward(spark: SparkSession, *names: str) -> DataFrame:
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with the names given."""
    from pyspark.sql import functions as F

    long = "the of and over the lines. " * 8000
    docs = docs_of(
        spark,
        [None, "", " \n\t", "one", "one", "One  Two three.", "one two three.", long, long, "é ß 漢字 🙂   x", None, "tail \x00 end", "one"],
        [0, 1, 2, 3, 3, 5, 6, 7, 8, 9, None, None, 12],
    )
    for name in names:
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, sf_dir: str = TEST_DIR) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
