"""What the document operators share: null handling, row keys, tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.session import ensure_checkpoint_dir

BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def whole_text(name: str = "text") -> Column:
    """The text, a null one counting as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that name a row by id and text, so that rows without an id have a key too."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("\n"), whole_text(text))))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the session's checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df as a compressed table in the shared folder and go on from the written rows.

    This cuts lineage: when an executor is lost, nothing before the table is computed again.
    """
    return stored_at(df, name, codec)[0]


def stored_at(df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """`stored`, and the path of the table, for `discard` once nothing reads it any more."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that `stored_at` wrote; it may lie in any file system that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(name: str, columns: list[str]) -> str:
    """The name, with underscores added until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose key is in kept (one column, key), one row for each key.

    Rows that agree in id and text have one key: of them one stays, and where they differ in other columns it is not defined which one.
    """
    key = fresh("__row_key", docs.columns)
    rows = docs.withColumn(key, row_key())
    left = rows.join(kept.select(F.col("key").alias(key)), key, "left_semi")
    return left.dropDuplicates([key]).select(docs.columns)
