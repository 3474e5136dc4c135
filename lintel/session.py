"""Session helpers: checkpointing, and spreading of thin inputs."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group of what `keep` writes.
KEPT_GROUP = 32 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the session names; fall back only on a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lintel-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from the written rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Write df as columns to the shared checkpoint folder and go on from there.

    For rows that several scans read: what one scan needs of them is read, neither joined again nor held in memory, and a column takes a
    few bytes a row. `cut` is quicker for small tables and keeps the partitions.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/kept-{uuid4().hex}"
    # small row groups, so that a file is read by several tasks
    df.write.option("compression", "zstd").option("parquet.block.size", KEPT_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tune(spark: SparkSession) -> SparkSession:
    """Keep generated code compilable: a method above 8000 bytes is only interpreted by the JVM.

    Wide projections over many derived columns would otherwise be fused into one such method;
    with this limit Spark falls back to per-operator code, which it splits into small methods.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by key when a source has fewer splits than the cluster has cores.

    A file of one row group cannot be split, so everything up to the first shuffle would run
    in one task. Sources with enough splits pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *keys)
