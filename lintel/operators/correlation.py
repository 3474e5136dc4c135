"""Pairwise-complete Pearson correlation for many columns in one pass.

Each task folds its Arrow batches into small moment matrices (one matrix product per moment) and
emits them as one row, an array. These rows are added up in a tree, a bounded number of them at a time, and pairs are made of the
last one. What is shuffled is a row a task, whatever the number of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Moments of a pair: rows with both, sums of each, of their squares and of their product.
_MOMENTS = ("n", "a", "b", "aa", "bb", "ab")
_ROW = "part bigint, moments array<double>"
#: Tasks that a tree of merges is deep enough for.
_TASKS = 1 << 20
#: Bytes of moment rows that one task adds up at a time.
_MERGED = 64 << 20


def varying(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std of the columns that vary."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns) if row[f"s{i}"]}


def correlations(df: DataFrame, columns: list[str], against: list[str] | None = None) -> DataFrame:
    """feature1, feature2, correlation for every pair of varying columns (feature1 the later one).

    With `against`, every column paired with each of those instead.
    """
    names = [*columns, *[c for c in against or [] if c not in columns]]
    stats = varying(df, names)
    names = [c for c in names if c in stats]
    mean = np.array([stats[c][0] for c in names])
    std = np.array([stats[c][1] for c in names])
    k = len(names)
    if against is None:
        wanted = [(j, i) for i in range(k) for j in range(i + 1, k)]
    else:
        wanted = [(names.index(c), names.index(t)) for t in against if t in stats for c in columns
                  if c in stats and c != t]
    left = np.array([i for i, _ in wanted], dtype=int)
    right = np.array([j for _, j in wanted], dtype=int)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, ss, cross = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            x = (batch.to_numpy(dtype=float, na_value=np.nan) - mean) / std
            known = ~np.isnan(x)
            x[~known] = 0.0
            known = known.astype(float)
            n += known.T @ known
            s += x.T @ known
            ss += (x * x).T @ known
            cross += x.T @ x
        found = [n[left, right], s[left, right], s[right, left], ss[left, right], ss[right, left], cross[left, right]]
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "moments": [np.concatenate(found)]})

    wide = df.select([F.col(c).cast("double").alias(c) for c in names])
    rows = wide.mapInPandas(fold, _ROW)
    pairs = len(wanted)
    fan = max(2, _MERGED // max(1, 8 * len(_MOMENTS) * pairs))
    for _ in range(math.ceil(math.log(_TASKS, fan))):
        rows = rows.groupBy((F.col("part") / fan).cast("bigint").alias("part")).applyInPandas(_added, _ROW)
    ids = [F.array(*map(F.lit, map(int, side))) for side in (left, right)] if pairs else [F.array().cast("array<int>")] * 2
    parts = [F.slice("moments", i * pairs + 1, pairs).alias(m) for i, m in enumerate(_MOMENTS)] if pairs else []
    sums = rows.select(F.inline(F.arrays_zip(ids[0].alias("i"), ids[1].alias("j"), *parts)))
    if not pairs:
        sums = sums.select("*", *[F.lit(0.0).alias(m) for m in _MOMENTS])
    va = F.col("aa") - F.col("a") * F.col("a") / F.col("n")
    vb = F.col("bb") - F.col("b") * F.col("b") / F.col("n")
    tiny = F.col("n") * 1e-12
    corr = F.when(
        (F.col("n") > 1) & (va > tiny) & (vb > tiny),
        (F.col("ab") - F.col("a") * F.col("b") / F.col("n")) / F.sqrt(va * vb),
    )
    labels = F.array(*[F.lit(c) for c in names])
    return sums.select(
        F.get(labels, F.col("i")).alias("feature1"), F.get(labels, F.col("j")).alias("feature2"),
        corr.alias("correlation"),
    ).where("correlation IS NOT NULL")


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """The sum of moment rows, under the smallest number of theirs."""
    return pd.DataFrame({"part": [rows["part"].min()], "moments": [np.sum(np.stack(rows["moments"].to_numpy()), axis=0)]})


def redundant_pairs(df: DataFrame, columns: list[str], threshold: float = 0.95) -> DataFrame:
    """Pairs whose absolute correlation is above the threshold."""
    return correlations(df, columns).where(F.abs(F.col("correlation")) > threshold)


def redundant_columns(df: DataFrame, columns: list[str], threshold: float = 0.95) -> DataFrame:
    """The later column of each redundant pair, once."""
    return redundant_pairs(df, columns, threshold).select(F.col("feature1").alias("feature")).distinct()
