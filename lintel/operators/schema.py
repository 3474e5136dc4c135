"""Column kinds, column policies, and plain row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = "numeric"
CATEGORICAL = "categorical"


def column_kinds(df: DataFrame, exclude: list[str] | None = None) -> dict[str, str]:
    """Kind per column: text is categorical, numbers and booleans are numeric."""
    kinds = {}
    for f in df.schema:
        if f.name in (exclude or []):
            continue
        if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)):
            kinds[f.name] = CATEGORICAL
        elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            kinds[f.name] = NUMERIC
        else:
            raise TypeError(f"column {f.name} has unsupported type {f.dataType.simpleString()}")
    return kinds


def infer_column_types(
    df: DataFrame, target: str | None = None, exclude: list[str] | None = None
) -> tuple[list[str], list[str]]:
    """Numeric and categorical column names, without the target and the excluded ones."""
    kinds = column_kinds(df, [*(exclude or []), *([target] if target else [])])
    return (
        [c for c, k in kinds.items() if k == NUMERIC],
        [c for c, k in kinds.items() if k == CATEGORICAL],
    )


def kinds_table(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    rows = list(column_kinds(df, exclude).items())
    return df.sparkSession.createDataFrame(rows, "column string, kind string")


def drop_policy_columns(df: DataFrame, drop: list[str], keep_anyway: list[str] | None = None) -> DataFrame:
    """Drop columns by policy; an error when no feature would be left."""
    left = [c for c in df.columns if c not in drop and c not in (keep_anyway or [])]
    if not left:
        raise ValueError("every feature column is on the drop list")
    return df.drop(*drop)


def keep_features(metrics: DataFrame) -> DataFrame:
    """Features that generalise, do not leak, and vary within reason."""
    return metrics.where(
        (F.col("perm_importance") > 0.005)
        & (F.col("leak_score") < 0.3)
        & F.col("variance").between(1e-3, 1e7)
    )


def merge_feature_metrics(metrics: dict[str, DataFrame]) -> DataFrame:
    """Metric tables (feature, value) side by side; a feature a table lacks counts 0."""
    merged: DataFrame | None = None
    for name, table in metrics.items():
        table = table.select("feature", F.col("value").alias(name))
        merged = table if merged is None else merged.join(table, "feature", "full_outer")
    return merged.fillna(0.0, list(metrics))


def dropped_features(all_features: DataFrame, kept: DataFrame) -> DataFrame:
    return all_features.select("feature").exceptAll(kept.select("feature"))


def domain_union(train: DataFrame, valid: DataFrame, name: str = "domain") -> DataFrame:
    """Both tables on top of each other, marked 0 and 1."""
    return train.withColumn(name, F.lit(0)).unionByName(valid.withColumn(name, F.lit(1)))


def category_union(first: DataFrame, second: DataFrame, column: str) -> DataFrame:
    return first.select(column).union(second.select(column)).distinct()
