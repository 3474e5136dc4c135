"""Reading tables, and writing predictions, reports and ranked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintel.functions.nullsafe import no_nan
from lintel.operators.ranking import dense_position

# Texts that a CSV reader takes for a missing value.
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str | None = None
) -> DataFrame:
    """Read CSV with header, or Parquet, with every kind of missing value turned into null.

    CSV text is read once as text; with a schema each field is found by its name in the header and cast, and
    a text that does not parse is null. Without a schema Spark infers types (one more pass over the file).
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema else spark.read
        return null_out(reader.parquet(path))
    reader = spark.read.option("header", True)
    if schema is None:
        # 'NA' beside numbers would make a whole column text: infer after nulling
        text = na_to_null(reader.csv(path))
        return _cast_inferred(text)
    want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # files of one table must have one header, else fields would be read by place
    text = na_to_null(reader.option("enforceSchema", False).csv(path))
    missing = [f.name for f in want if f.name not in text.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in the header of {path}: {text.columns}")
    return null_out(text.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in want]))


def na_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.when(~F.col(f.name).isin(NA_STRINGS), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def null_out(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column."""
    return df.select(
        [
            no_nan(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _cast_inferred(text: DataFrame) -> DataFrame:
    """Give each text column the narrowest of bigint, double, boolean that fits all its values."""
    trials = ("bigint", "double", "boolean")
    fits = text.agg(
        *[
            F.coalesce(F.bool_and(F.col(c).try_cast(t).isNotNull() | F.col(c).isNull()), F.lit(True))
            .alias(f"{c}|{t}")
            for c in text.columns
            for t in trials
        ],
    ).first()
    picked = [
        next((t for t in trials if fits[f"{c}|{t}"]), "string") for c in text.columns
    ]
    return null_out(
        text.select([F.col(c).try_cast(t).alias(c) for c, t in zip(text.columns, picked, strict=True)])
    )


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features and label as two frames of the same rows."""
    if target not in df.columns:
        raise ValueError(f"target column {target} is not in the table")
    return df.drop(target), df.select(target)


def number_predictions(
    df: DataFrame, key: str, prediction: str = "prediction", target: str = "OfficeCategory"
) -> DataFrame:
    """Key, 0-based Id in key order, and the predicted label as integer."""
    slim = df.select(key, F.col(prediction).cast("int").alias(target))
    return dense_position(slim, key, "Id")


def write_predictions(df: DataFrame, key: str, path: str, **names: str) -> None:
    numbered = number_predictions(df, key, **names)
    target = names.get("target", "OfficeCategory")
    numbered.select("Id", target).write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_ranked_list(df: DataFrame, value: str, name: str, path: str) -> None:
    ranked = df.orderBy(F.col(value).desc_nulls_last(), name)
    ranked.write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, key: str, n: int = 5, max_cols: int = 50) -> DataFrame:
    """First n rows in key order, at most max_cols columns."""
    return df.orderBy(key).limit(n).select(df.columns[:max_cols])
