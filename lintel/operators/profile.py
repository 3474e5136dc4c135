"""Profiles of a table: one aggregation for all columns, never one job per column."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lintel.operators.quantiles import column_quantiles
from lintel.operators.schema import infer_column_types


def melt(df: DataFrame, columns: list[str], kind: str, keep: list[str] | None = None) -> DataFrame:
    """One row per (row, column): `column`, `value`, plus the kept columns."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    return df.select(*(keep or []), F.inline(F.array(*cells)))


def per_column(df: DataFrame, columns: list[str], measures: dict[str, callable]) -> DataFrame:
    """One aggregation over all columns, turned into one row per column."""
    wide = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), *[m(c).alias(k) for k, m in measures.items()]).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per (column, value) of text columns, null as a value of its own."""
    return melt(df, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns with nulls: count and percentage of rows, most first."""
    columns = columns or df.columns
    stats = per_column(
        df, columns, {"n_missing": lambda c: F.count_if(F.col(c).isNull()), "n_rows": lambda c: F.count("*")}
    )
    return (
        stats.where("n_missing > 0")
        .select("column", "n_missing", (F.col("n_missing") * 100.0 / F.col("n_rows")).alias("pct_missing"))
        .orderBy(F.desc("n_missing"), "column")
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows and percentage per class, in class order."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    return counts.select(target, "n", (F.col("n") * 100.0 / _total()).alias("pct")).orderBy(target)


def _total(n: str = "n") -> Column:
    """Sum over an already aggregated table of one row per class."""
    return F.sum(n).over(W.partitionBy(F.lit(0)))


def class_prior(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    return counts.select(target, (F.col("n") / _total()).alias("prior")).orderBy(target)


def cardinality(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """Distinct values per text column, null counting as one."""
    if approx:
        return per_column(
            df, columns,
            {"n_distinct": lambda c: F.approx_count_distinct(c)
             + F.coalesce(F.max(F.col(c).isNull().cast("long")), F.lit(0))},
        )
    return value_counts(df, columns).groupBy("column").agg(F.count("*").alias("n_distinct"))


def numeric_describe(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max per numeric column."""
    probs = [0.25, 0.5, 0.75]
    names = ["q25", "q50", "q75"]
    basic = per_column(
        df, columns,
        {
            "n": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(F.col(c).cast("double")),
            "max": lambda c: F.max(F.col(c).cast("double")),
        },
    )
    if approx:
        sketched = per_column(
            df, columns, {q: (lambda c, p=p: F.percentile_approx(F.col(c).cast("double"), p))
                          for q, p in zip(names, probs, strict=True)},
        )
        return basic.join(sketched, "column")
    return basic.select("*", *_by_column(column_quantiles(df, columns, probs), names))


def _by_column(values: dict[str, list[float | None]], names: list[str]) -> list[Column]:
    """Driver-held numbers per column name, as expressions over `column`."""
    return [pick({c: v[i] for c, v in values.items()}).alias(name) for i, name in enumerate(names)]


def pick(values: dict[str, float | None]) -> Column:
    entries = [F.lit(x) for c, v in values.items() for x in (c, v)]
    return F.create_map(*entries)[F.col("column")].cast("double")


def basic_info(df: DataFrame) -> DataFrame:
    numeric, text = infer_column_types(df)
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(len(numeric)).alias("n_numeric"),
        F.lit(len(text)).alias("n_categorical"),
    )


def eda_report(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """All basic profiles, by name."""
    numeric, text = infer_column_types(df, target)
    return {
        "basic_info": basic_info(df),
        "missing": missing_profile(df),
        "target": target_distribution(df, target),
        "cardinality": cardinality(df, text),
        "numeric": numeric_describe(df, numeric),
    }


def value_shares(df: DataFrame, columns: list[str], top: int = 10) -> DataFrame:
    """Share of each value, null included, rounded to 3; the `top` most frequent per column."""
    counts = value_counts(df, columns)
    ranked = _top_per_column(counts, top)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return ranked.join(totals, "column").select(
        "column", "value", F.round(F.col("n") / F.col("total"), 3).alias("share"), "place"
    )


def _top_per_column(counts: DataFrame, top: int) -> DataFrame:
    """First `top` values per column by count; Spark keeps only `top` rows a task (window group limit)."""
    place = F.row_number().over(W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value")))
    return counts.withColumn("place", place).where(F.col("place") <= top)


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per text value, most first; nulls left out."""
    return value_counts(df, columns).where("value IS NOT NULL").orderBy("column", F.desc("n"), "value")


def top_category(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value per column; the smallest value wins a tie."""
    counts = value_counts(df, columns).where("value IS NOT NULL")
    best = F.min(F.struct((-F.col("n")).alias("m"), "value"))
    return counts.groupBy("column").agg(best.alias("b")).select(
        "column", F.col("b.value").alias("value"), (-F.col("b.m")).alias("n")
    )


def nullable_top_category(df: DataFrame, columns: list[str], most: float = 0.6) -> DataFrame:
    """Text columns that have nulls and whose top value (null counts as one) holds at most `most`."""
    counts = value_counts(df, columns)
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value").isNotNull().alias("v0"), "value"))
    per = counts.groupBy("column").agg(
        F.bool_or(F.col("value").isNull()).alias("has_null"),
        F.sum("n").alias("total"),
        best.alias("b"),
    )
    return per.where("has_null").select(
        "column", F.col("b.value").alias("top_value"), (-F.col("b.m") / F.col("total")).alias("top_share")
    ).where(F.col("top_share") <= most)


def histogram(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Rows per equal-width bin per numeric column; the last bin holds its upper edge."""
    span = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    known = [(i, c) for i, c in enumerate(columns) if span[f"lo{i}"] is not None]
    lows = F.array(*[F.lit(span[f"lo{i}"]) for i, _ in known])
    widths = F.array(*[F.lit((span[f"hi{i}"] - span[f"lo{i}"]) / bins or 1.0) for i, _ in known])
    cells = [
        F.struct(F.lit(j).alias("j"), F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
        for j, (_, c) in enumerate(known)
    ]
    place = F.floor((F.col("v") - F.get(lows, F.col("j"))) / F.get(widths, F.col("j")))
    return (
        df.select(F.inline(F.array(*cells))).where("v IS NOT NULL")
        .select("column", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("column", "bin").agg(F.count("*").alias("n"))
    )


def missing_vs_target(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Class shares among null and among present rows per column, with their largest difference."""
    flags = melt(df, columns, "string", [target]).select(
        "column", F.col("value").isNull().alias("gone"), target
    )
    counts = flags.groupBy("column", target).agg(
        F.count_if("gone").alias("n1"), F.count_if(~F.col("gone")).alias("n0")
    )
    by = W.partitionBy("column")  # one row per class is left
    shares = counts.select(
        "column", target,
        _share("n1", by).alias("share_missing"), _share("n0", by).alias("share_present"),
    ).where("share_missing IS NOT NULL AND share_present IS NOT NULL")
    gap = F.abs(F.col("share_missing") - F.col("share_present"))
    return shares.withColumn("max_diff", F.max(gap).over(by))


def _share(n: str, by) -> Column:
    total = F.sum(n).over(by)
    return F.when(total > 0, F.col(n) / total)


def iqr_outlier_rate(df: DataFrame, columns: list[str], k: float = 1.5, least: float = 0.01) -> DataFrame:
    """Share of all rows outside Q1 - k*IQR .. Q3 + k*IQR, where above `least`."""
    quartiles = column_quantiles(df, columns, [0.25, 0.75])
    fences = {
        c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
        for c, (q1, q3) in quartiles.items() if q1 is not None
    }
    rates = per_column(
        df, list(fences),
        {"rate": lambda c: F.count_if((F.col(c) < fences[c][0]) | (F.col(c) > fences[c][1])) / F.count("*")},
    )
    return rates.where(F.col("rate") > least)


def zscore_outlier_counts(df: DataFrame, columns: list[str], threshold: float = 3.0) -> DataFrame:
    """Complete rows only: how many lie more than `threshold` population std from the mean."""
    whole = df.select(*columns).na.drop()
    row = whole.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    at = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}

    def far(c: str) -> Column:
        mean, std = at[c]
        if not std:
            return F.count_if(F.lit(False))
        return F.count_if(F.abs((F.col(c) - mean) / std) > threshold)

    return per_column(whole, columns, {"n_outliers": far})


def variance_profile(df: DataFrame, columns: list[str], population: bool = False) -> DataFrame:
    """Variance per column, largest first."""
    stats = per_column(df, columns, {"variance": F.var_pop if population else F.var_samp})
    return stats.orderBy(F.col("variance").desc_nulls_last(), "column")


def low_variance_count(df: DataFrame, columns: list[str], eps: float = 1e-6) -> DataFrame:
    return variance_profile(df, columns).agg(F.count_if(F.col("variance") <= eps).alias("n_low_variance"))


def near_constant(df: DataFrame, columns: list[str], eps: float = 1e-12) -> DataFrame:
    stats = variance_profile(df, columns, population=True)
    return stats.where(F.col("variance").isNull() | (F.col("variance") <= eps))


def rank_desc(table: DataFrame, value: str, name: str, k: int) -> DataFrame:
    """The k largest values with their 1-based position; names break ties."""
    top = table.orderBy(F.col(value).desc_nulls_last(), name).limit(k)
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col(value).desc_nulls_last(), name))
    return top.withColumn("position", place)  # k rows


def top_variance(df: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    places = {c: float(i) for i, c in enumerate(columns)}
    stats = variance_profile(df, columns, population=True)
    ranked = rank_desc(stats, "variance", "column", k)
    return ranked.withColumn("feature_index", pick(places).cast("int"))


def matrix_health(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, columns, NaN or null cells, infinite cells and share of zero cells."""
    def total(test) -> Column:
        return reduce(lambda a, b: a + b, [F.count_if(test(F.col(c).cast("double"))) for c in columns])

    cells = F.count("*") * len(columns)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(columns)).alias("n_columns"),
        total(lambda c: c.isNull() | F.isnan(c)).alias("n_nan"),
        total(lambda c: F.abs(c) == math.inf).alias("n_inf"),
        F.when(cells > 0, total(lambda c: c == 0) / cells).alias("zero_share"),
    )


def target_correlation(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Pearson correlation of each varying column with the label, largest first."""
    from lintel.operators.correlation import correlations

    pairs = correlations(df, columns, [target])
    return pairs.select(F.col("feature1").alias("column"), "correlation").orderBy(
        F.desc("correlation"), "column"
    )


def mutual_information(df: DataFrame, columns: list[str], target: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each column, cut at its quantiles, with the label.

    Nulls form a bin of their own. A bin counts the inner cut points below the value.
    """
    cuts = column_quantiles(df, columns, [i / bins for i in range(1, bins)])
    points = {c: sorted({q for q in qs if q is not None}) for c, qs in cuts.items()}
    return discrete_information(
        df.select(
            target,
            *[
                F.when(F.col(c).isNotNull(), _cuts_below(F.col(c), points[c])).alias(c)
                for c in columns
            ],
        ),
        columns, target,
    )


def _cuts_below(col: Column, points: list[float]) -> Column:
    return reduce(lambda a, q: a + (col > q).cast("int"), points, F.lit(0))


def discrete_information(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Mutual information of discrete columns with the label, from joint counts."""
    joint = melt(df, columns, "string", [target]).groupBy("column", "value", target).agg(F.count("*").alias("n"))
    by_value = W.partitionBy("column", "value")
    cells = joint.withColumn("nv", F.sum("n").over(by_value))
    by_class = cells.groupBy("column", target).agg(F.sum("n").alias("ny"))
    totals = by_class.withColumn("total", F.sum("ny").over(W.partitionBy("column")))
    cells = cells.join(totals, ["column", target])
    term = F.col("n") / F.col("total") * F.log(
        F.col("n") * F.col("total").cast("double") / (F.col("nv") * F.col("ny").cast("double"))
    )
    return cells.groupBy("column").agg(F.sum(term).alias("mutual_information"))
