"""Imputation, rare categories and outliers: fit on one table, apply to any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.functions.nullsafe import clip
from lintel.operators.profile import melt, per_column, pick, value_counts
from lintel.operators.quantiles import column_quantiles
from lintel.operators.schema import infer_column_types
from lintel.operators.state import Fitted, State, lookup

MISSING = "__MISSING__"
RARE = "__RARE__"
ALL_NULL_TEXT = "__ALLNAN__"


class Imputer(Fitted):
    """Fills nulls with one fitted value per column; optional <col>_missing flags."""

    def apply(self, df: DataFrame) -> DataFrame:
        fills, flags = self.params["fills"], self.params["flags"]
        out = [
            F.coalesce(F.col(c).cast("double") if isinstance(fills[c], float) else F.col(c), F.lit(fills[c]))
            .alias(c) if fills.get(c) is not None else F.col(c)
            for c in df.columns
        ]
        return df.select(*out, *[F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in flags])

    @property
    def unfilled(self) -> list[str]:
        """Columns that had no value at fit, which stay as they are."""
        return [c for c, v in self.params["fills"].items() if v is None]


def fit_impute(
    df: DataFrame,
    columns: list[str],
    strategy: str = "median",
    fill_value: object = None,
    add_indicator: bool = False,
) -> Imputer:
    """strategy: mean, median, most_frequent or constant. Flags only for columns with nulls at fit."""
    if strategy == "median":
        fills = {c: q[0] for c, q in column_quantiles(df, columns, [0.5]).items()}
    elif strategy == "mean":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        fills = {c: row[f"m{i}"] for i, c in enumerate(columns)}
    elif strategy == "most_frequent":
        fills = most_frequent(df, columns)
    elif strategy == "constant":
        fills = {c: fill_value for c in columns}
    else:
        raise ValueError(f"unknown strategy {strategy}")
    flags = columns_with_nulls(df, columns) if add_indicator else []
    return Imputer({"fills": fills, "flags": flags})


def columns_with_nulls(df: DataFrame, columns: list[str]) -> list[str]:
    row = df.agg(*[F.bool_or(F.col(c).isNull()).alias(f"f{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"f{i}"]]


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value per column; the smallest wins a tie."""
    numeric, _ = infer_column_types(df.select(*columns))
    found: dict[str, object] = {c: None for c in columns}
    for kind, names in (("double", numeric), ("string", [c for c in columns if c not in numeric])):
        if not names:
            continue
        counts = melt(df, names, kind).where("value IS NOT NULL").groupBy("column", "value").agg(
            F.count("*").alias("n")
        )
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("b"))
        found.update({r["column"]: r.b.value for r in best.collect()})  # one row per column
    return found


class AllNullFill(Fitted):
    """0.0 or a marker text for columns without any value at fit."""

    def apply(self, df: DataFrame) -> DataFrame:
        return df.fillna({c: v for c, v in self.params["fills"].items() if c in df.columns})


def fit_all_null(df: DataFrame, columns: list[str] | None = None) -> AllNullFill:
    columns = columns or df.columns
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    empty = [c for i, c in enumerate(columns) if row[f"n{i}"] == 0]
    numeric, _ = infer_column_types(df.select(*empty)) if empty else ([], [])
    return AllNullFill({"fills": {c: 0.0 if c in numeric else ALL_NULL_TEXT for c in empty}})


def prefill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


class RareCollapse(Fitted):
    """Renames fitted rare values; values not seen at fit stay."""

    def apply(self, df: DataFrame) -> DataFrame:
        columns = [c for c in self.params["columns"] if c in df.columns]
        order = df.columns
        rare = self.states["rare"]
        for c in columns:
            own = State(
                rare.df.where(F.col("column") == c).select("value", "n", F.lit(True).alias("__rare")),
                rare.small, "n",
            )
            df = lookup(df, own, {c: "value"}, {"__rare": "__rare"}).withColumn(
                c, F.when(F.col("__rare"), self.params["name"]).otherwise(F.col(c))
            ).drop("__rare")
        return df.select(*order)


def fit_rare(df: DataFrame, columns: list[str], threshold: float = 0.01, name: str = RARE) -> RareCollapse:
    """Values with a share of the non-null rows below the threshold are rare."""
    counts = value_counts(df, columns).where("value IS NOT NULL")
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    rare = counts.join(F.broadcast(totals), "column").where(F.col("n") / F.col("total") < threshold)
    state = State.of(rare.select("column", "value", "n"), count="n")
    touched = [r["column"] for r in state.df.select("column").distinct().collect()]  # names of columns
    return RareCollapse({"columns": [c for c in columns if c in touched], "name": name}, {"rare": state})


class MissingCleaner(Fitted):
    """Prefills, all-null fills, rare collapsing, then imputation with flags, in this order."""

    def apply(self, df: DataFrame) -> DataFrame:
        p = self.params
        df = prefill(df, p["prefill"])
        df = AllNullFill({"fills": p["all_null"]}).apply(df)
        df = RareCollapse({"columns": p["rare_columns"], "name": p["rare_name"]}, self.states).apply(df)
        return Imputer({"fills": p["fills"], "flags": p["flags"]}).apply(df)


def fit_clean_missing(
    df: DataFrame,
    numeric: list[str],
    text: list[str],
    numeric_strategy: str = "median",
    text_strategy: str = "most_frequent",
    fill_value: str = MISSING,
    prefill_values: dict[str, object] | None = None,
    rare_threshold: float = 0.01,
    rare_name: str = RARE,
    add_indicator: bool = True,
) -> MissingCleaner:
    empty = fit_all_null(df, [*numeric, *text]).params["fills"]
    rare = fit_rare(df, text, rare_threshold, rare_name)
    numbers = fit_impute(df, numeric, numeric_strategy, 0.0, add_indicator)
    texts = fit_impute(df, text, text_strategy, fill_value)
    return MissingCleaner(
        {
            "prefill": prefill_values or {},
            "all_null": empty,
            "rare_columns": rare.params["columns"],
            "rare_name": rare_name,
            "fills": {**numbers.params["fills"], **texts.params["fills"]},
            "flags": numbers.params["flags"],
        },
        rare.states,
    )


class OutlierBounds(Fitted):
    """Lower and upper bound per column."""

    @property
    def bounds(self) -> dict[str, tuple[float, float]]:
        return {c: tuple(b) for c, b in self.params["bounds"].items()}

    def apply(self, df: DataFrame, action: str = "clip") -> DataFrame:
        """clip: move to the bound. nan: set null. remove: drop the row (rows with null go too)."""
        known = {c: b for c, b in self.bounds.items() if c in df.columns}
        if action == "remove":
            return outlier_filter(df, known)
        if action == "clip":
            return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in known.items()})
        if action == "nan":
            return df.withColumns({c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in known.items()})
        raise ValueError(f"unknown action {action}")

    def table(self, spark) -> DataFrame:
        rows = [(c, float(lo), float(hi)) for c, (lo, hi) in self.bounds.items()]
        return spark.createDataFrame(rows, "column string, lower double, upper double")

    def info(self, df: DataFrame) -> DataFrame:
        """Bounds with counts below and above, and percent of all rows."""
        b = self.bounds
        below = lambda c: F.count_if(F.col(c) < b[c][0])
        above = lambda c: F.count_if(F.col(c) > b[c][1])
        stats = per_column(
            df, list(b), {"n_below": below, "n_above": above, "n_rows": lambda c: F.count("*")}
        )
        total = F.col("n_below") + F.col("n_above")
        return stats.select(
            "column",
            pick({c: v[0] for c, v in b.items()}).alias("lower"),
            pick({c: v[1] for c, v in b.items()}).alias("upper"),
            "n_below", "n_above", total.alias("n_total"),
            (total * 100.0 / F.col("n_rows")).alias("pct_outliers"),
        )


def fit_outlier_bounds(
    df: DataFrame, columns: list[str], method: str = "iqr", threshold: float = 3.0
) -> OutlierBounds:
    if method == "iqr":
        quartiles = column_quantiles(df, columns, [0.25, 0.75])
        bounds = {
            c: (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1))
            for c, (q1, q3) in quartiles.items() if q1 is not None
        }
    elif method == "zscore":
        row = df.agg(
            *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        bounds = {
            c: (row[f"m{i}"] - threshold * row[f"s{i}"], row[f"m{i}"] + threshold * row[f"s{i}"])
            for i, c in enumerate(columns) if row[f"s{i}"] is not None
        }
    else:
        raise ValueError(f"unknown method {method}")
    return OutlierBounds({"bounds": {c: list(b) for c, b in bounds.items()}})


def outlier_filter(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows inside every bound."""
    test: Column = F.lit(True)
    for c, (lo, hi) in bounds.items():
        test = test & F.col(c).between(lo, hi)
    return df.where(test)
