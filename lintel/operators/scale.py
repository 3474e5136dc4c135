"""Standard and robust scaling, by fitted centre and spread per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.operators.quantiles import column_quantiles
from lintel.operators.state import Fitted


class Scaler(Fitted):
    def apply(self, df: DataFrame) -> DataFrame:
        at = self.params["at"]
        return df.withColumns(
            {c: (F.col(c).cast("double") - centre) / spread for c, (centre, spread) in at.items() if c in df.columns}
        )


def fit_standard(df: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population std; a constant column is only centred."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    at = {c: [row[f"m{i}"], row[f"s{i}"] or 1.0] for i, c in enumerate(columns) if row[f"m{i}"] is not None}
    return Scaler({"at": at})


def fit_robust(df: DataFrame, columns: list[str]) -> Scaler:
    """Median and interquartile range; a zero range divides by 1."""
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    return Scaler({"at": {c: [q[1], (q[2] - q[0]) or 1.0] for c, q in quartiles.items() if q[1] is not None}})
