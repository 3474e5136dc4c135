"""Null rules shared by every operator: one missing value (null), never NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_CATEGORY = "nan"


def no_nan(col: Column) -> Column:
    return F.nullif(col, F.lit(float("nan")))


def to_num(df: DataFrame, name: str) -> Column:
    """Column as double; text that is no number, NaN and an absent column become null."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        # Java also reads '1d' and '1f' as numbers
        suffixed = col.rlike(r"[0-9.][dDfF]\s*$")
        return no_nan(F.when(~suffixed, col.try_cast("double")))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return no_nan(col.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    raise TypeError(f"column {name} of type {kind.simpleString()} is neither numeric nor text")


def to_category(col: Column | str) -> Column:
    """String form; a missing value is the category 'nan'."""
    return F.coalesce(_col(col).cast("string"), F.lit(NULL_CATEGORY))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den where den > 0, else null."""
    return F.when(den > 0, num / den)


def clip(col: Column, lo: float | None = 0.0, hi: float | None = 20.0) -> Column:
    """Bound a column; null stays null (greatest and least would skip it)."""
    bounded = col
    if hi is not None:
        bounded = F.least(bounded, F.lit(float(hi)))
    if lo is not None:
        bounded = F.greatest(bounded, F.lit(float(lo)))
    return F.when(col.isNotNull(), bounded)


def product(*cols: Column) -> Column:
    """Product of columns; null when any is null or the result is infinite."""
    result = cols[0]
    for c in cols[1:]:
        result = result * c
    return F.when(F.abs(result) < float("inf"), result)


def fill0(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def log1p0(col: Column) -> Column:
    """ln(1 + x) for x > -1, else null."""
    return F.when(col > -1, F.log1p(col))


def bin_edges(col: Column, edges: list[float]) -> Column:
    """Right-closed bins numbered from 0, lowest edge included; outside is null."""
    codes = F.when(col < edges[0], F.lit(None).cast("double"))
    for i, edge in enumerate(edges[1:]):
        codes = codes.when(col <= edge, F.lit(float(i)))
    return codes


def equal_width_edges(lo: float, hi: float, bins: int) -> list[float]:
    """Edges of equal-width bins over lo..hi; a constant column gets a tiny range around it."""
    if lo == hi:
        margin = 0.001 * abs(lo) if lo != 0 else 0.001
        lo, hi = lo - margin, hi + margin
    step = (hi - lo) / bins
    edges = [lo + i * step for i in range(bins)] + [hi]
    return edges


def blank_or_null_flag(df: DataFrame, name: str) -> Column:
    """1 when null or only white space, else 0; an absent column gives 0."""
    if name not in df.columns:
        return F.lit(0)
    col = F.col(name)
    return F.when(col.isNull() | col.cast("string").rlike(r"(?U)^\s*$"), 1).otherwise(0)


def missing_flag(name: str) -> Column:
    return F.col(name).isNull().cast("int").alias(f"{name}_missing")


def log1p_clip(col: Column, lo: float = 0.0) -> Column:
    """ln(1 + max(x, lo))."""
    return F.log1p(clip(col, lo, None))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
