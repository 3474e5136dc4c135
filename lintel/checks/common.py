"""Small helpers to state one result in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintel.sources.listing import KEY, LABEL, listing_cte

WITH = "WITH " + listing_cte()


def rounded(df: DataFrame, *skip: str, digits: int = 6) -> DataFrame:
    """Every double rounded, with -0.0 turned into 0.0."""
    return df.select(
        [
            r(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in skip
            else F.col(f.name)
            for f in df.schema
        ]
    )


def r(col: Column, digits: int = 6) -> Column:
    return F.round(col, digits) + F.lit(0.0)


def rs(expr: str, name: str, digits: int = 6) -> str:
    return f'round({expr}, {digits}) + 0.0 AS "{name}"'


def ls(names: list[str], kind: str | None = None) -> str:
    return ", ".join(f'CAST("{c}" AS {kind}) AS "{c}"' if kind else f'"{c}"' for c in names)


def melt_sql(columns: list[str], kind: str, keep: list[str] | None = None, source: str = "listing") -> str:
    cells = ", ".join(f"""{{'column': '{c}', 'value': CAST("{c}" AS {kind})}}""" for c in columns)
    kept = "".join(f'"{c}", ' for c in keep or [])
    return f"SELECT {kept}UNNEST([{cells}], recursive := true) FROM {source}"


def per_column_sql(columns: list[str], measures: dict[str, str], source: str = "listing") -> str:
    """One line per column; {c} in a measure stands for the column."""
    lines = ", ".join(
        "{'column': '%s', %s}" % (c, ", ".join(f"'{k}': {m.format(c=chr(34) + c + chr(34))}" for k, m in measures.items()))
        for c in columns
    )
    return f"SELECT UNNEST([{lines}], recursive := true) FROM {source}"


__all__ = ["KEY", "LABEL", "WITH", "ls", "melt_sql", "per_column_sql", "r", "rounded", "rs"]
