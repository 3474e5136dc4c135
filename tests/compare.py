"""Runs registered queries in both engines and compares whole results.

    python tests/compare.py sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v):
        if isinstance(v, bool):
            return int(v)
        if isinstance(v, float):
            if math.isnan(v):
                return "NaN"
            return int(v) if v.is_integer() and abs(v) < 1e15 else v
        return v if isinstance(v, (int, str, type(None))) else str(v)

    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda row: tuple((v is None, isinstance(v, str), v if v is not None else 0) for v in row))


def difference(got, names_got: list[str], want, names_want: list[str]) -> str | None:
    if sorted(names_got) != sorted(names_want):
        return f"columns {sorted(names_got)} against {sorted(names_want)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    a, b = canonical(got, names_got), canonical(want, names_want)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ: {bad[0][0]} against {bad[0][1]} ({sorted(names_got)})"
    return None


def check(spark, con, query, sql: str | None, sf_dir: str) -> tuple[str | None, int]:
    df = query(spark, sf_dir)
    table = df.toArrow()
    got = list(zip(*[c.to_pylist() for c in table.columns], strict=True)) if table.num_rows else []
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    return difference(got, df.columns, cur.fetchall(), [c[0] for c in cur.description]), len(got)


def session(name: str = "lintel"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]").appName(name)
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )


def main() -> None:
    import __spark_entry__ as e

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    queries, oracles = e.queries(), e.oracle_sql()
    names = sys.argv[2:] or list(queries)
    if any(n.startswith("@") for n in names):
        import importlib

        modules = {a: list(importlib.import_module(f"lintel.checks.{a[1:]}").entries()) for a in names if a.startswith("@")}
        names = [n for a in names for n in modules.get(a, [a])]
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem, rows = check(spark, con, queries[name], oracles.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} rows={rows} {'' if name in oracles else 'rows-only '}{time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
