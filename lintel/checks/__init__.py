"""Registered queries and, where a second engine can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lintel.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def registry() -> tuple[dict[str, Query], dict[str, str]]:
    from lintel.checks import audits, cleaning, derived_columns, evaluation, labels, learning, profiles, tables

    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for module in (tables, derived_columns, profiles, cleaning, evaluation, audits, learning, labels):
        for name, (query, sql) in module.entries().items():
            if name in queries:
                raise ValueError(f"query {name} is registered twice")
            queries[name] = _tuned(query)
            if sql:
                oracles[name] = sql
    return queries, oracles
