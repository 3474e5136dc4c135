"""Fitted state: small tables learnt by `fit`, applied to other rows by `lookup`.

A state whose size is proven small (at most BOUND rows and BYTES of text, checked when it is fitted) is held as
a local relation and broadcast. A larger one stays a checkpointed table and is joined by
shuffle, with the keys known to be frequent spread over several partitions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from lintel.session import cut

BOUND = 50_000
BYTES = 32 << 20
HOT_SHARE = 1e-3
SALTS = 64


@dataclass
class State:
    """One fitted table. `count` names the column with the fitted row count per key."""

    df: DataFrame
    small: bool
    count: str | None = None

    @classmethod
    def of(cls, df: DataFrame, count: str | None = None, bound: int | None = None) -> State:
        bound = BOUND if bound is None else bound
        head = df.limit(bound + 1)
        texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        if texts:
            # the size of texts is known before any of them comes to the driver
            head = head.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            size = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in texts) if texts else F.lit(0)
            n, bytes_ = head.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first() if texts else (0, 0)
            table = head.toArrow() if n <= bound and bytes_ <= BYTES else None
        finally:
            if texts:
                head.unpersist()
        if table is not None and table.num_rows <= bound:
            return cls(df.sparkSession.createDataFrame(table, schema=df.schema), True, count)
        return cls(cut(df), False, count)

    @classmethod
    def load(cls, spark: SparkSession, path: str, count: str | None = None) -> State:
        return cls.of(spark.read.parquet(path), count)

    def save(self, path: str) -> None:
        self.df.write.mode("overwrite").parquet(path)

    def rename(self, names: dict[str, str]) -> State:
        return State(self.df.withColumnsRenamed(names), self.small, self.count)


def lookup(
    df: DataFrame,
    state: State,
    on: dict[str, str],
    add: dict[str, str] | None = None,
    defaults: dict[str, Any] | None = None,
) -> DataFrame:
    """Left join of a fitted state. `on` maps row column to state column; nulls match nulls.

    `add` maps the state columns to append to their new names (default: all, under their own).
    Rows without a match get `defaults` (by new name), else null.
    """
    defaults = defaults or {}
    names = {right: f"__k{i}" for i, right in enumerate(on.values())}
    if add is None:
        add = {c: c for c in state.df.columns if c not in names}
    picked = [F.col(c).alias(k) for c, k in names.items()] + [F.col(c).alias(k) for c, k in add.items()]
    right = state.df.select(*picked)
    if not state.small:
        df, right, extra = _salt(df, state, on, picked)
    else:
        right, extra = F.broadcast(right), None
    matches = [F.col(left).eqNullSafe(F.col(names[r])) for left, r in on.items()]
    if extra is not None:
        matches.append(extra)
    condition: Column = matches[0]
    for m in matches[1:]:
        condition = condition & m
    joined = df.join(right, condition, "left").drop(*names.values(), "__ls", "__rs")
    fills = {c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in defaults.items()}
    return joined.withColumns(fills) if fills else joined


def _salt(
    df: DataFrame, state: State, on: dict[str, str], picked: list[Column]
) -> tuple[DataFrame, DataFrame, Column]:
    """Spread the rows of frequent keys over SALTS copies of their state row.

    At most 1 / HOT_SHARE keys can hold a share of HOT_SHARE or more, which bounds the list.
    """
    keys = [F.col(r) for r in on.values()]
    count = state.count
    if count is None:
        return df, state.df.select(*picked), F.lit(True)
    total = state.df.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) >= total * HOT_SHARE
    hot_rows = state.df.where(is_hot).select(F.xxhash64(*keys).alias("h")).collect()
    hot = [r.h for r in hot_rows]
    atomic = [
        f.name for f in df.schema
        if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType))
    ]
    # equal rows share a hash: the partition that they come from tells them apart, and is the same when it is made again
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in atomic])
    left_types = {left: state.df.schema[r].dataType for left, r in on.items()}
    left_hash = F.xxhash64(*[F.col(left).cast(t) for left, t in left_types.items()])
    salted = df.withColumn(
        "__ls", F.when(left_hash.isin(hot), F.pmod(row_hash, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
        if hot else F.lit(0),
    )
    copies = (
        F.when(F.xxhash64(*keys).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1)))
        .otherwise(F.array(F.lit(0)))
        if hot else F.array(F.lit(0))
    )
    spread_right = state.df.select(*picked, F.explode(copies).alias("__rs"))
    return salted, spread_right, F.col("__ls") == F.col("__rs")


@dataclass
class Fitted:
    """Base of everything `fit` returns: plain parameters plus named states."""

    params: dict[str, Any] = field(default_factory=dict)
    states: dict[str, State] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def save(self, spark: SparkSession, path: str) -> None:
        for name, state in self.states.items():
            state.save(f"{path}/{name}")
        counts = {name: s.count for name, s in self.states.items()}
        body = json.dumps({"kind": type(self).__name__, "params": self.params, "states": counts})
        spark.createDataFrame([(body,)], "manifest string").coalesce(1).write.mode("overwrite").text(
            f"{path}/manifest"
        )

    @staticmethod
    def load(spark: SparkSession, path: str) -> Fitted:
        body = json.loads(spark.read.text(f"{path}/manifest").first().value)
        kind = _kinds()[body["kind"]]
        states = {name: State.load(spark, f"{path}/{name}", c) for name, c in body["states"].items()}
        return kind(params=body["params"], states=states)


def _kinds() -> dict[str, type[Fitted]]:
    found: dict[str, type[Fitted]] = {}
    waiting = [Fitted]
    while waiting:
        kind = waiting.pop()
        found[kind.__name__] = kind
        waiting.extend(kind.__subclasses__())
    return found
