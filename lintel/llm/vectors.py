"""Integer vectors: which rows count, exact distances, exact sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024
#: Sums are kept as decimals of so many digits.
DIGITS = 38


def is_whole(vector: str) -> Column:
    """The vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def to_integers(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component x, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column, all of whose lists have `width` elements, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel(), kind))


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances, rows of x by entries, as longs.

    One matrix product in doubles where every term stays below 2^53 and is thus exact; else integer by integer. Distances that do not
    fit a long raise OverflowError.
    """
    most = max((int(np.abs(m).max()) for m in (x, entries) if m.size), default=0)
    size = 4 * x.shape[1] * most * most
    if size < 1 << 53:
        a, b = x.astype(float), entries.astype(float)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    if size >= 1 << 63:
        raise OverflowError("squared distances of these vectors do not fit a long")
    out = np.empty((len(x), len(entries)), np.int64)
    for j, entry in enumerate(entries):
        gap = x - entry
        out[:, j] = (gap * gap).sum(1)
    return out


def add_groups(total: np.ndarray, count: np.ndarray, group: np.ndarray, x: np.ndarray, sign: int = 1) -> None:
    """Add the rows of x to the totals (Python integers) of their groups, and their number to count."""
    sizes = np.bincount(group, minlength=len(total))
    found = np.nonzero(sizes)[0]
    if len(found):
        order = np.argsort(group, kind="stable")
        starts = np.concatenate(([0], np.cumsum(sizes[found])[:-1]))
        total[found] += sign * np.add.reduceat(x[order], starts, axis=0).astype(object)
    count += sign * sizes


def sum_rows(totals: Iterator[tuple[int, int, np.ndarray]], width: int) -> pa.RecordBatch:
    """(group, count, totals) as a batch of the kind that `summed` adds up."""
    rows = list(totals)
    arrays = [pa.array([g for g, _, _ in rows], pa.int32()), pa.array([int(n) for _, n, _ in rows], pa.int64())]
    arrays += [pa.array([int(t[i]) for _, _, t in rows], pa.decimal128(DIGITS, 0)) for i in range(width)]
    return pa.RecordBatch.from_arrays(arrays, ["g", "n", *[f"s{i}" for i in range(width)]])


def sum_schema(width: int) -> str:
    return ", ".join(["g int", "n bigint", *[f"s{i} decimal({DIGITS},0)" for i in range(width)]])


def summed(partials: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of each group from the lines that tasks made: one line a group comes to the driver."""
    wide = partials.groupBy("g").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])
    return {r["g"]: (r["n"], [int(r[f"s{i}"]) for i in range(width)]) for r in wide.collect()}
