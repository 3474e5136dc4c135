"""Exact quantiles by counting, from brackets that sketches give on large tables.

Spark's `percentile` keeps every distinct value of a group in one buffer. Here a wanted rank is closed in on by counts: rows per
equal-width slice of a column's range, then of the slice that holds the rank, until few rows are left, whose values are then counted one
by one. Each pass is a hash aggregation that combines on the map side and whose result is bounded, so a large group or a heavy value is no
problem. Smooth data take three scans; far outliers, which stretch the range, one or two more.

A large table does not start from its range but from a narrow bracket around each rank, which mergeable KLL sketches (one a task and
column, merged in a tree) give in one scan whatever the values are; then one or two passes of counts inside the brackets are left. A sketch may miss
a rank, though rarely: the counts show it, and the search goes on where the rank is. On small tables a sketch costs more than it saves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lintel.operators.state import State, lookup

#: Lines that a pass of counting may bring to the driver.
MAX_CANDIDATES = 400_000
#: Rows from which on sketches are made.
SKETCH_FROM = 50_000_000
#: Size of a sketch, the share of rows to either side of a rank that its bracket takes in (several times the sketch's error), and tasks a first merge.
SKETCH, MARGIN, MERGED = 8_192, 0.003, 256
MAX_SLICES = 2_048
GROUP_SLICES = 256

Range = tuple[float, float]
Step = tuple[int, float, float, int]  # zone, smallest value, largest value, rows


def column_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], most: int | None = None, slices: int | None = None
) -> dict[str, list[float | None]]:
    """Linear-interpolated exact quantiles per column; nulls are skipped."""
    most = MAX_CANDIDATES if most is None else most
    names = dict.fromkeys(columns)
    if not names:
        return {}
    spans = _spans(df, list(names), [])
    if slices is None and max(span["n"] for span in spans.values()) >= SKETCH_FROM:
        spans = _spans(df, list(names), probs)
    sizes = {c: span["n"] for c, span in spans.items()}
    done: dict[str, list[float | None]] = {c: [None] * len(probs) for c in names if not sizes[c]}
    ranges: dict[str, list[Range]] = {}
    inside: dict[str, int] = {}
    for c, span in spans.items():
        if sizes[c]:
            ranges[c] = _merge(span["brackets"] or [(span["lo"], span["hi"])])
            inside[c] = math.ceil(sizes[c] * min(1.0, 2 * MARGIN * len(probs))) if span["brackets"] else sizes[c]
    while ranges:
        total = sum(len(r) for r in ranges.values())
        by_value = sum(inside[c] for c in ranges) <= most
        ladders = _ladders(df, ranges, None if by_value else slices or max(8, min(MAX_SLICES, most // (2 * total))))
        again: dict[str, list[Range]] = {}
        for c, ladder in ladders.items():
            values, narrower = _read_off(ladder, sizes[c], probs)
            if narrower:
                again[c] = _merge(narrower)
                inside[c] = sum(n for _, lo, hi, n in ladder if any(a <= lo and hi <= b and a < b for a, b in again[c]))
            else:
                done[c] = values
        ranges = again
    return {c: done[c] for c in columns}


def _spans(df: DataFrame, names: list[str], probs: list[float]) -> dict[str, dict]:
    """Per column the rows that are not null, the range, and (given probs) a bracket of values around each wanted rank; one pass."""
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    cells = range(len(names))
    sketches = [F.kll_sketch_agg_double(f"v{i}", SKETCH).alias(f"k{i}") for i in cells] if probs else []
    counts = [f(f"v{i}").alias(f"{p}{i}") for i in cells for p, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    if probs:
        ends = F.array(*[F.lit(float(e)) for p in probs for e in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))])
        # a sketch a task, merged by neighbouring tasks and then of these; a sketch of nothing has no quantiles
        some = values.groupBy((F.spark_partition_id() / MERGED).cast("int").alias("tasks")).agg(*counts, *sketches)
        merged = [F.kll_merge_agg_double(F.when(F.col(f"n{i}") > 0, F.col(f"k{i}"))).alias(f"k{i}") for i in cells]
        summed = [f(f"{p}{i}").alias(f"{p}{i}") for i in cells for p, f in (("n", F.sum), ("lo", F.min), ("hi", F.max))]
        read = [F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"k{i}", ends)).alias(f"q{i}") for i in cells]
        level = some.agg(*summed, *merged).select("*", *read).drop(*[f"k{i}" for i in cells])
    else:
        level = values.agg(*counts)
    row = level.first()
    found = {}
    for i, c in enumerate(names):
        n, lo, hi = (row[f"{p}{i}"] if row else None for p in ("n", "lo", "hi"))
        brackets: list[Range] = []
        if n and probs:
            for j, p in enumerate(probs):
                a, b = row[f"q{i}"][2 * j : 2 * j + 2]
                brackets.append((lo if p - MARGIN <= 0 else a, hi if p + MARGIN >= 1 else b))
        found[c] = {"n": n or 0, "lo": lo, "hi": hi, "brackets": brackets}
    return found


def _merge(ranges: list[Range]) -> list[Range]:
    """Disjoint ranges in ascending order."""
    merged: list[Range] = []
    for lo, hi in sorted(ranges):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _ladders(df: DataFrame, ranges: dict[str, list[Range]], slices: int | None) -> dict[str, list[Step]]:
    """Per column, in ascending order, the rows between the ranges and inside them.

    Even zones lie between ranges and come as one step. Odd zones are ranges and come as steps
    of one slice each, or of one value each when `slices` is None.
    """
    names = list(ranges)
    cells = F.array(
        *[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(names)]
    )
    ends = F.array(*[F.array(*[F.lit(float(e)) for pair in ranges[c] for e in pair]) for c in names])
    most = max(len(r) for r in ranges.values())
    long = (
        df.select(F.inline(cells)).where("v IS NOT NULL")
        .select("i", "v", F.get(ends, F.col("i")).alias("e"))
        .select("i", "v", "e", _zone(F.col("v"), F.col("e"), most).alias("z"))
    )
    lo, hi = F.get("e", F.col("z") - 1), F.get("e", F.col("z"))
    if slices is None:
        place = F.col("v")
    else:
        place = _slot(F.col("v"), lo, hi, slices)
    slot = F.when(F.col("z") % 2 == 1, place)
    counted = long.groupBy("i", "z", slot.alias("s")).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")
    )
    out: dict[str, list[Step]] = {c: [] for c in names}
    # at most MAX_CANDIDATES lines: so many values, or columns x slices
    for r in counted.toArrow().to_pylist():
        out[names[r["i"]]].append((r["z"], r["lo"], r["hi"], r["n"]))
    for steps in out.values():
        steps.sort()
    return out


def _slot(v: Column, lo: Column, hi: Column, slices: int) -> Column:
    """The slice of v in its range, as a double: lo is in slice 0 and hi alone in the last one, so a range always narrows.

    Differences of neighbouring doubles are exact, hence the difference to lo comes first. Halves, because a range may be
    wider than the largest double; where half a range is 0 (subnormal neighbours) every value is its own slice.
    """
    half = hi / 2 - lo / 2
    return F.when(half > 0, F.floor((v / 2 - lo / 2) / half * slices).cast("double")).otherwise(v)


def _zone(v: Column, ends: Column, ranges: int) -> Column:
    """2i below range i and above the one before it, 2i + 1 inside it."""
    zone = F.lit(0)
    for j in range(ranges):
        lo, hi = F.get(ends, F.lit(2 * j)), F.get(ends, F.lit(2 * j + 1))
        zone = zone + F.when(v > hi, 2).when(v >= lo, 1).otherwise(0)
    return zone


def _read_off(ladder: list[Step], size: int, probs: list[float]) -> tuple[list[float | None], list[Range]]:
    """Quantile values, and the ranges to look into next where a rank is not pinned down."""
    wanted = []
    for p in probs:
        rank = (size - 1) * p
        wanted.append((math.floor(rank), math.ceil(rank), rank - math.floor(rank)))
    values: dict[int, float] = {}
    narrower: list[Range] = []
    ranks = sorted({r for lo, hi, _ in wanted for r in (lo, hi)})
    below = 0
    steps = iter(ladder)
    _, lo, hi, rows = next(steps)
    for r in ranks:
        while below + rows <= r:
            below += rows
            _, lo, hi, rows = next(steps)
        if lo == hi:
            values[r] = lo
        else:
            narrower.append((lo, hi))
    if narrower:
        return [], narrower + [(v, v) for v in values.values()]
    return [values[lo] + (values[hi] - values[lo]) * part for lo, hi, part in wanted], []


def group_quantiles(
    df: DataFrame, keys: list[str], columns: list[str], probs: list[float], most: int = MAX_CANDIDATES
) -> DataFrame:
    """Exact quantiles per group: keys, column, n, and one column q0, q1, ... per probability."""
    by = [*keys, "column"]
    # equal values of a group become one row before any join, so a heavy value of a heavy group is no hot key
    long = df.select(
        *keys,
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns
        ])),
    ).where("v IS NOT NULL").groupBy(*by, "v").agg(F.count("*").alias("rows"))
    parts = [_group_quantile(long, by, p, most).withColumnRenamed("q", f"q{i}") for i, p in enumerate(probs)]
    out = parts[0]
    for part in parts[1:]:
        out = lookup(out, State.of(part.drop("n")), {k: k for k in by})
    return out


def _group_quantile(long: DataFrame, by: list[str], p: float, most: int) -> DataFrame:
    on = {k: k for k in by}
    rank = (F.col("n") - 1) * F.lit(p)
    first = long.groupBy(*by).agg(F.sum("rows").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranges = State.of(
        first.select("*", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside")), count="n"
    )
    while ranges.df.where((F.col("inside") > most) & (F.col("lo") < F.col("hi"))).limit(1).count():
        ranges = State.of(_narrow(lookup(long, ranges, on), by, rank), count="n")
    counted = (
        lookup(long, ranges, on).where(F.col("v").between(F.col("lo"), F.col("hi")))
        .select(*by, "n", "below", "v", "rows")
    )
    # at most `most` values of a group are left
    upto = F.col("below") + F.sum("rows").over(W.partitionBy(*by).orderBy("v"))
    steps = counted.select("*", upto.alias("upto"))
    low, high = (F.max(F.when(_holds(r), F.col("v"))) for r in (F.floor(rank), F.ceil(rank)))
    return steps.groupBy(*by, "n").agg((low + (high - low) * F.max(rank - F.floor(rank))).alias("q"))


def _holds(r: Column) -> Column:
    return (F.col("upto") > r) & (F.col("upto") - F.col("rows") <= r)


def _narrow(placed: DataFrame, by: list[str], rank: Column) -> DataFrame:
    """Each group's range cut down to the slices that hold its wanted rank."""
    slot = _slot(F.col("v"), F.col("lo"), F.col("hi"), GROUP_SLICES)
    counted = (
        placed.where(F.col("v").between(F.col("lo"), F.col("hi")))
        .groupBy(*by, "n", "below", slot.alias("slot"))
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("rows").alias("rows"))
    )
    upto = F.col("below") + F.sum("rows").over(W.partitionBy(*by).orderBy("slot"))  # slices of a group
    steps = counted.select(*by, "n", "lo", "hi", "rows", upto.alias("upto"))
    floor, ceil = _holds(F.floor(rank)), _holds(F.ceil(rank))
    below = F.max(F.when(floor, F.col("upto") - F.col("rows")))
    return steps.groupBy(*by, "n").agg(
        F.max(F.when(floor, F.col("lo"))).alias("lo"), F.max(F.when(ceil, F.col("hi"))).alias("hi"),
        below.alias("below"), (F.max(F.when(ceil, F.col("upto"))) - below).alias("inside"),
    )
