"""Exact nearest rows under missing values, for imputation and classification.

Donor rows are laid out in the cells of a k-d tree, whose planes come from a bounded sample; the number of cells
grows with the table. Every node of the tree has the bounding box of the donors below it. A query row gets a first bound of its
k-th distance from real distances to sampled donors near it, and then goes down the tree, past no node whose box lies beyond that
bound: it is compared with the cells that can hold one of its k nearest donors and with no others. Without missing values and in many dimensions
the tree stands on principal axes, which keep distances and make boxes narrow. Rows travel by regions, which are subtrees of many cells: a
query row goes to a region once, with the list of cells that it must look into there. Regions with too many donors are split, and so are
the query rows of a busy region, so that no task gets an unbounded group, copies of one row included. Tasks return k
rows per query; a last ranking merges them. Nothing is sampled or capped but what the planes and first bounds are made from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintel.operators.state import State, lookup
from lintel.session import cut, keep

#: Donors a cell, while the cells are few enough; donors that a task compares at a time.
CELL = 512
BLOCK = 4_096
#: Donors of a region, in blocks, and query rows that meet them in a task; and what either may take as doubles.
REGION_BLOCKS = 8
QUERY_BLOCK = 32_768
REGION_BYTES = 32 << 20
#: The tree and its sample go to every executor: at most so many cells and sampled rows, and so many bytes of each.
MOST_CELLS = 1 << 16
MOST_SAMPLE = 1 << 18
MOST_BYTES = 64 << 20
#: Sampled rows a cell, sampled rows at least, and sampled rows that a first bound is looked for among.
SAMPLE = 16
LEAST_SAMPLE = 1 << 16
NEAR_ROWS = 512
#: From so many coordinates on, without missing values, boxes are on the first AXES principal axes.
ROTATE_FROM, AXES = 12, 16
_STEP = 256
_PAIRS = 32_768


def nearest(
    queries: DataFrame,
    donors: DataFrame,
    key: str,
    coords: list[str],
    targets: dict[str, Column],
    k: int,
    needs: dict[str, Column] | None = None,
    exclude_self: bool = False,
    block: int = BLOCK,
    row: str | None = None,
) -> DataFrame:
    """The k nearest donors per query row and target: row, target, donor, distance, value.

    Distance: over the coordinates present in both rows, squared differences summed, times
    (coordinates / shared coordinates), square root. A donor counts for a target only where its
    target value is present and a coordinate is shared. `needs` says which query rows want a
    target (default: all). Ties go to the smaller donor key, null keys last, and then to a hash of the donor's values. `row` names the column that tells query
    rows apart (default: the key). With `exclude_self` donors that have the query's key do not count.
    """
    row = row or key
    names = list(targets)
    x, t = [f"x{i}" for i in range(len(coords))], [f"t{i}" for i in range(len(names))]
    rows, asks = _sides(queries, donors, key, row, coords, targets, needs, exclude_self)
    tree = _plant(rows, x, t, block)
    if tree is None:
        return _empty(queries, row, donors, key)
    placed, boxes = _placed(rows, tree, x, t)
    # small tables still go to all cores; regions never grow beyond the given size
    cores = queries.sparkSession.sparkContext.defaultParallelism
    most = max(block, min(REGION_BLOCKS * block, REGION_BYTES // (8 * len(coords))))
    size = min(most, max(_STEP, math.ceil(int(boxes["n"].sum()) / cores)))
    regions = _regions(tree, boxes, size)
    sent = _blocks(_routed(asks, tree, boxes, regions, x, len(t), k, exclude_self), placed, boxes, regions, x, t, size)
    return _search(*sent, row, x, names, k, exclude_self, block)


def cells_visited(
    queries: DataFrame, donors: DataFrame, key: str, coords: list[str], targets: dict[str, Column], k: int,
    needs: dict[str, Column] | None = None, exclude_self: bool = False, block: int = BLOCK, row: str | None = None,
) -> tuple[DataFrame, int]:
    """How many cells the rows of `nearest` with the same arguments look into (qk, n), and how many cells there are."""
    x, t = [f"x{i}" for i in range(len(coords))], [f"t{i}" for i in range(len(targets))]
    rows, asks = _sides(queries, donors, key, row or key, coords, targets, needs, exclude_self)
    tree = _plant(rows, x, t, block)
    if tree is None:
        return asks.select("qk", F.lit(0).alias("n")), 0
    _, boxes = _placed(rows, tree, x, t)
    routed = _routed(asks, tree, boxes, _regions(tree, boxes, block), x, len(t), k, exclude_self)
    return routed.groupBy("qk").agg(F.sum("seen").alias("n")), len(boxes)


def _sides(
    queries: DataFrame, donors: DataFrame, key: str, row: str, coords: list[str], targets: dict[str, Column], needs: dict[str, Column] | None,
    exclude_self: bool,
) -> tuple[DataFrame, DataFrame]:
    """Donors (dn, dk, coordinates, targets, dh) and query rows (qk, self, coordinates, want), under internal names.

    Rows that want nothing are sent nowhere. They are not filtered out here: a condition on so many columns, which are renamed above it, makes the
    optimizer keep a constraint for every subset of the names.
    """
    names = list(targets)
    kind = donors.schema[key].dataType
    stand_in = F.lit("0").cast(kind) if isinstance(kind, (T.NumericType, T.StringType)) else F.lit(None).cast(kind)
    values = donors.select(
        F.col(key).isNull().alias("dn"), F.coalesce(F.col(key), stand_in).alias("dk"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(coords)], *[targets[n].cast("double").alias(f"t{i}") for i, n in enumerate(names)],
    )
    wants = [(needs or {}).get(n, F.lit(True)) for n in names]
    own = F.coalesce(F.col(key), stand_in) if exclude_self else F.lit(None).cast(kind)
    asks = queries.select(
        F.col(row).alias("qk"), own.alias("self"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(coords)], F.array(*wants).alias("want"),
    )
    return values.withColumn("dh", F.xxhash64(*values.columns)), asks


def _empty(queries: DataFrame, row: str, donors: DataFrame, key: str) -> DataFrame:
    kinds = queries.schema[row].dataType.simpleString(), donors.schema[key].dataType.simpleString()
    return queries.sparkSession.createDataFrame([], f"`{row}` {kinds[0]}, target string, donor {kinds[1]}, distance double, value double")


@dataclass
class Tree:
    """A k-d tree over sampled donors. Node i splits its rows at `coord`, by value (those above `cut` go right) or by null (present ones go
    right); sampled rows lie in the order of the nodes, so that node i has `lo` to `hi` of them.
    """

    coord: np.ndarray
    cut: np.ndarray
    left: np.ndarray  #: -1 for a cell
    right: np.ndarray
    parent: np.ndarray
    cell: np.ndarray  #: number of the cell, or -1
    by_null: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    x: np.ndarray  #: sampled rows
    has: np.ndarray  #: which targets they have
    keys: np.ndarray
    axes: np.ndarray | None = None  #: principal axes that boxes and planes are on, if any

    @property
    def cells(self) -> int:
        return int(self.cell.max()) + 1

    def turned(self, x: np.ndarray) -> np.ndarray:
        return x if self.axes is None else x @ self.axes

    def down(self, x: np.ndarray, least: int = 0) -> np.ndarray:
        """The node that each row (turned) comes to: its cell, or the last node on its way with `least` sampled rows."""
        at = np.zeros(len(x), np.int64)
        moving = np.arange(len(x))
        while len(moving):
            node = at[moving]
            v = x[moving, self.coord[node]]
            right = np.where(self.by_null[node], ~np.isnan(v), v > self.cut[node])
            child = np.where(right, self.right[node], self.left[node])
            ok = child >= 0
            if least:
                ok &= (self.hi - self.lo)[child] >= least
            moving = moving[ok]
            at[moving] = child[ok]
        return at


def _plant(rows: DataFrame, x: list[str], t: list[str], block: int) -> Tree | None:
    """The tree for a table of donors; a single cell, and no sample, where they fit one block."""
    counted = rows.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in x]).first()
    if not counted.n:
        return None
    d = len(x)
    most = min(MOST_CELLS, MOST_BYTES // (72 * d))
    cells = min(most, math.ceil(counted.n / min(block, CELL)))
    if cells == 1:
        one, none = np.zeros(1, np.int64), np.full(1, -1, np.int64)
        return Tree(one, np.zeros(1), none, none, none, one, np.zeros(1, bool), one, one, np.empty((0, d)), np.empty((0, len(t)), bool), np.empty(0))
    wanted = min(max(LEAST_SAMPLE, SAMPLE * cells), MOST_SAMPLE, MOST_BYTES // (8 * (d + len(t) + 1)))
    share = F.pmod("dh", F.lit(1 << 30)) < min(1 << 30, int((1 << 30) * 1.1 * wanted / counted.n) + 1)
    # equal rows share a hash: those beyond the wanted number are left out, as a sample of any kind will do
    sample = (rows if counted.n <= wanted else rows.where(share)).select("dk", "dn", *x, *t).limit(2 * wanted).toPandas()
    points = sample[x].to_numpy(float, na_value=np.nan)
    axes = None
    if d >= ROTATE_FROM and all(counted[c] == counted.n for c in x) and len(points) > d:
        _, vectors = np.linalg.eigh(np.cov(points, rowvar=False))
        axes = np.ascontiguousarray(vectors[:, ::-1][:, :AXES])
    keys = sample["dk"].to_numpy().copy()
    return _grown(points, sample[t].notna().to_numpy().reshape(len(points), len(t)), keys, axes, max(1, len(points) // cells))


def _grown(points: np.ndarray, has: np.ndarray, keys: np.ndarray, axes: np.ndarray | None, leaf: int) -> Tree:
    """Nodes are split where values vary most, at the median, until they hold `leaf` sampled rows; nulls of that coordinate are parted first."""
    x = points if axes is None else points @ axes
    order = np.arange(len(x))
    made: list[list] = [[0, 0.0, -1, -1, -1, -1, False, 0, len(x)]]
    todo, cells = [0], 0
    while todo:
        i = todo.pop()
        lo, hi = made[i][7:]
        here = order[lo:hi]
        split = None
        if hi - lo > leaf:
            part = x[here]
            gone = np.isnan(part)
            many = np.maximum((~gone).sum(0), 1)
            mean = np.where(gone, 0.0, part).sum(0) / many
            spread = np.where(gone, 0.0, (part - mean) ** 2).sum(0) / many
            # copies of one row differ from their rounded mean, but not from each other
            spread[np.where(gone, -np.inf, part).max(0) <= np.where(gone, np.inf, part).min(0)] = 0.0
            c = int(spread.argmax())
            if spread[c] > 0:
                v = part[:, c]
                nulls = gone[:, c]
                if nulls.any():
                    split = (c, 0.0, True, ~nulls)
                else:
                    at = float(np.median(v))
                    if at >= v.max():
                        at = float(v[v < v.max()].max())
                    split = (c, at, False, v > at)
        if split is None:
            made[i][5] = cells
            cells += 1
            continue
        c, at, by_null, right = split
        order[lo:hi] = np.concatenate([here[~right], here[right]])
        middle = lo + int((~right).sum())
        made[i][0], made[i][1], made[i][6] = c, at, by_null
        for side, (a, b) in ((2, (lo, middle)), (3, (middle, hi))):
            made[i][side] = len(made)
            todo.append(len(made))
            made.append([0, 0.0, -1, -1, i, -1, False, a, b])
    columns = [np.array(c) for c in zip(*made, strict=True)]
    coord, cut_at, left, right, parent, cell, by_null, lo, hi = columns
    return Tree(coord, cut_at.astype(float), left, right, parent, cell, by_null.astype(bool), lo, hi, points[order], has[order], keys[order], axes)


def _placed(rows: DataFrame, tree: Tree, x: list[str], t: list[str]) -> tuple[DataFrame, pd.DataFrame]:
    """Donors with their cell number, and one line per cell: counts and bounding box, on the tree's axes."""
    axes = x if tree.axes is None else [f"a{i}" for i in range(tree.axes.shape[1])]
    if tree.cells == 1:
        placed, measured = rows.withColumn("cell", F.lit(0)), rows.withColumn("cell", F.lit(0))
        axes = x
    else:
        sent = rows.sparkSession.sparkContext.broadcast(tree)

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                at = sent.value.turned(batch[x].to_numpy(float, na_value=np.nan))
                yield batch.assign(cell=sent.value.cell[sent.value.down(at)].astype(np.int32))

        def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                at = sent.value.turned(batch[x].to_numpy(float, na_value=np.nan))
                out = batch.assign(cell=sent.value.cell[sent.value.down(at)].astype(np.int32))
                if sent.value.axes is not None:
                    out = out[["cell", *t]].assign(**{c: at[:, i] for i, c in enumerate(axes)})
                yield out[["cell", *axes, *t]]

        doubles = ", ".join(f"{c} double" for c in (*axes, *t))
        placed = rows.mapInPandas(place, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", cell int")
        measured = rows.select(*x, *t).mapInPandas(turn, f"cell int, {doubles}")
    boxes = measured.groupBy("cell").agg(
        F.count("*").alias("n"),
        *[f(c).alias(f"{p}{i}") for i, c in enumerate(axes) for p, f in (("c", F.count), ("lo", F.min), ("hi", F.max))],
        *[F.count(c).alias(f"ct{i}") for i, c in enumerate(t)],
    ).toPandas()  # at most MOST_CELLS lines
    return placed, boxes.sort_values("cell").reset_index(drop=True)


class Router:
    """The tree with boxes of all its nodes: which cells can hold one of the k nearest donors of a row."""

    def __init__(self, tree: Tree, boxes: pd.DataFrame, dims: int, targets: int, k: int, exclude_self: bool):
        self.tree, self.k, self.exclude_self, self.dims, self.targets = tree, k, exclude_self, dims, targets
        width = dims if tree.axes is None else tree.axes.shape[1]
        n = len(tree.cell)
        self.n = np.zeros(n, np.int64)
        self.lo, self.hi = np.full((n, width), np.inf), np.full((n, width), -np.inf)
        self.count, self.holds = np.zeros((n, width), np.int64), np.zeros((n, targets), np.int64)
        node = np.full(tree.cells, -1, np.int64)
        node[tree.cell[tree.cell >= 0]] = np.nonzero(tree.cell >= 0)[0]
        at = node[boxes["cell"].to_numpy()]
        self.n[at] = boxes["n"]
        for i in range(width):
            self.lo[at, i] = boxes[f"lo{i}"].to_numpy(float, na_value=np.inf)
            self.hi[at, i] = boxes[f"hi{i}"].to_numpy(float, na_value=-np.inf)
            self.count[at, i] = boxes[f"c{i}"]
        for i in range(targets):
            self.holds[at, i] = boxes[f"ct{i}"]
        for i in range(n - 1, 0, -1):  # children come after their parents
            up = tree.parent[i]
            self.n[up] += self.n[i]
            self.lo[up], self.hi[up] = np.minimum(self.lo[up], self.lo[i]), np.maximum(self.hi[up], self.hi[i])
            self.count[up] += self.count[i]
            self.holds[up] += self.holds[i]
        self.places = [np.nonzero(tree.has[:, i])[0] for i in range(targets)]
        self.largest = float(np.abs(np.nan_to_num(tree.x)).max(initial=0.0))

    def first_bounds(self, q: np.ndarray, own: np.ndarray, want: np.ndarray) -> np.ndarray:
        """Rows by targets: an upper bound of the squared k-th distance, from real distances to sampled donors around; infinite where none is known."""
        tree, out = self.tree, np.full(want.shape, np.inf)
        if not len(tree.x):
            return out
        start = tree.down(tree.turned(q), NEAR_ROWS)
        for node in np.unique(start):
            rows = np.nonzero(start == node)[0]
            for i in range(self.targets):
                asking = rows[want[rows, i]]
                at = node
                while len(asking):
                    # the lowest node around that has enough sampled donors with the target
                    a, b = np.searchsorted(self.places[i], (tree.lo[at], tree.hi[at]))
                    if b - a > self.k:
                        some = self.places[i][a:b]
                        some = some[:: max(1, len(some) // (4 * NEAR_ROWS))]
                        for first in range(0, len(asking) if len(some) >= self.k else 0, _STEP):
                            part = asking[first : first + _STEP]
                            far = squared(q[part], tree.x[some], self.dims)
                            if self.exclude_self:
                                far[own[part][:, None] == tree.keys[some][None, :]] = np.inf
                            out[part, i] = np.partition(far, self.k - 1, axis=1)[:, self.k - 1]
                        asking = asking[~np.isfinite(out[asking, i])]
                    if tree.parent[at] < 0:
                        break
                    at = tree.parent[at]
        return out

    def near(self, q: np.ndarray, node: np.ndarray) -> np.ndarray:
        """A lower bound of the squared distance between each row and the donors of the node beside it."""
        lo, hi, n = self.lo[node], self.hi[node], self.n[node]
        known, count = ~np.isnan(q), self.count[node]
        v = np.where(known, q, 0.0)
        ever, always = known & (count > 0), known & (count == n[:, None])
        gap = np.maximum(np.maximum(np.where(ever, lo, 0.0) - v, v - np.where(ever, hi, 0.0)), 0.0)
        total = np.where(always, gap * gap, 0.0).sum(1)
        if self.tree.axes is not None:
            return np.where(ever.any(1) | ~known.any(1), total, np.inf)
        some = ever.sum(1)
        return np.where(some > 0, total * self.dims / np.maximum(some, 1), np.inf)

    def route(self, q: np.ndarray, own: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell) pairs that cannot be ruled out, and for rows by targets the squared distance beyond which no donor counts."""
        tree = self.tree
        bound = self.first_bounds(q, own, want)
        # bounds and distances round differently: leave a little room
        room = 1e-12
        if tree.axes is not None:
            room += 1e-12 * self.dims * max(self.largest, float(np.abs(np.nan_to_num(q)).max(initial=0.0))) ** 2
        limit = np.where(want, bound * (1 + 1e-9) + room, -1.0)
        turned = tree.turned(q)
        rows, nodes = np.arange(len(q)), np.zeros(len(q), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows):
            further: list[tuple[np.ndarray, np.ndarray]] = []
            for at in range(0, len(rows), _PAIRS):
                r, node = rows[at : at + _PAIRS], nodes[at : at + _PAIRS]
                near = self.near(turned[r], node)
                keep = np.isfinite(near) & ((near[:, None] <= limit[r]) & (self.holds[node] > 0)).any(1)
                r, node = r[keep], node[keep]
                leaf = tree.left[node] < 0
                found.append((r[leaf], tree.cell[node[leaf]]))
                further += [(r[~leaf], tree.left[node[~leaf]]), (r[~leaf], tree.right[node[~leaf]])]
            rows, nodes = (np.concatenate(c) for c in zip(*further, strict=True))
        pairs = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 2
        return pairs[0], pairs[1], limit


def squared(q: np.ndarray, x: np.ndarray, dims: int) -> np.ndarray:
    """Squared distances, rows of q by rows of x, over shared coordinates and scaled up; infinite without any."""
    gaps = np.isnan(q).any(0) | np.isnan(x).any(0)
    total = np.zeros((len(q), len(x)))
    shared: np.ndarray | int = 0
    for i in range(dims):
        gap = q[:, i][:, None] - x[:, i][None, :]
        np.multiply(gap, gap, out=gap)
        if gaps[i]:
            known = ~np.isnan(gap)
            gap[~known] = 0.0
            shared = shared + known
        else:
            shared = shared + 1
        total += gap
    if not gaps.any():
        return total
    return np.where(shared > 0, total * dims / np.maximum(shared, 1), np.inf)


def _regions(tree: Tree, boxes: pd.DataFrame, most: int) -> np.ndarray:
    """The region of each cell: subtrees of `most` donors at most, or single cells."""
    n = np.zeros(len(tree.cell), np.int64)
    leaves = np.nonzero(tree.cell >= 0)[0]
    counts = np.zeros(tree.cells, np.int64)
    counts[boxes["cell"].to_numpy()] = boxes["n"]
    n[leaves] = counts[tree.cell[leaves]]
    for i in range(len(n) - 1, 0, -1):  # children come after their parents
        n[tree.parent[i]] += n[i]
    of = np.full(len(n), -1, np.int64)
    found = 0
    for i in range(len(n)):
        up = of[tree.parent[i]] if i else -1
        if up >= 0:
            of[i] = up
        elif n[i] <= most or tree.cell[i] >= 0:
            of[i] = found
            found += 1
    out = np.zeros(tree.cells, np.int32)
    out[tree.cell[leaves]] = of[leaves]
    return out


def _routed(
    asks: DataFrame, tree: Tree, boxes: pd.DataFrame, regions: np.ndarray, x: list[str], targets: int, k: int, exclude_self: bool
) -> DataFrame:
    """Query rows copied to the regions they must look into, with the cells there (null: all of them) and their number; written once, as it is
    counted and then joined.
    """
    if tree.cells == 1:
        return asks.withColumns({"far": F.lit(None).cast("array<double>"), "region": F.lit(0), "cells": F.lit(None).cast("array<int>"), "seen": F.lit(1)})
    sizes = np.bincount(regions[boxes["cell"].to_numpy()], minlength=int(regions.max()) + 1)
    sent = asks.sparkSession.sparkContext.broadcast((Router(tree, boxes, len(x), targets, k, exclude_self), regions, sizes))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        router, region_of, cells_of = sent.value
        for batch in batches:
            q = batch[x].to_numpy(float, na_value=np.nan)
            want = np.array(batch["want"].tolist(), dtype=bool).reshape(len(batch), targets)
            i, cell, far = router.route(q, batch["self"].to_numpy(), want)
            bounded = batch.assign(far=list(far))
            order = np.lexsort((cell, region_of[cell], i))
            i, cell = i[order], cell[order].astype(np.int32)
            region = region_of[cell]
            starts = np.nonzero(np.r_[True, (i[1:] != i[:-1]) | (region[1:] != region[:-1])])[0] if len(i) else np.empty(0, np.int64)
            ends = np.r_[starts[1:], len(i)].astype(np.int64)
            for at in range(0, len(starts), _PAIRS):
                lo, hi = starts[at : at + _PAIRS], ends[at : at + _PAIRS]
                whole = hi - lo == cells_of[region[lo]]
                lists = [None if w else cell[a:b] for w, a, b in zip(whole, lo, hi, strict=True)]
                yield bounded.iloc[i[lo]].assign(region=region[lo], cells=lists, seen=(hi - lo).astype(np.int32))

    kinds = {f.name: f.dataType.simpleString() for f in asks.schema}
    given = f"qk {kinds['qk']}, self {kinds['self']}, {', '.join(f'{c} double' for c in x)}"
    return keep(asks.mapInPandas(route, f"{given}, want array<boolean>, far array<double>, region int, cells array<int>, seen int"))


def _blocks(
    routed: DataFrame, placed: DataFrame, boxes: pd.DataFrame, regions: np.ndarray, x: list[str], t: list[str], block: int
) -> tuple[DataFrame, DataFrame]:
    """Query rows and donors by region, both in bounded blocks."""
    busy = {r["region"]: r["count"] for r in routed.groupBy("region").count().collect()}  # one row a region
    held = np.bincount(regions[boxes["cell"].to_numpy()], weights=boxes["n"], minlength=int(regions.max()) + 1).astype(np.int64)
    asked = max(_STEP, min(QUERY_BLOCK, REGION_BYTES // (8 * len(x))))
    layout = {r: (math.ceil(n / block), math.ceil(busy.get(r, 0) / asked)) for r, n in enumerate(held.tolist())}
    if len(layout) == 1:  # nothing to look up
        parts, slots = layout[0]
        numbered = [side.withColumns({"parts": F.lit(parts), "slots": F.lit(slots)}) for side in (routed, placed.withColumn("region", F.lit(0)))]
    else:
        spark = routed.sparkSession
        by_region = State.of(spark.createDataFrame([(r, *n) for r, n in layout.items()], "region int, parts int, slots int"), bound=4 * MOST_CELLS)
        by_cell = State.of(
            spark.createDataFrame([(c, r, *layout[r]) for c, r in enumerate(regions.tolist())], "cell int, region int, parts int, slots int"),
            bound=4 * MOST_CELLS,
        )
        numbered = [lookup(routed, by_region, {"region": "region"}), lookup(placed, by_cell, {"cell": "cell"})]
    ask_blocks = numbered[0].select(
        "qk", "self", *x, "want", "far", "cells", "region",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("qk"), F.col("slots")).cast("int").alias("slot"),
    )
    donor_blocks = numbered[1].where("slots > 0").select(
        "dn", "dk", "dh", *x, *t, "cell", "region",
        F.pmod(F.xxhash64("dk", "dh", F.spark_partition_id()), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
    )
    return ask_blocks, donor_blocks


def close(q: np.ndarray, x: np.ndarray, far: np.ndarray, barred: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows without missing values that are among the k nearest or tie with them, at most `far` apart, and a few more beyond the k-th;
    with their squared distances.

    A matrix product tells distances but for rounding, whose bound is left as room; what it cannot rule out is measured as `squared` does.
    """
    qq, xx = (q * q).sum(1), (x * x).sum(1)
    about = q @ x.T
    about *= -2.0
    about += qq[:, None]
    about += xx[None, :]
    if barred is not None:
        about[barred] = np.inf
    room = 1e-14 * (q.shape[1] + 8) * (qq + xx.max())
    limit = np.array(far, float)
    if len(x) > k:
        open_ = np.nonzero(np.isinf(limit))[0]
        if len(open_):
            limit[open_] = np.partition(about[open_], k - 1, axis=1)[:, k - 1] + room[open_]
    i, j = np.nonzero((about <= (limit + room)[:, None]) & np.isfinite(about))
    total = np.zeros(len(i))
    for c in range(q.shape[1]):
        gap = q[i, c] - x[j, c]
        total += gap * gap
    kept = total <= far[i]
    return i[kept], j[kept], total[kept]


def _search(
    asks: DataFrame, donors: DataFrame, row: str, x: list[str], names: list[str], k: int, exclude_self: bool, block: int
) -> DataFrame:
    d = len(x)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k nearest of a block of donors, for each row and target; places of donors are in the order that settles ties."""
        columns = ["qk", "t", "dn", "dk", "dh", "distance", "value"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in columns})
        right = right.sort_values(["dn", "dk", "dh"], kind="stable")
        donor_keys, nulls, hashes, cell = (right[c].to_numpy() for c in ("dk", "dn", "dh", "cell"))
        dx = right[x].to_numpy(dtype=float, na_value=np.nan)
        values = right[[f"t{i}" for i in range(len(names))]].to_numpy(dtype=float, na_value=np.nan)
        qx = left[x].to_numpy(dtype=float, na_value=np.nan)
        keys, own = left["qk"].to_numpy(), left["self"].to_numpy()
        want = np.array(left["want"].tolist(), dtype=bool).reshape(len(left), len(names))
        bounds = left["far"].to_numpy()
        far = np.full(want.shape, np.inf) if bounds[0] is None else np.stack(bounds)
        plain = not np.isnan(qx).any() and not np.isnan(dx).any()
        found: list[list[tuple]] = [[] for _ in names]

        def compare(asking: np.ndarray, at: np.ndarray) -> None:
            barred = own[asking][:, None] == donor_keys[at][None, :] if exclude_self else None
            dist = None if plain else squared(qx[asking], dx[at], d)
            if dist is not None and barred is not None:
                dist[barred] = np.inf
            for t in range(len(names)):
                some, there = np.nonzero(want[asking, t])[0], np.nonzero(~np.isnan(values[at, t]))[0]
                if not len(some) or not len(there):
                    continue
                limit = far[asking[some], t]
                if plain:
                    shut = None if barred is None else barred[np.ix_(some, there)]
                    i, j, near = close(qx[asking[some]], dx[at[there]], limit, shut, k)
                    found[t].append((asking[some[i]], at[there[j]], np.sqrt(near)))
                    continue
                near = dist[np.ix_(some, there)]
                near = np.where(near > limit[:, None], np.inf, near)
                alive = np.isfinite(near).any(1)
                some, near = some[alive], near[alive]
                if len(some):
                    picked, order = _smallest(np.sqrt(near), k)
                    i, j = np.nonzero(np.isfinite(picked))
                    found[t].append((asking[some[i]], at[there[order[i, j]]], picked[i, j]))

        def in_steps(rows: np.ndarray, places: np.ndarray) -> None:
            for a in range(0, len(rows), _STEP):
                for b in range(0, len(places), block):
                    compare(rows[a : a + _STEP], places[b : b + block])

        listed = left["cells"].notna().to_numpy()
        in_steps(np.nonzero(~listed)[0], np.arange(len(right)))
        if listed.any():
            lists = left["cells"][listed]
            sizes = lists.map(len).to_numpy()
            cells, rows = np.concatenate(lists.to_list()), np.repeat(np.nonzero(listed)[0], sizes)
            order, by_cell = np.argsort(cells, kind="stable"), np.argsort(cell, kind="stable")
            cells, rows, lie = cells[order], rows[order], cell[by_cell]
            for c in np.unique(cells):
                here = by_cell[slice(*np.searchsorted(lie, (c, c + 1)))]
                in_steps(rows[slice(*np.searchsorted(cells, (c, c + 1)))], here)
        out = []
        for t, hits in enumerate(found):
            if hits:
                i, j, far_off = (np.concatenate(h) for h in zip(*hits, strict=True))
                order = np.lexsort((j, far_off, i))
                i, j, far_off = i[order], j[order], far_off[order]
                first = np.searchsorted(i, i)  # where the row's own hits begin
                inside = np.arange(len(i)) - first < k
                i, j, far_off = i[inside], j[inside], far_off[inside]
                out.append(pd.DataFrame({
                    "qk": keys[i], "t": t, "dn": nulls[j], "dk": donor_keys[j], "dh": hashes[j], "distance": far_off, "value": values[j, t],
                }))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in columns})

    kind_q, kind_d = (s.schema[c].dataType.simpleString() for s, c in ((asks, "qk"), (donors, "dk")))
    by = ["region", "part", "slot"]
    hits = asks.groupBy(*by).cogroup(donors.groupBy(*by)).applyInPandas(
        best, f"qk {kind_q}, t int, dn boolean, dk {kind_d}, dh bigint, distance double, value double"
    )
    place = F.row_number().over(W.partitionBy("qk", "t").orderBy("distance", "dn", "dk", "dh"))
    labels = F.array(*[F.lit(n) for n in names])
    return hits.withColumn("place", place).where(F.col("place") <= k).select(
        F.col("qk").alias(row), F.get(labels, F.col("t")).alias("target"),
        F.when(~F.col("dn"), F.col("dk")).alias("donor"), "distance", "value",
    )


def _smallest(far: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest of each row in rising order and their places; the smaller place wins a tie."""
    if far.shape[1] > 4 * k:
        # all that is not above the k-th value, at least k of them, in their old order
        limit = np.partition(far, k - 1, axis=1)[:, k - 1]
        inside = far <= limit[:, None]
        width = int(inside.sum(1).max())
        if 2 * width < far.shape[1]:
            some = np.argsort(~inside, axis=1, kind="stable")[:, :width]
            part = np.where(np.take_along_axis(inside, some, 1), np.take_along_axis(far, some, 1), np.inf)
            order = np.argsort(part, axis=1, kind="stable")[:, :k]
            return np.take_along_axis(part, order, 1), np.take_along_axis(some, order, 1)
    order = np.argsort(far, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(far, order, 1), order


def neighbour_weight(by: list[str], weights: str) -> Column:
    """1 per neighbour, or 1 / distance; where a distance is 0 only such neighbours count."""
    if weights == "uniform":
        return F.lit(1.0)
    closest = F.min("distance").over(W.partitionBy(*by))  # k rows
    return F.when(closest == 0, (F.col("distance") == 0).cast("double")).otherwise(1 / F.col("distance"))


def knn_impute(
    df: DataFrame,
    donors: DataFrame,
    key: str,
    columns: list[str],
    k: int = 5,
    weights: str = "uniform",
    scale_first: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Numeric nulls filled with the mean of the k nearest donors that have the value.

    Adds a <col>_missing flag for every column. A row that shares no coordinate with any usable
    donor gets the donors' mean. Distances are on the values as they are unless `scale_first`.
    Every row stays one row, whatever its key: see `knn_fill`.
    """
    flagged = df.select("*", *[F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in columns])
    filled = knn_fill(flagged, donors, key, columns, k, weights, scale_first, block)
    return filled.withColumns({c: F.col(f"__knn_{c}") for c in columns}).drop(*[f"__knn_{c}" for c in columns])


def knn_fill(
    df: DataFrame,
    donors: DataFrame,
    key: str,
    columns: list[str],
    k: int = 5,
    weights: str = "uniform",
    scale_first: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """df with __knn_<col> beside each column: its value or, where that is null, the mean of its k nearest donors.

    What a row gets depends on its numbers alone. So neighbours are looked up once for each different row of numbers that has a gap, under a
    row number written with it, and come back by those numbers: null and repeated keys, and rows repeated as a whole,
    neither lose nor multiply rows. The key only settles ties between donors. A column without any donor value stays as it is.
    """
    row = donors.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    mean = {c: row[f"m{i}"] for i, c in enumerate(columns)}
    known = [c for c in columns if mean[c] is not None]
    x, v = [f"__x{i}" for i in range(len(known))], [f"__v{i}" for i in range(len(known))]
    nothing = {f"__knn_{c}": F.col(c).cast("double") for c in columns}
    if not known:
        return df.withColumns(nothing)

    def coordinate(c: str, of: str) -> Column:
        value = F.col(of)
        return (value - mean[c]) / (row[f"s{columns.index(c)}"] or 1.0) if scale_first else value

    def plain(c: str) -> Column:
        return F.col(c).cast("double") + F.lit(0.0)  # no negative zero

    def identity(names: list[str]) -> list[Column]:
        """128 bits that tell rows of numbers apart."""
        cells = [cell for c in names for cell in (F.coalesce(F.col(c), F.lit(0.0)), F.col(c).isNull())]
        return [F.xxhash64(*cells).alias("__h1"), F.xxhash64(F.lit(1), *cells).alias("__h2")]

    rows = df.withColumns({n: plain(c) for n, c in zip(v, known, strict=True)})
    hashed = rows.select("*", *identity(v))
    gaps = hashed.where(_any_null(v)).groupBy("__h1", "__h2").agg(F.count("*").alias("__n"), *[F.first(n).alias(n) for n in v])
    asked = cut(gaps.withColumn("__q", F.monotonically_increasing_id()))
    asks = asked.select("__q", *v, *[coordinate(c, n).alias(p) for c, n, p in zip(known, v, x, strict=True)])
    given = donors.select(key, *[plain(c).alias(n) for c, n in zip(known, v, strict=True)])
    given = given.select(key, *v, *[coordinate(c, n).alias(p) for c, n, p in zip(known, v, x, strict=True)])
    found = nearest(
        asks, given, key, x, {c: F.col(n) for c, n in zip(known, v, strict=True)}, k,
        needs={c: F.col(n).isNull() for c, n in zip(known, v, strict=True)}, block=block, row="__q",
    )
    weighted = found.withColumn("w", neighbour_weight(["__q", "target"], weights))
    fills = weighted.groupBy("__q").agg(
        *[
            (F.sum(F.when(F.col("target") == c, F.col("value") * F.col("w")))
             / F.sum(F.when(F.col("target") == c, F.col("w")))).alias(f"__f{i}")
            for i, c in enumerate(known)
        ]
    )
    f = [f"__f{i}" for i in range(len(known))]
    table = cut(asked.select("__h1", "__h2", "__n", "__q").join(fills, "__q", "left").drop("__q"))
    back = lookup(hashed, State.of(table, count="__n"), {"__h1": "__h1", "__h2": "__h2"}, {n: n for n in f})
    filled = {f"__knn_{c}": F.coalesce(F.col(n), F.col(g), F.lit(mean[c])) for c, n, g in zip(known, v, f, strict=True)}
    return back.withColumns({**nothing, **filled}).drop("__h1", "__h2", *v, *f)


def _any_null(columns: list[str]) -> Column:
    test: Column = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return test


def knn_classify(
    queries: DataFrame,
    donors: DataFrame,
    key: str,
    coords: list[str],
    label: str,
    classes: list[int],
    k: int = 15,
    weights: str = "distance",
    exclude_self: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Class shares p<k> among the k nearest donors, and the most likely class."""
    rows = cut(queries.select(key, *coords).withColumn("__q", F.monotonically_increasing_id()))
    found = nearest(
        rows, donors, key, coords, {"label": F.col(label)}, k, exclude_self=exclude_self, block=block, row="__q"
    ).withColumn("w", neighbour_weight(["__q"], weights))
    shares = found.groupBy("__q").agg(
        *[
            (F.sum(F.when(F.col("value") == y, F.col("w")).otherwise(0.0)) / F.sum("w")).alias(f"p{i}")
            for i, y in enumerate(classes)
        ]
    )
    names = [f"p{i}" for i in range(len(classes))]
    return rows.select(key, "__q").join(shares, "__q").drop("__q").withColumn("prediction", argmax(names, classes))


def argmax(names: list[str], classes: list[int]) -> Column:
    """Class of the largest probability; the lowest class wins a tie."""
    best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    found = F.when(F.col(names[0]) == best, F.lit(classes[0]))
    for n, y in zip(names[1:], classes[1:], strict=True):
        found = found.when(F.col(n) == best, F.lit(y))
    return found


def vector_columns(df: DataFrame, vector: str, size: int, prefix: str = "e") -> DataFrame:
    """Elements of an array column as columns e0, e1, ..."""
    return df.select("*", *[F.get(vector, F.lit(i)).cast("double").alias(f"{prefix}{i}") for i in range(size)])
