"""Centroid clustering over a VA-file: cells of a few bits a dimension decide most assignments, full vectors only the rest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import discard, stored, stored_at
from lintel.llm.vectors import DIGITS, SCALE, add_groups, is_whole, matrix, squared_distances, sum_rows, sum_schema, summed, to_integers
from lintel.session import spread

WIDTH, CENTROIDS, ROUNDS, SEED = 64, 8, 10, 3
#: Bits of a cell. On vectors of the check tables 5, 6 and 8 bits leave 72 to 79, 44 to 54 and 12 to 24 % of the vectors to fetch a round.
BITS = 8
STEP = 4096


@dataclass(frozen=True)
class Cells:
    """Bounds of the cells of every dimension: `lo` and `hi`, dimension by cell, both inclusive."""

    cuts: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    @classmethod
    def fit(cls, rows: DataFrame, width: int, bits: int) -> Cells:
        """Cells with about as many values each, from a quantile sketch of each dimension. Where the cuts lie changes only how much is fetched."""
        points = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
        of = [F.get("v", F.lit(i)) for i in range(width)]
        row = rows.agg(
            *[F.percentile_approx(c, points, 4 << bits).alias(f"q{i}") for i, c in enumerate(of)],
            *[F.min(c).alias(f"lo{i}") for i, c in enumerate(of)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(of)],
        ).first()
        cuts = np.sort(np.array([row[f"q{i}"] for i in range(width)], np.int64), axis=1)
        first, last = (np.array([[row[f"{e}{i}"]] for i in range(width)], np.int64) for e in ("lo", "hi"))
        if 4 * width * max(int(np.abs(first).max()), int(np.abs(last).max())) ** 2 >= 1 << 63:
            raise OverflowError("squared distances of these vectors do not fit a long")
        return cls(cuts, np.concatenate([first, cuts + 1], 1), np.concatenate([cuts, last], 1))

    @property
    def kind(self) -> type:
        """The narrowest integers that hold all components."""
        most = max(int(np.abs(self.lo[:, 0]).max()), int(np.abs(self.hi[:, -1]).max()))
        return np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell numbers of vectors, a byte a dimension."""
        return np.stack([np.searchsorted(self.cuts[j], x[:, j], side="left") for j in range(x.shape[1])], 1).astype(np.uint8)


class Tables:
    """Lookup tables of one round: what the cell of a dimension adds to bounds of the squared distance to each centroid."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        self.cells, self.centroids = cells, centroids
        lo, hi = cells.lo[:, :, None] - centroids.T[:, None, :], cells.hi[:, :, None] - centroids.T[:, None, :]
        self.high = np.maximum(lo * lo, hi * hi)
        self.low = np.where((lo <= 0) & (hi >= 0), 0, np.minimum(lo * lo, hi * hi))

    @staticmethod
    def sums(table: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of cells by centroids: the entries of all dimensions added up."""
        out = np.zeros((len(at), table.shape[2]), np.int64)
        for j in range(at.shape[1]):
            out += table[j][at[:, j]]
        return out

    def ahead(self, b: int) -> np.ndarray:
        """Least value, over a cell, of a dimension's part of (squared distance to each centroid) - (that to centroid b)."""
        step = (self.centroids - self.centroids[b]).T[:, None, :]
        base = (self.centroids * self.centroids - self.centroids[b] * self.centroids[b]).T[:, None, :]
        return np.minimum(base - 2 * self.cells.lo[:, :, None] * step, base - 2 * self.cells.hi[:, :, None] * step)

    def candidates(self, at: np.ndarray) -> np.ndarray:
        """Rows of cells by centroids: which centroids may be the nearest. The tables are exact, so no other can.

        Where the intervals of several centroids overlap, the interval of each centroid's distance less that of the likeliest one is looked up as well,
        which is narrower, since what both have in common cancels; a centroid surely farther is out.
        """
        low, high = self.sums(self.low, at), self.sums(self.high, at)
        open_ = low <= high.min(1)[:, None]
        guess = (low + high).argmin(1)
        many = np.nonzero(open_.sum(1) > 1)[0]
        for b in np.unique(guess[many]):
            rows = many[guess[many] == b]
            behind = self.sums(self.ahead(b), at[rows]) > 0
            behind[:, b] = False
            open_[rows] &= ~behind
        return open_


def nearest_of(x: np.ndarray, centroids: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Nearest centroid of every vector among its candidates, the smaller number on a tie."""
    far = squared_distances(x, centroids)
    return np.where(open_, far, np.iinfo(np.int64).max).argmin(1)


def _judged(rows: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """Rows of (row, cells, old) with the cluster that the cells alone decide (else null) and, where they do not, the candidates."""

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(cells, centroids)
        for batch in given:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                open_ = tables.candidates(_unpacked(part["cells"], len(cells.cuts)))
                sure = open_.sum(1) == 1
                cluster = pa.array(open_.argmax(1), pa.int32(), mask=~sure)
                some = pa.array([None if s else np.nonzero(o)[0].tolist() for s, o in zip(sure, open_, strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part["row"], part["cells"], part["old"], cluster, some], names)

    names = ["row", "cells", "old", "cluster", "candidates"]
    return rows.select("row", "cells", "old").mapInArrow(batches, "row bigint, cells binary, old int, cluster int, candidates array<int>")


def _packed(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def _unpacked(column: pa.Array, width: int, kind: type = np.uint8) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


class Moves:
    """Component sums that clusters gain and lose in one task."""

    def __init__(self, k: int, width: int):
        self.total, self.count = np.zeros((k, width), object), np.zeros(k, np.int64)

    def add(self, x: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        moved = old != new
        add_groups(self.total, self.count, new[moved], x[moved])
        left = moved & (old >= 0)
        add_groups(self.total, self.count, old[left], x[left], -1)

    def lines(self) -> pa.RecordBatch:
        told = [g for g in range(len(self.count)) if self.count[g] or self.total[g].any()]
        return sum_rows(((g, self.count[g], self.total[g]) for g in told), self.total.shape[1])


def _with_lines(batch: pa.RecordBatch | None, lines: pa.RecordBatch | None, names: list[str], kinds: list[pa.DataType], width: int) -> pa.RecordBatch:
    """State rows without sums, or lines of sums without state, in one schema."""
    n = (batch or lines).num_rows
    left = list(batch.columns) if batch else [pa.nulls(n, kind) for kind in kinds]
    wide = [pa.int32(), pa.int64(), *[pa.decimal128(DIGITS, 0)] * width]
    right = list(lines.columns) if lines else [pa.nulls(n, kind) for kind in wide]
    return pa.RecordBatch.from_arrays([*left, *right], names)


def _resolved(fetched: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """Rows (row, cells, old, v and, if judged before, cluster and candidates) with their cluster, decided by full vectors where cells did not.

    After its rows each task adds lines of the sums that clusters gained and lost (columns g, n, s0, ...), in the same table: one pass and
    one write give both.
    """
    width, k = len(cells.cuts), len(centroids)
    judged = "candidates" in fetched.columns

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, moves = Tables(cells, centroids), Moves(k, width)
        for batch in given:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                x = _unpacked(part["v"], width, cells.kind).astype(np.int64)
                old = part["old"].to_numpy(zero_copy_only=False).astype(np.int64)
                if judged:
                    open_ = np.zeros((len(x), k), bool)
                    for i, (c, some) in enumerate(zip(part["cluster"].to_pylist(), part["candidates"].to_pylist(), strict=True)):
                        open_[i, some if c is None else c] = True
                else:
                    open_ = tables.candidates(_unpacked(part["cells"], width))
                new = open_.argmax(1)
                wide = open_.sum(1) > 1
                if wide.any():
                    new[wide] = nearest_of(x[wide], centroids, open_[wide])
                moves.add(x, old, new)
                state = pa.RecordBatch.from_arrays([part["row"], part["cells"], pa.array(new, pa.int32())], state_names)
                yield _with_lines(state, None, names, kinds, width)
        if moves.count.any() or moves.total.any():
            yield _with_lines(None, moves.lines(), names, kinds, width)

    state_names, kinds = ["row", "cells", "cluster"], [pa.int64(), pa.binary(), pa.int32()]
    names = [*state_names, "g", "n", *[f"s{i}" for i in range(width)]]
    columns = ["row", "cells", "old", "v", *[c for c in ("cluster", "candidates") if judged]]
    return fetched.select(*columns).mapInArrow(batches, f"row bigint, cells binary, cluster int, {sum_schema(width)}")


def _measured(base: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and exact squared distance: one pass over the whole table, without a shuffle."""
    width = len(cells.cuts)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(cells, centroids)
        for batch in given:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                x = _unpacked(part["v"], width, cells.kind).astype(np.int64)
                open_ = tables.candidates(_unpacked(part["cells"], width))
                new = open_.argmax(1)
                wide = open_.sum(1) > 1
                if wide.any():
                    new[wide] = nearest_of(x[wide], centroids, open_[wide])
                far = np.empty(len(x), np.int64)
                for c in np.unique(new):
                    far[new == c] = squared_distances(x[new == c], centroids[c : c + 1])[:, 0]
                yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array(new, pa.int32()), pa.array(far)], ["vec_id", "cluster", "distance"])

    kind = base.schema["vec_id"].dataType.simpleString()
    return base.select("vec_id", "v", "cells").mapInArrow(batches, f"vec_id {kind}, cluster int, distance bigint")


def _whole(vectors: DataFrame, vec_id: str, vector: str, width: int) -> DataFrame:
    kept = vectors.where(is_whole(vector) & (F.size(vector) == width))
    return kept.select(F.col(vec_id).alias("vec_id"), to_integers(vector).alias("v"))


def _base(rows: DataFrame, width: int, bits: int) -> tuple[DataFrame, Cells]:
    """The VA-file: one table with row numbers, whose columns `cells` and `v`, both packed, are read apart; and the bounds of the cells."""
    cells = Cells.fit(rows, width, bits)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            x = matrix(batch["v"], width).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], _packed(x.astype(cells.kind)), _packed(cells.of(x))], ["vec_id", "v", "cells"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    made = spread(rows).mapInArrow(batches, f"vec_id {kind}, v binary, cells binary")
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "va"), cells


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", width: int = WIDTH, k: int = CENTROIDS, rounds: int = ROUNDS,
    seed: int = SEED, bits: int = BITS,
) -> tuple[DataFrame, np.ndarray]:
    """Clusters of all vectors with `width` finite components, and the final centroids: vec_id, cluster, distance (squared).

    Components x become floor(1024 * x). Centroids start as the k vectors with the smallest sha256 of "<seed>:<vec_id>", in that order; equal ids go by
    their vectors and null ids come last. `rounds` times each vector goes to the nearest centroid (the smaller number on a tie) and each
    centroid that has vectors to their floored mean; then vectors are assigned once more. All arithmetic is exact.

    A round reads the cells only (a byte a dimension), finds the centroids that may be nearest from lookup tables, and joins the full
    vectors of rows which several centroids are left for, or which change their cluster, as sums of clusters are kept up to date by what moves.
    That join is by row number; Spark measures its smaller side and broadcasts it or shuffles both. The first round and the last read
    everything once, in place. Tables of a round are removed after the next is written; a lost executor costs the stage that it ran.

    Other rows and columns are not looked at. Repeated rows each count and each get a row; fewer than k vectors are as many centroids; no vectors give
    an empty result. On the driver are k centroids, k sums and the bounds of the cells.
    """
    rows = _whole(vectors, vec_id, vector, width)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = rows.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    if not start:
        kind = vectors.schema[vec_id].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint"), np.empty((0, width), np.int64)
    base, cells = _base(rows, width, bits)
    spark = vectors.sparkSession
    centroids = np.array([r.v for r in start], np.int64)
    total, count = np.zeros(centroids.shape, object), np.zeros(len(centroids), np.int64)
    parts = base.select("row").rdd.getNumPartitions()
    state: DataFrame | None = None
    paths: list[str] = []
    for _ in range(rounds):
        written = []
        if state is None:
            fetched = base.select("row", "cells", F.lit(-1).alias("old"), "v")
            decided = None
        else:
            judged, path = stored_at(_judged(state.withColumnRenamed("cluster", "old").coalesce(parts), cells, centroids), "judged")
            written.append(path)
            wanted = F.col("cluster").isNull() | (F.col("cluster") != F.col("old"))
            fetched = judged.where(wanted).join(base.select("row", "v"), "row")
            decided = judged.where(~wanted).select("row", "cells", "cluster")
        resolved, path = stored_at(_resolved(fetched, cells, centroids), "resolved")
        written.append(path)
        for g, (n, sums) in summed(resolved.where("g IS NOT NULL").drop("row", "cells", "cluster"), width).items():
            total[g] += np.array(sums, object)
            count[g] += n
        now = resolved.where("g IS NULL").select("row", "cells", "cluster")
        state = now if decided is None else decided.unionByName(now)
        for old in paths:
            discard(spark, old)
        paths = written
        used = np.nonzero(count)[0]
        centroids = centroids.copy()
        centroids[used] = (total[used] // count[used][:, None]).astype(np.int64)
    for old in paths:
        discard(spark, old)
    return stored(_measured(base, cells, centroids), "clusters"), centroids


def clusters_with_digests(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector: distances summed over its cluster and over all,
    and the digest of its centroid's components in decimal, joined by commas."""
    done, centroids = cluster_vectors(vectors)
    sums = {r["cluster"]: int(r["s"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = F.element_at(F.array(*[F.lit(sums.get(c, 0)).cast("bigint") for c in range(len(digests))] or [F.lit(0).cast("bigint")]), F.col("cluster") + 1)
    digest = F.element_at(F.array(*[F.lit(x) for x in digests] or [F.lit("")]), F.col("cluster") + 1)
    return done.select(
        "vec_id", "cluster", "distance", inertia.alias("cluster_inertia"), F.lit(sum(sums.values())).cast("bigint").alias("inertia"), digest.alias("centroid_sha256")
    )


def clusters_sql(width: int = WIDTH, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same in SQL, every round written out, all vectors compared with all centroids."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), embedding) AS rid, vec_id,
            list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "cells AS MATERIALIZED (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept)",
        f"m0 AS MATERIALIZED (SELECT rid - 1 AS e, d, x FROM cells WHERE rid <= {k})",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, arg_min(e, (far, e)) AS e, min(far) AS far FROM (
            SELECT c.rid, m.e, sum((c.x - m.x) * (c.x - m.x)) AS far FROM cells c JOIN m{r} m ON c.d = m.d GROUP BY c.rid, m.e) GROUP BY rid)""")
        if r < rounds:
            steps.append(f"u{r} AS (SELECT a.e, c.d, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS n FROM cells c JOIN a{r} a USING (rid) GROUP BY a.e, c.d)")
            steps.append(f"""m{r + 1} AS MATERIALIZED (SELECT m.e, m.d, coalesce((u.s - ((u.s % u.n) + u.n) % u.n) // u.n, m.x) AS x
                FROM m{r} m LEFT JOIN u{r} u ON u.e = m.e AND u.d = m.d)""")
    return f"""WITH {", ".join(steps)},
        told AS (SELECT e, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS sha FROM m{rounds} GROUP BY e)
        SELECT k.vec_id, CAST(a.e AS INTEGER) AS cluster, CAST(a.far AS BIGINT) AS distance,
            CAST(sum(a.far) OVER (PARTITION BY a.e) AS BIGINT) AS cluster_inertia, CAST(sum(a.far) OVER () AS BIGINT) AS inertia, t.sha AS centroid_sha256
        FROM kept k JOIN a{rounds} a USING (rid) JOIN told t ON t.e = a.e"""
