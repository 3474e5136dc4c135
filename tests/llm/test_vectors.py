"""Product codes and centroid clusters against brute force over all pairs, in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from lintel.llm import centroids, codes
from lintel.llm.vectors import squared_distances

SCHEMA = "vec_id long, embedding array<double>, label int"


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def floors(v):
    return [math.floor(1024 * x) for x in v]


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def lloyd(points, start, rounds):
    """Assignments, distances and entries after the given rounds and one more assignment."""
    entries = [list(s) for s in start]
    for r in range(rounds + 1):
        found = [min((gap(p, e), i) for i, e in enumerate(entries)) for p in points]
        if r < rounds:
            for i in range(len(entries)):
                mine = [p for p, (_, j) in zip(points, found, strict=True) if i == j]
                if mine:
                    entries[i] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    return [i for _, i in found], [d for d, _ in found], entries


def key(x):
    return (x is None, x or 0)


def coded(rows, parts, n, rounds):
    kept = sorted([(i, floors(v), y) for i, v, y in rows if whole(v)], key=lambda r: (key(r[0]), r[1]))
    size = len(kept[0][1]) // parts
    out = [[i, y, [], []] for i, _, y in kept]
    books = []
    for p in range(parts):
        points = [v[p * size : (p + 1) * size] for _, v, _ in kept]
        code, far, entries = lloyd(points, points[:n], rounds)
        books.append(entries)
        for row, c, d in zip(out, code, far, strict=True):
            row[2].append(c)
            row[3].append(d)
    return out, books


def clustered(rows, width, k, rounds, seed=3):
    kept = [(i, floors(v)) for i, v, _ in rows if whole(v) and len(v) == width]
    digest = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    start = sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]
    cluster, far, entries = lloyd([v for _, v in kept], [v for _, v in start], rounds)
    return [(i, c, d) for (i, _), c, d in zip(kept, cluster, far, strict=True)], entries


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def some(n, width, seed=0, spread=1.0):
    r = np.random.default_rng(seed)
    return [(int(i), np.round(r.normal(0, spread, width) * 8).tolist(), int(i) % 3) for i in range(n)]  # coarse values: many ties


AWKWARD = [
    (None, [1.0, 2.0, 3.0, 4.0], None), (None, [1.0, 2.0, 3.0, 4.0], 1), (70, None, 1), (71, [1.0, None, 3.0, 4.0], 1),
    (72, [float("nan"), 0.0, 0.0, 0.0], None), (73, [float("inf"), 0.0, 0.0, 0.0], 2), (3, [-0.5, 0.25, -7.125, 0.0], 2), (3, [-0.5, 0.25, -7.125, 0.0], 2),
]


def test_codes_against_brute_force(spark):
    rows = some(60, 4) + AWKWARD
    df = table(spark, rows).selectExpr("*", "'x' AS v", "1 AS code", "2 AS far")
    got, books = codes.compress_vectors(df, parts=2, entries=7, rounds=3)
    want, entries = coded(rows, 2, 7, 3)
    found = [[r.vec_id, r.label, r.code, r.far] for r in got.collect()]
    order = lambda r: (key(r[0]), key(r[1]), r[2], r[3])
    assert sorted(found, key=order) == sorted(want, key=order)
    assert books.entries.tolist() == entries
    one = np.array([found[0][2]])
    assert books.decode(one).tolist()[0] == [x for p in range(2) for x in entries[p][one[0, p]]]


def test_codes_of_other_widths_stay_without_code(spark):
    rows = [(1, [1.0, 2.0], 0), (2, [1.0, 2.0, 3.0, 4.0], 0), (3, [0.0] * 4, 0), (4, [], 0)]
    got, books = codes.compress_vectors(table(spark, rows), parts=4, entries=2, rounds=1)
    assert {r.vec_id: r.code for r in got.collect()} == {1: None, 2: [0] * 4, 3: [1] * 4, 4: None}
    assert books.width == 4


def test_codes_of_nothing(spark):
    got, books = codes.compress_vectors(table(spark, [(1, None, 0)]))
    assert got.count() == 0 and books is None
    assert codes.codes_with_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_active_entries_give_what_a_whole_scan_gives():
    r = np.random.default_rng(5)
    for _ in range(20):
        x, old = r.integers(-4, 5, (200, 3)), r.integers(-4, 5, (12, 3))
        code, far = np.full(200, -1), np.zeros(200, np.int64)
        codes.assign(x, old, code, far, np.ones(12, bool))
        new = old.copy()
        moved = r.random(12) < 0.4
        new[moved] += r.integers(-1, 2, (moved.sum(), 3))
        moved = (new != old).any(1)
        codes.assign(x, new, code, far, moved)
        d = squared_distances(x, new)
        assert (code == d.argmin(1)).all() and (far == d.min(1)).all()


def test_distances_are_exact_beyond_doubles():
    x, e = np.array([[2**29 + 1, -3]]), np.array([[1 - 2**29, 4]])
    assert squared_distances(x, e).tolist() == [[2**60 + 49]]
    with pytest.raises(OverflowError):
        squared_distances(x * 64, e * 64)


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_clusters_against_brute_force(spark, bits):
    rows = some(150, 4, seed=bits) + AWKWARD + [(90, [1.0], 0), (91, [], 0)]
    df = table(spark, rows).selectExpr("*", "'x' AS v", "1 AS cells", "2 AS cluster", "3 AS row")
    got, middle = centroids.cluster_vectors(df, width=4, k=5, rounds=4, bits=bits)
    want, entries = clustered(rows, 4, 5, 4)
    order = lambda r: (key(r[0]), r[1:])
    assert sorted([tuple(r) for r in got.collect()], key=order) == sorted(want, key=order)
    assert middle.tolist() == entries


def test_clusters_of_few_vectors_and_of_none(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [5.0, 5.0], 0)]
    got, middle = centroids.cluster_vectors(table(spark, rows), width=2, k=8, rounds=2)
    assert len(middle) == 3 and sorted(r.distance for r in got.collect()) == [0, 0, 0]
    assert centroids.clusters_with_digests(table(spark, rows)).count() == 0  # none has 64 components
    assert centroids.clusters_with_digests(spark.createDataFrame([], SCHEMA)).columns[-1] == "centroid_sha256"


def test_cells_never_rule_out_the_nearest(spark):
    r = np.random.default_rng(1)
    x = r.integers(-600, 600, (400, 16))
    df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<long>")
    middle = r.integers(-300, 300, (6, 16))
    true = squared_distances(x, middle).argmin(1)
    fetched = []
    for bits in (2, 5, 8):
        cells = centroids.Cells.fit(df, 16, bits)
        open_ = centroids.Tables(cells, middle).candidates(cells.of(x))
        assert open_[np.arange(400), true].all()
        fetched.append((open_.sum(1) > 1).mean())
    assert fetched[2] < 0.2 < fetched[0]
