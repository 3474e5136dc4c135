"""The ways taken only by large data, forced on small data and held against brute force."""

import math

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from lintel.operators import audit, encode, neighbours, ranking
from lintel.operators import quantiles as Q
from lintel.operators import state as S
from lintel.operators.quantiles import column_quantiles, group_quantiles
from lintel.sources.listing import KEY, LABEL, NUMERIC, listing, numeric_rows


def test_quantiles_narrowed(spark):
    rows = numeric_rows(spark, SMALL).withColumn("wild", F.when(F.col(KEY) % 100 == 0, 1e12).otherwise(F.col("PlotSize")))
    columns, probs = [*NUMERIC, "wild"], [0.0, 0.1, 0.5, 0.999, 1.0]
    want = rows.agg(*[F.percentile(c, probs).alias(c) for c in columns]).first()
    for most, slices in ((100_000, None), (40, 8)):
        got = column_quantiles(rows, columns, probs, most, slices)
        for c in columns:
            assert got[c] == pytest.approx(list(want[c]), rel=1e-12), c


def test_quantiles_from_sketches(spark, monkeypatch):
    """Brackets that hold the ranks, and brackets of a sketch so coarse that it misses some: both end at the exact values."""
    rows = numeric_rows(spark, SMALL).withColumns({
        "wild": F.when(F.col(KEY) % 100 == 0, 1e12).otherwise(F.col("PlotSize")), "gone": F.lit(None).cast("double"), "flat": F.lit(7.0),
    })
    columns, probs = [*NUMERIC, "wild", "gone", "flat"], [0.0, 0.1, 0.5, 0.999, 1.0]
    want = rows.agg(*[F.percentile(c, probs).alias(c) for c in columns]).first()
    monkeypatch.setattr(Q, "SKETCH_FROM", 0)
    for sketch, margin, merged, most in ((8192, 0.003, 256, 100_000), (8192, 0.003, 1, 300), (8, 0.001, 2, 2_000)):
        for name, value in (("SKETCH", sketch), ("MARGIN", margin), ("MERGED", merged)):
            monkeypatch.setattr(Q, name, value)
        got = column_quantiles(rows.repartition(5), columns, probs, most)
        for c in columns:
            assert got[c] == ([None] * 5 if c == "gone" else pytest.approx(want[c], rel=1e-12)), (c, sketch)


def test_quantiles_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(None, 5.0), (None, 5.0)], "a double, b double")
    assert column_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [5.0]}
    assert column_quantiles(df, [], [0.5]) == {}


def test_group_quantiles_narrowed(spark):
    rows = listing(spark, SMALL, "BuildingType", "PlotSize", "TotalRooms")
    want = {r.BuildingType: r for r in rows.groupBy("BuildingType").agg(F.median("PlotSize").alias("PlotSize"), F.median("TotalRooms").alias("TotalRooms")).collect()}
    for most in (100_000, 5):
        for r in group_quantiles(rows, ["BuildingType"], ["PlotSize", "TotalRooms"], [0.5], most).collect():
            assert r.q0 == pytest.approx(want[r.BuildingType][r["column"]], rel=1e-12)


def test_lookup_by_shuffle_with_spread_keys(spark, monkeypatch):
    """One key holds most rows; the state is too large to broadcast."""
    rows = spark.range(4000).select("id", F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("c"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None)], "id long, c string"))
    small = encode.fit_frequency(rows, ["c"]).apply(rows).collect()
    monkeypatch.setattr(S, "BOUND", 10)
    fitted = encode.fit_frequency(rows, ["c"])
    assert not fitted.states["c"].small
    large = fitted.apply(rows)
    assert "__rs" in large._jdf.queryExecution().analyzed().toString()
    assert sorted(large.collect()) == sorted(small)


def test_rank_with_deep_prefixes(spark):
    rows = listing(spark, SMALL, KEY, LABEL)
    order = ranking.md5_of(42, KEY)
    shallow = {r[KEY]: r["rank"] for r in ranking.exact_rank(rows, [LABEL], order, KEY, digits=2).collect()}
    deep = {r[KEY]: r["rank"] for r in ranking.exact_rank(rows, [LABEL], order, KEY, digits=5).collect()}
    assert shallow == deep


def test_split_narrowed_by_prefix(spark):
    rows = listing(spark, SMALL, KEY, LABEL)
    assert ranking.split_thresholds(rows, LABEL, KEY, 0.2, 42, most=3) == ranking.split_thresholds(rows, LABEL, KEY, 0.2, 42)


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, None)], "k int, y int")
    got = ranking.stratified_split(df, "y", "k", 0.2).groupBy("y").agg(F.sum("is_valid").alias("v")).collect()
    assert {r.y: r.v for r in got} == {0: 0, 1: 1, None: 0}


def brute_force(rows: np.ndarray, k: int) -> np.ndarray:
    """Mean of the k nearest rows that have the value, by definition."""
    n, d = rows.shape
    out = rows.copy()
    for i in range(n):
        for t in np.nonzero(np.isnan(rows[i]))[0]:
            found = []
            for j in range(n):
                shared = ~np.isnan(rows[i]) & ~np.isnan(rows[j])
                if not math.isnan(rows[j][t]) and shared.any():
                    gap = rows[i][shared] - rows[j][shared]
                    found.append((math.sqrt((gap * gap).sum() * d / shared.sum()), j))
            best = [rows[j][t] for _, j in sorted(found)[:k]]
            out[i][t] = np.mean(best) if best else np.nanmean(rows[:, t])
    return out


@pytest.mark.parametrize("block", [4096, 20])
def test_knn_impute_against_brute_force(spark, block):
    """Clustered rows with copies and a row without any value; small blocks exercise the cells."""
    rng = np.random.default_rng(7)
    rows = np.vstack([rng.normal(c, 1.0, (60, 4)) for c in (0, 50, 100)] + [np.full((40, 4), 7.0)])
    rows[rng.random(rows.shape) < 0.15] = np.nan
    rows[5] = np.nan
    names = list("abcd")
    df = spark.createDataFrame(
        [(i, *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(rows)], "k int, a double, b double, c double, d double"
    )
    got = neighbours.knn_impute(df, df, "k", names, 3, block=block).orderBy("k").collect()
    want = brute_force(rows, 3)
    assert len(got) == len(rows)
    assert np.allclose([[r[c] for c in names] for r in got], want)
    assert [[r[f"{c}_missing"] for c in names] for r in got] == np.isnan(rows).astype(int).tolist()


def visits(spark, n: int, **kw) -> tuple[float, int, int]:
    """Cells that rows look into, on average and at most, and how many there are: six coordinates, two of them with gaps, values in clusters."""
    made = spark.range(n).select(
        F.col("id").alias("k"), *[(F.floor(F.rand(i) * 5) * (40 - 5 * i) + F.randn(10 + i)).alias(c) for i, c in enumerate("abcdef")]
    )
    gaps = {c: F.when(F.rand(30 + i) > 0.2, F.col(c)) for i, c in enumerate("ef")}
    df = made.withColumns(gaps)
    asks = df.where("f IS NULL").limit(1000)
    seen, cells = neighbours.cells_visited(asks, df, "k", list("abcdef"), {"f": F.col("f")}, 5, block=100, **kw)
    got = seen.agg(F.avg("n").alias("mean"), F.max("n").alias("most")).first()
    return got["mean"], got["most"], cells


def test_few_cells_are_searched_however_large_the_table(spark):
    """Cells grow with the table; the number that a row looks into does not."""
    small, large = visits(spark, 20_000), visits(spark, 200_000)
    assert small[2] >= 150 and large[2] >= 1_500
    assert large[0] < 50 and large[0] < 3 * small[0]  # ten times the cells


def test_vectors_of_other_clusters_are_ruled_out(spark):
    """In many dimensions boxes stand on principal axes."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1.0, (20, 32))
    rows = [(i, *(centres[i % 20] * 10 + rng.normal(0, 0.5, 32)).tolist()) for i in range(4000)]
    x = [f"e{i}" for i in range(32)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{c} double" for c in x))
    seen, cells = neighbours.cells_visited(df, df, "k", x, {"k": F.col("k")}, 5, exclude_self=True, block=50)
    assert cells >= 60 and seen.agg(F.avg("n")).first()[0] < cells / 8


@pytest.mark.parametrize("block", [4096, 40])
def test_nearest_vectors_by_brute_force(spark, block):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 14)) + 5 * rng.integers(0, 3, (300, 1))
    x[200:220] = x[0]  # copies tie: the smaller key comes first
    names = [f"e{i}" for i in range(14)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(x.tolist())], "k int, " + ", ".join(f"{c} double" for c in names))
    got = neighbours.nearest(df, df, "k", names, {"k": F.col("k")}, 4, exclude_self=True, block=block).collect()
    found = {}
    for r in got:
        found.setdefault(r.k, []).append((r.distance, r.donor))
    for i in range(300):
        far = [(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), j) for j in range(300) if j != i]
        want = sorted(far)[:4]
        assert [j for _, j in sorted(found[i])] == [j for _, j in want]
        assert np.allclose([d for d, _ in sorted(found[i])], [d for d, _ in want])


def test_null_and_repeated_keys_keep_one_row_each(spark):
    rows = [(None if i < 5 else i % 50, float(i % 7) if i % 3 else None, float(i % 11)) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    got = neighbours.knn_impute(df, df, "k", ["a", "b"], 3, block=20)
    assert got.count() == 100 and got.where("a IS NULL").count() == 0
    assert sorted(r.b for r in got.collect()) == sorted(r[2] for r in rows)
    voted = neighbours.knn_classify(df.select("k", "b"), df.where("k IS NOT NULL").withColumn("y", F.col("k") % 2), "k", ["b"], "y", [0, 1], 3)
    assert voted.count() == 100


def test_feature_table_by_neighbours_keeps_every_row(spark):
    from lintel.plans.features import FeatureConfig, fit_features

    rows = [(None if i < 5 else i % 50, i % 2, float(i % 7) if i % 3 else None, float(i % 11), "xyz"[i % 3]) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, y int, a double, b double, c string")
    fitted = fit_features(df, FeatureConfig("k", "y", impute="knn", classes=[0, 1]))
    got = fitted.apply(df, df)
    assert got.count() == 100 and got.where("k IS NULL").count() == 5
    assert got.groupBy("a_missing").count().where("a_missing = 1").first()["count"] == sum(r[2] is None for r in rows)


def test_splits_and_permutations_under_null_and_repeated_keys(spark):
    rows = [(None if i < 5 else i % 50, i % 2, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, y int, a double")
    split = ranking.stratified_split(df, "y", "k", 0.2)
    assert split.count() == 100 and split.where("is_valid IS NULL").count() == 0
    assert 20 <= split.where("is_valid = 1").count() <= 30
    parted = split.where("k IS NOT NULL").groupBy("y", "k").agg(F.count_distinct("is_valid").alias("n"))
    assert parted.where("n > 1").count() == 0  # rows of one key stay together
    dealt = ranking.permuted_rows(df, ["a"], "k", 7)
    assert dealt.count() == 100 and dealt.columns == ["k", "y", "a", "__p_a"]
    assert sorted(r["__p_a"] for r in dealt.collect()) == sorted(r[2] for r in rows) == sorted(r["a"] for r in dealt.collect())


def test_a_key_that_holds_most_rows_does_not_stop_the_split(spark):
    df = spark.range(300).select(F.when(F.col("id") < 200, F.lit(7)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("y"))
    got = ranking.split_thresholds(df, "y", "k", 0.5, 42, most=10)[1]
    assert got is not None
    marked = ranking.stratified_split(df, "y", "k", 0.5)
    assert marked.where("is_valid IS NULL").count() == 0 and marked.where("is_valid = 1").count() >= 150


def test_permutation_importance_of_many_columns_in_one_plan(spark):
    df = spark.range(2000).select(
        F.col("id").alias("k"), (F.col("id") % 2).alias("y"), (F.col("id") % 2).alias("a"), F.rand(1).alias("b"), F.rand(2).alias("c")
    )
    score = lambda t: t.withColumn("prediction", F.col("a"))
    got = {r.feature: r for r in audit.permutation_importance(df, ["a", "b", "c"], "y", "k", score, 3).collect()}
    assert got["a"].importance_mean == pytest.approx(0.5, abs=0.05) and got["b"].importance_mean == got["c"].importance_std == 0


def test_permutation_importance_writes_no_row_again(spark, monkeypatch):
    """Seated rows are written as columns; a repeat moves only what the score reads, and deals as `permuted_rows` does without places."""
    df = spark.createDataFrame([(None if i < 5 else i % 50, i % 2, float(i), float(-i)) for i in range(100)], "k int, y int, a double, b double")
    seated = ranking.seated_rows(df, "k")
    dealt = ranking.permuted_rows(seated, ["a", "b"], "k", 7)
    assert dealt.columns == ["__i", "k", "y", "a", "b", "__row", "__p_a", "__p_b"] and dealt.count() == 100
    assert dealt.where("__p_a <> -__p_b").count() == 0
    other = ranking.permuted_rows(seated.drop("__i"), ["a", "b"], "k", 7)
    assert sorted(map(str, other.collect())) == sorted(map(str, dealt.select(other.columns).collect()))
    plan = dealt.select("__p_a")._jdf.queryExecution().optimizedPlan().toString()
    assert "__p_b" not in plan
    written = []
    monkeypatch.setattr(ranking, "keep", lambda t: written.append(t) or t.localCheckpoint())
    monkeypatch.setattr(ranking, "cut", lambda t: pytest.fail("rows were written again"))
    audit.permutation_importance(df, ["a", "b"], "y", "k", lambda t: t.withColumn("prediction", F.col("a") % 2), 3)
    assert len(written) == 2


def test_rows_travel_once_a_region(spark):
    """Rows that must look into nearly all cells go to each region once, whatever the number of cells, and matrix products give exact distances."""
    rng = np.random.default_rng(9)
    x = rng.normal(1000, 1, (1200, 16))
    x[700:720] = x[3]
    names = [f"e{i}" for i in range(16)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(x.tolist())], "k int, " + ", ".join(f"{c} double" for c in names))
    rows, asks = neighbours._sides(df, df, "k", "k", names, {"k": F.col("k")}, None, True)
    tree = neighbours._plant(rows, [f"x{i}" for i in range(16)], ["t0"], 20)
    _, boxes = neighbours._placed(rows, tree, [f"x{i}" for i in range(16)], ["t0"])
    regions = neighbours._regions(tree, boxes, 300)
    sizes = boxes.groupby(regions[boxes["cell"]])["n"].sum()
    assert tree.cells >= 50 and len(sizes) <= 8 and sizes.max() <= 300 and sizes.sum() == 1200
    sent = neighbours._routed(asks, tree, boxes, regions, [f"x{i}" for i in range(16)], 1, 4, True)
    assert sent.count() <= 1200 * len(sizes) < sent.agg(F.sum("seen")).first()[0]
    got = neighbours.nearest(df, df, "k", names, {"k": F.col("k")}, 4, exclude_self=True, block=20).collect()
    found = {}
    for r in got:
        found.setdefault(r.k, []).append((r.distance, r.donor))
    for i in range(0, 1200, 7):
        far = np.sqrt(neighbours.squared(x[i : i + 1], x, 16)[0])
        assert sorted(found[i]) == sorted((d, j) for j, d in enumerate(far) if j != i)[:4]
