"""Small cases with values worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from lintel.functions import derived as D
from lintel.functions.nullsafe import (
    bin_edges,
    blank_or_null_flag,
    clip,
    equal_width_edges,
    log1p_clip,
    product,
    safe_ratio,
    to_num,
)
from lintel.operators import audit, clean, encode, evaluate, groups, neighbours, profile, schema
from lintel.plans.ensemble import vote_hard
from lintel.plans.search import draw, grid, model_pool
from lintel.sources.tables import read_table


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(df) if callable(expr) else expr).collect()]


def test_frequency(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "k int, c string")
    fitted = encode.fit_frequency(df, ["c"])
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z")], "k int, c string")
    assert {r.c: r.FE__c for r in fitted.apply(new).collect()} == {"a": 0.5, "b": 0.25, "z": 0.0}


def test_frequency_null_is_a_category(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, c string")
    assert {r.c: r.FE__c for r in encode.fit_frequency(df, ["c"]).apply(df).collect()} == {"a": 0.5, None: 0.5}


def test_target_encoding(spark):
    df = spark.createDataFrame([("x", 0), ("x", 1), ("y", 1)], "c string, y int")
    fitted = encode.fit_target(df, ["c"], "y", alpha=10.0)
    new = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    got = {r.c: (r.TE__c__p0, r.TE__c__p1) for r in fitted.apply(new).collect()}
    assert got["x"] == pytest.approx((13 / 36, 23 / 36))
    assert got["y"] == pytest.approx((10 / 33, 23 / 33))
    assert got["z"] == pytest.approx((1 / 3, 2 / 3))


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (1.0, None), (None, 2.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, None, None, None, 0.25]


def test_clip_keeps_null(spark):
    assert column(spark, [-1.0, 3.0, 30.0, None], "double", clip(F.col("v"))) == [0.0, 3.0, 20.0, None]


def test_product_drops_infinity(spark):
    assert column(spark, [1e308, 2.0, None], "double", product(F.col("v"), F.lit(100.0))) == [None, 200.0, None]


def test_to_num(spark):
    got = column(spark, ["1.5", " 7 ", "n/a", "", "nan", "1d", None], "string", lambda df: to_num(df, "v"))
    assert got == [1.5, 7.0, None, None, None, None, None]
    assert column(spark, [1.0], "double", lambda df: to_num(df, "absent")) == [None]
    assert column(spark, [float("nan")], "double", lambda df: to_num(df, "v")) == [None]
    with pytest.raises(TypeError):
        to_num(spark.sql("SELECT DATE '2020-01-01' AS v"), "v")


def test_ages(spark):
    df = spark.createDataFrame([(2000, 2005), (2005, 2000), (None, 1)], "a int, b int")
    assert [r[0] for r in df.select(D.building_age(F.col("a"), F.col("b"))).collect()] == [None, 5, None]


def test_age_bins(spark):
    got = column(spark, [0.0, 10.0, 10.5, 25.0, 200.0, 201.0, None], "double", bin_edges(F.col("v"), D.AGE_EDGES))
    assert got == [0, 0, 1, 1, 4, None, None]


def test_life_stage(spark):
    assert column(spark, [5.0, 6.0, 30.0, 50.0, 51.0, None], "double", D.life_stage(F.col("v"))) == [1, 2, 3, 4, 5, 3]


def test_season_and_strength(spark):
    assert column(spark, [12.0, 1.0, 3.0, 8.0, 11.0], "double", D.season(F.col("v"))) == [1, 1, 2, 3, 4]
    assert column(spark, [6.0, 12.0, 1.0], "double", D.seasonal_strength(F.col("v"))) == pytest.approx([1, 0, 1 / 6])


def test_decade(spark):
    assert column(spark, [1987.0, None], "double", D.decade(F.col("v"))) == [1980, None]


def test_basement_fallback(spark):
    df = spark.createDataFrame(
        [(None, 10.0, None, 5.0), (None, None, None, None), (None, 0.0, 0.0, 0.0), (7.0, 1.0, 1.0, 1.0)],
        "a double, p double, q double, r double",
    )
    got = [r[0] for r in df.select(D.total_basement(F.col("a"), [F.col(c) for c in "pqr"])).collect()]
    assert got == [15.0, None, None, 7.0]


def test_renovation_need(spark):
    rows = [(2000, 1940, 1990, 2), (2000, None, 1990, 2)]
    df = spark.createDataFrame(rows, "YearListed int, ConstructionYear int, RenovationYear int, BuildingCondition int")
    assert [r[0] for r in D.add_derived(df, ["RenovationNeed"]).select("RenovationNeed").collect()] == [120.0, None]


def test_blank_flag(spark):
    assert column(spark, [None, "", "  ", "\t\n", "Good"], "string", lambda df: blank_or_null_flag(df, "v")) == [1, 1, 1, 1, 0]


def test_equal_width_edges_of_a_constant():
    edges = equal_width_edges(4.0, 4.0, 5)
    assert edges[0] < 4.0 < edges[-1] and len(edges) == 6


def test_log1p_clip(spark):
    assert column(spark, [-5.0, 0.0, math.e - 1, None], "double", log1p_clip(F.col("v"))) == [0.0, 0.0, pytest.approx(1.0), None]


def test_group_of_one_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0), (None, 2.0)], "g string, v double")
    got = {(r.g, r.v): r["v_ZScore__g"] for r in groups.fit_group_stats(df, ["g"], ["v"]).apply(df).collect()}
    assert got[("a", 1.0)] is None and got[(None, 2.0)] is None
    assert got[("b", 3.0)] == pytest.approx(1 / (math.sqrt(2) + 1e-6))


def test_outlier_actions(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (None,)], "v double")
    fitted = clean.fit_outlier_bounds(df, ["v"], "iqr", 1.5)
    assert fitted.apply(df, "remove").count() == 20
    assert fitted.apply(df, "nan").where("v IS NULL").count() == 2
    clipped = fitted.apply(df, "clip")
    assert clipped.where("v IS NULL").count() == 1
    assert clipped.agg(F.max("v")).first()[0] == fitted.bounds["v"][1]
    assert fitted.info(df).first().n_total == 1
    with pytest.raises(ValueError):
        fitted.apply(df, "other")


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert sorted({round(r.weight, 9) for r in evaluate.class_weights(df, "y").collect()}) == [round(2 / 3, 9), 2.0]


def test_drift_levels(spark):
    assert column(spark, [0.54, 0.55, 0.65, 0.75], "double", audit.drift_level(F.col("v"))) == ["none", "mild", "moderate", "high"]


def test_rank_auc(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "y int, s double")
    assert audit.rank_auc(df, "y", "s").first().auc == pytest.approx(0.875)


def test_impute_strategies(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, "a"), (9.0, "b"), (None, None)], "v double, c string")
    fills = lambda s, c: clean.fit_impute(df, [c], s).params["fills"][c]
    assert fills("median", "v") == 3.0 and fills("mean", "v") == 4.0
    assert fills("most_frequent", "v") == 1.0 and fills("most_frequent", "c") == "a"
    assert clean.fit_impute(df, ["v"], "median", add_indicator=True).apply(df).columns == ["v", "c", "v_missing"]


def test_rare_values_not_seen_at_fit_stay(spark):
    df = spark.createDataFrame([("a",)] * 99 + [("b",)], "c string")
    fitted = clean.fit_rare(df, ["c"], 0.05)
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    assert sorted(str(r.c) for r in fitted.apply(new).collect()) == sorted(["a", "__RARE__", "z", "None"])


def test_matrix_health(spark):
    df = spark.createDataFrame([(0.0, float("inf")), (None, 0.0), (1.0, float("nan"))], "a double, b double")
    got = profile.matrix_health(df, ["a", "b"]).first()
    assert (got.n_rows, got.n_columns, got.n_nan, got.n_inf) == (3, 2, 2, 1)
    assert got.zero_share == pytest.approx(2 / 6)


def test_types_and_policy(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, true AS c")
    assert schema.infer_column_types(df) == (["a", "c"], ["b"])
    with pytest.raises(ValueError):
        schema.drop_policy_columns(df, ["a", "b", "c"])
    with pytest.raises(TypeError):
        schema.column_kinds(spark.sql("SELECT array(1) AS a"))


def test_votes(spark):
    df = spark.createDataFrame([(0, 1, 2), (2, 1, 1), (0, 2, 2)], "a int, b int, c int")
    assert [r[0] for r in df.select(vote_hard(["a", "b", "c"], [0, 1, 2])).collect()] == [0, 1, 2]


def test_neighbour_at_distance_zero_counts_alone(spark):
    donors = spark.createDataFrame([(1, 0.0, 1), (2, 1.0, 0), (3, 2.0, 0)], "k int, x double, y int")
    ask = spark.createDataFrame([(9, 0.0)], "k int, x double")
    got = neighbours.knn_classify(ask, donors, "k", ["x"], "y", [0, 1], 3, "distance").first()
    assert (got.p0, got.p1, got.prediction) == (0.0, 1.0, 1)


def test_read_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n1,x,1.5\nNA,NULL,nan\n3,,oops\n")
    got = read_table(spark, str(tmp_path / "t.csv"), "a INT, b STRING, c DOUBLE").collect()
    assert [tuple(r) for r in got] == [(1, "x", 1.5), (None, None, None), (3, None, None)]
    inferred = read_table(spark, str(tmp_path / "t.csv"))
    assert dict(inferred.dtypes) == {"a": "bigint", "b": "string", "c": "string"}


def test_parameter_spaces():
    drawn = draw({"n": (1, 3), "r": (0.0, 1.0), "m": ["a", "b"]}, 20, 1)
    assert {d["n"] for d in drawn} <= {1, 2, 3} and all(0 <= d["r"] <= 1 for d in drawn)
    assert drawn == draw({"n": (1, 3), "r": (0.0, 1.0), "m": ["a", "b"]}, 20, 1)
    assert len(grid({"a": [1, 2], "b": [3, 4, 5]})) == 6
    assert len(model_pool({"x": ({"n": (1, 2)}, 3), "y": ({"n": (1, 2)}, 2)}, 7)) == 7
