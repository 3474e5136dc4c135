"""Rows kept, no NaN, partitioning without influence, state independent of other rows."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintel.functions.derived import DERIVED, add_derived, fit_plot_edges
from lintel.operators import clean, encode, groups, ranking, scale
from lintel.operators.state import Fitted
from lintel.plans.features import FeatureConfig, fit_features
from lintel.sources.listing import CLASSES, KEY, LABEL, NUMERIC, listing

CONFIG = FeatureConfig(KEY, LABEL, classes=CLASSES)


@pytest.fixture(scope="module")
def rows(spark):
    return listing(spark, SMALL).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return fit_features(rows.where("YearListed < 1997"), CONFIG)


def doubles(df):
    return [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]


def test_features_keep_rows_and_names(rows, fitted):
    out = fitted.apply(rows)
    assert out.columns == [KEY, LABEL, *fitted.names]
    assert out.count() == rows.count()
    bad = out.agg(*[F.count_if(F.col(f"`{c}`").isNull() | F.isnan(f"`{c}`")).alias(c) for c in doubles(out)]).first()
    assert not any(bad)


def test_features_do_not_depend_on_partitioning(rows, fitted):
    digest = lambda df: df.select(F.sum(F.xxhash64(*df.columns) % 1_000_003)).first()[0]
    assert digest(fitted.apply(rows.repartition(1))) == digest(fitted.apply(rows.repartition(13)))


def test_features_survive_saving(spark, rows, fitted, tmp_path):
    fitted.save(spark, str(tmp_path / "f"))
    loaded = Fitted.load(spark, str(tmp_path / "f"))
    assert loaded.names == fitted.names
    assert loaded.apply(rows).exceptAll(fitted.apply(rows)).count() == 0


def test_plain_model_has_no_derived_columns(rows):
    plain = fit_features(rows, FeatureConfig(KEY, LABEL, classes=CLASSES, model="tabnet"))
    assert not set(plain.names) & set(DERIVED)
    assert not any("ZScore" in n for n in plain.names)


def test_features_with_neighbour_imputation(rows):
    few = rows.select(KEY, LABEL, "PlotSize", "BasementArea", "TotalRooms", "RoofType", "HeatingType")
    config = FeatureConfig(KEY, LABEL, classes=CLASSES, impute="knn", wide=False, group_statistics=False)
    knn = fit_features(few, config)
    out = knn.apply(few, donors=few)
    assert out.count() == few.count()
    assert out.where("PlotSize IS NULL OR BasementArea IS NULL").count() == 0


def test_derived_has_no_nan(rows):
    out = add_derived(rows, plot_edges=fit_plot_edges(rows)).select(DERIVED)
    bad = out.agg(*[F.count_if(F.isnan(c) | (F.abs(c) == float("inf"))).alias(c) for c in DERIVED]).first()
    assert not any(bad)


def test_target_encoding_sums_to_one(rows):
    out = encode.fit_target(rows, ["BuildingType"], LABEL, CLASSES).apply(rows)
    total = sum(F.col(f"TE__BuildingType__p{i}") for i in range(5))
    assert out.where(F.abs(total - 1) > 1e-9).count() == 0


def test_split_is_disjoint_and_complete(rows):
    marked = ranking.stratified_split(rows, LABEL, KEY, 0.2).groupBy(LABEL).agg(F.count("*").alias("n"), F.sum("is_valid").alias("v"))
    assert all(r.v == int(r.n * 0.2) for r in marked.collect())


def test_folds_are_balanced(rows):
    sizes = ranking.stratified_folds(rows, LABEL, KEY, 5).groupBy(LABEL, "fold").count().collect()
    for y in CLASSES:
        counts = [r["count"] for r in sizes if r[LABEL] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_state_ignores_rows_it_was_not_fitted_on(rows):
    train = rows.where("YearListed < 1997")
    changed = rows.withColumn("PlotSize", F.when(F.col("YearListed") < 1997, F.col("PlotSize")).otherwise(1e9))
    again = changed.where("YearListed < 1997")
    for fit in (
        lambda t: clean.fit_impute(t, NUMERIC).params,
        lambda t: clean.fit_outlier_bounds(t, NUMERIC).params,
        lambda t: scale.fit_robust(t, NUMERIC).params,
        lambda t: {"e": fit_plot_edges(t)},
    ):
        assert fit(train) == fit(again)


def test_own_fold_has_no_part_in_its_encoding(rows):
    """Turning the labels of one fold around leaves that fold's encodings as they are."""
    folded = ranking.stratified_folds(rows.select(KEY, LABEL, "BuildingType"), LABEL, KEY, 5).cache()
    turned = folded.withColumn(LABEL, F.when(F.col("fold") == 2, 4 - F.col(LABEL)).otherwise(F.col(LABEL)))
    encoded = [
        {r[KEY]: r["TE__BuildingType__p0"] for r in encode.target_encode_oof(t, ["BuildingType"], LABEL, "fold", CLASSES).where("fold = 2").collect()}
        for t in (folded, turned)
    ]
    assert encoded[0] == encoded[1]


def test_group_statistics_on_new_rows(rows):
    train = rows.where("BuildingType <> 'PROMO'").limit(500)
    fitted = groups.fit_group_stats(train, ["BuildingType"], ["PlotSize"])
    assert fitted.apply(rows).count() == rows.count()
