"""Whole jobs: train, cross-validate, tune, predict, audit."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lintel.operators import audit, correlation, evaluate, ranking
from lintel.operators.schema import domain_union
from lintel.plans.features import FeatureConfig, Features, fit_features
from lintel.plans.models import assemble, feature_importance, load_model, logistic, random_forest, save_model, table_bytes
from lintel.session import cut, keep
from lintel.sources import tables

Build = Callable[[], Estimator]
HELD = StorageLevel.MEMORY_AND_DISK
#: Feature tables are held up to this size. A larger one is made anew by each scan, from rows that are columns or written already.
HELD_BYTES = 4 << 30


@dataclass
class Trained:
    """Fitted features and model, with what was measured on the way."""

    features: Features
    model: object
    metrics: DataFrame
    label: str
    key: str
    donors: DataFrame | None = None  # fitted rows, where neighbours fill the nulls

    def score(self, df: DataFrame) -> DataFrame:
        """Rows with probability and prediction, from the stored state only."""
        return self.model.transform(assemble(self.features.apply(df, self.donors), self.features.names))


def prepare(df: DataFrame, config: FeatureConfig, weight_power: float | None = 1.0) -> tuple[Features, DataFrame]:
    """Fitted features and the assembled training rows with class weights."""
    fitted = fit_features(df, config)
    ready = assemble(fitted.apply(df, df), fitted.names)
    ready = ready.select(config.key, F.col(config.label).cast("double").alias(config.label), "features")
    if weight_power is not None:
        ready = evaluate.class_weights(ready, config.label, weight_power)
    return fitted, ready


def hold(*ready: DataFrame) -> list[DataFrame]:
    """The given tables that were persisted, which are those of HELD_BYTES at most."""
    return [table.persist(HELD) for table in ready if table_bytes(table) <= HELD_BYTES]


def train_job(
    df: DataFrame, config: FeatureConfig, build: Build, test_size: float = 0.2, seed: int = 42, weight_power: float | None = 1.0
) -> Trained:
    """Split, features, weights, fit, evaluate on both parts."""
    split = ranking.stratified_split(df, config.label, config.key, test_size, seed)
    train, valid = split.where("is_valid = 0").drop("is_valid"), split.where("is_valid = 1").drop("is_valid")
    fitted, ready = prepare(train, config, weight_power)
    held = hold(ready)
    try:
        model = build().fit(ready)
        trained = Trained(fitted, model, None, config.label, config.key, train if config.impute == "knn" else None)
        sets = {"train": model.transform(ready), "valid": trained.score(valid)}
        trained.metrics = cut(evaluate.evaluate_sets(sets, config.label, "prediction", config.classes))
    finally:
        for table in held:
            table.unpersist()
    return trained


def save_trained(spark, trained: Trained, path: str) -> None:
    """Features, model and metrics under one folder."""
    trained.features.save(spark, f"{path}/features")
    save_model(spark, trained.model, f"{path}/model")
    tables.write_report(trained.metrics, f"{path}/metrics")
    if trained.donors is not None:
        kept = [trained.key, *trained.features.params["numeric"]]
        trained.donors.select(kept).write.mode("overwrite").parquet(f"{path}/donors")


def load_trained(spark, path: str) -> Trained:
    features = Features.load(spark, f"{path}/features")
    model = load_model(spark, f"{path}/model")
    metrics = spark.read.json(f"{path}/metrics")
    knn = features.params["impute"] == "knn"
    donors = spark.read.parquet(f"{path}/donors") if knn else None
    return Trained(features, model, metrics, features.params["label"], features.params["key"], donors)


def predict_job(trained: Trained, df: DataFrame, proba: bool = False) -> DataFrame:
    """Key, Id and predicted label; with `proba` the class probabilities too."""
    scored = trained.score(df)
    if not proba:
        return tables.number_predictions(scored, trained.key, target=trained.label)
    # the probabilities ride along through the numbering, so rows are scored once
    slim = scored.select(
        trained.key, F.col("prediction").cast("int").alias(trained.label), vector_to_array("probability").alias("probs")
    )
    return ranking.dense_position(slim, trained.key, "Id")


def fold_tables(
    df: DataFrame, config: FeatureConfig, k: int = 3, seed: int = 42, weight_power: float | None = None
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(train, valid) feature tables fold by fold, features learnt on the fold's training rows only.

    A fold of HELD_BYTES at most is held while it is in use and let go when the next one is asked for.
    """
    folded = keep(ranking.stratified_folds(df, config.label, config.key, k, seed))
    for f in range(k):
        train, valid = (t.drop("fold") for t in ranking.fold_rows(folded, f))
        fitted, ready = prepare(train, config, weight_power)
        other = assemble(fitted.apply(valid, train), fitted.names).select(config.key, config.label, "features")
        held = hold(ready, other)
        try:
            yield ready, other
        finally:
            for table in held:
                table.unpersist()


@dataclass
class CrossValidated:
    """What cross-validation yields: metrics over folds, per fold, and one report of all folds."""

    summary: DataFrame
    folds: DataFrame
    report: DataFrame


def cv_job(
    df: DataFrame, config: FeatureConfig, build: Build, k: int = 3, seed: int = 42, weight_power: float | None = 1.0,
    path: str | None = None,
) -> CrossValidated:
    """Mean, std, min and max of the validation metrics over folds, the folds' own metrics, and the combined report.

    With a path every fold's model is saved below it.
    """
    counts = []
    for f, (train, valid) in enumerate(fold_tables(df, config, k, seed, weight_power)):
        model = build().fit(train)
        if path:
            save_model(df.sparkSession, model, f"{path}/fold-{f}")
        matrix = evaluate.confusion_matrix(model.transform(valid), config.label, "prediction", config.classes)
        counts.append(cut(matrix.withColumn("fold", F.lit(f))))
    matrix = reduce(DataFrame.unionByName, counts)
    metrics = evaluate.classification_metrics(matrix, ["fold"])
    rows = evaluate.metric_rows(metrics, ["fold"])
    report = evaluate.combine_reports(evaluate.class_report(matrix, ["fold"]), metrics.select("fold", "accuracy"))
    return CrossValidated(evaluate.aggregate_folds(rows), metrics, report)


def adversarial_validation(
    train: DataFrame, valid: DataFrame, key: str, names: list[str], seed: int = 42
) -> tuple[DataFrame, object]:
    """AUC of a model that tells valid rows from train rows, its drift level, and the model."""
    both = domain_union(train.select(key, *names), valid.select(key, *names))
    split = ranking.stratified_split(both, "domain", key, 0.3, seed)
    ready = assemble(split, names).select(key, F.col("domain").cast("double").alias("domain"), "features", "is_valid")
    model = logistic({"maxIter": 100, "regParam": 0.0}, "domain").fit(ready.where("is_valid = 0"))
    scored = model.transform(ready.where("is_valid = 1")).select("domain", vector_to_array("probability")[1].alias("p"))
    auc = audit.rank_auc(cut(scored), "domain", "p")
    return auc.withColumn("drift", audit.drift_level(F.col("auc"))), model


def drift_weights(df: DataFrame, model, names: list[str], out: str = "drift_weight") -> DataFrame:
    """1 - p(valid) per training row."""
    scored = model.transform(assemble(df, names, "features"))
    return scored.withColumn(out, 1 - vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def rfe(df: DataFrame, names: list[str], label: str, keep: int, step: float = 0.2, params: dict | None = None) -> list[str]:
    """Refit and drop the weakest share of features until `keep` are left."""
    left = list(names)
    held = df.select(label, *names).persist(HELD)
    try:
        while len(left) > keep:
            model = random_forest(params, label).fit(assemble(held, left))
            gains = model.featureImportances.toArray()
            drop = min(len(left) - keep, max(1, int(step * len(names))))
            weakest = sorted(range(len(left)), key=lambda i: (gains[i], left[i]))[:drop]
            left = [c for i, c in enumerate(left) if i not in set(weakest)]
    finally:
        held.unpersist()
    return left


def audit_job(trained: Trained, train: DataFrame, valid: DataFrame, columns: list[str], repeats: int = 2, threshold: float = 0.95) -> dict[str, DataFrame]:
    """Importance, permutation importance, drift and redundancy, from the stored state."""
    key, label, names = trained.key, trained.label, trained.features.names
    donors = trained.donors
    train_features, valid_features = trained.features.apply(train, donors), cut(trained.features.apply(valid, donors))

    def score(df: DataFrame) -> DataFrame:
        return trained.model.transform(assemble(df, names))

    drift, _ = adversarial_validation(train_features, valid_features, key, columns)
    return {
        "feature_importance": feature_importance(trained.model, trained.features.slots, train),
        "permutation_importance": audit.permutation_importance(valid_features, columns, label, key, score, repeats),
        "adversarial_validation": drift,
        "high_correlations": correlation.redundant_pairs(train_features, columns, threshold),
    }
