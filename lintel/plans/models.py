"""Learners as MLlib estimators, and two one-vs-rest learners with class probabilities."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.storagelevel import StorageLevel

from lintel.operators.neighbours import close, nearest, neighbour_weight
from lintel.operators.state import State, lookup
from lintel.plans.labels import LabelMap
from lintel.plans.persist import Kept, load_stage, save_stage
from lintel.session import keep

Builder = Callable[[dict], Estimator]
#: Learners that are fitted at a time, while the rows take HELD_BYTES at most; on more rows it is one, as each keeps them in memory.
PARALLEL = 3
HELD_BYTES = 512 << 20
#: Labelled rows that a nearest-neighbour model sends to every executor, and their size; more are searched where they lie.
LOCAL_ROWS = 1 << 16
DONOR_BYTES = 256 << 20


def vector_bytes(df: DataFrame, features: str = "features") -> int:
    """What a row of features takes as doubles, from the first one."""
    first = df.select(features).first()
    return 8 * (first[0].size if first and first[0] is not None else 0)


def at_a_time(df: DataFrame, parallelism: int, features: str = "features") -> int:
    """How many learners to fit at a time on df: one where its rows are more than HELD_BYTES."""
    return parallelism if table_bytes(df, features) <= HELD_BYTES else 1


def table_bytes(df: DataFrame, features: str = "features") -> int:
    return df.count() * vector_bytes(df, features)


def assemble(df: DataFrame, names: list[str], out: str = "features") -> DataFrame:
    """Feature columns as one vector; stays sparse where most values are zero."""
    return VectorAssembler(inputCols=names, outputCol=out, handleInvalid="error").transform(df)


def probabilities(df: DataFrame, col: str = "probability", out: str = "probs") -> DataFrame:
    return df.withColumn(out, vector_to_array(col))


def logistic(params: dict | None = None, label: str = "label", weight: str | None = None) -> Estimator:
    p = {"maxIter": 100, "regParam": 0.01, **(params or {})}
    return _weighted(LogisticRegression(family="multinomial", labelCol=label, **p), weight)


def random_forest(params: dict | None = None, label: str = "label", weight: str | None = None) -> Estimator:
    p = {"numTrees": 50, "maxDepth": 10, "seed": 42, **(params or {})}
    return _weighted(RandomForestClassifier(labelCol=label, **p), weight)


def gaussian_nb(params: dict | None = None, label: str = "label", weight: str | None = None) -> Estimator:
    return _weighted(NaiveBayes(modelType="gaussian", labelCol=label, **(params or {})), weight)


def linear_svm(params: dict | None = None, label: str = "label", weight: str | None = None) -> Estimator:
    """One linear machine per class; the softmax of their margins is the class probability."""
    p = {"maxIter": 50, "regParam": 0.01, **(params or {})}
    return _weighted(ClassScores(kind="svm", labelCol=label).with_params(p), weight)


class Mlp(Estimator):
    """Feed-forward net with hidden layers as given; input width and classes are read from the rows."""

    def __init__(self, settings: dict | None = None, label: str = "label"):
        super().__init__()
        self.settings, self.label = {"maxIter": 100, "seed": 42, "hidden": [16], **(settings or {})}, label

    def _fit(self, df: DataFrame):
        p = dict(self.settings)
        hidden = p.pop("hidden")
        if "layers" not in p:
            width = df.select(F.coalesce(F.max(F.size(vector_to_array("features"))), F.lit(0))).first()[0]
            top = df.agg(F.max(F.col(self.label).cast("int"))).first()[0]
            p["layers"] = [width, *hidden, int(top or 0) + 1]
        return MultilayerPerceptronClassifier(labelCol=self.label, **p).fit(df)


def mlp(params: dict | None = None, label: str = "label", weight: str | None = None) -> Mlp:
    """Feed-forward net; it takes no row weights."""
    return Mlp(params, label)


def knn(params: dict | None = None, label: str = "label", weight: str | None = None) -> KnnClassifier:
    """Nearest neighbours; rows have one weight each."""
    return KnnClassifier(label=label, **(params or {}))


def boosted_trees(
    params: dict | None = None, label: str = "label", weight: str | None = None, validation: str | None = None
) -> Estimator:
    p = {"maxIter": 20, "maxDepth": 5, "seed": 42, **(params or {})}
    if validation:
        p["validationIndicatorCol"] = validation
    return _weighted(ClassScores(kind="boost", labelCol=label).with_params(p), weight)


def ridge_classifier(params: dict | None = None, label: str = "label", weight: str | None = None) -> Estimator:
    p = {"regParam": 1.0, "elasticNetParam": 0.0, "solver": "normal", **(params or {})}
    return _weighted(ClassScores(kind="ridge", labelCol=label).with_params(p), weight)


def _weighted(estimator, weight: str | None):
    return estimator.setWeightCol(weight) if weight else estimator


BUILDERS: dict[str, Callable[..., Estimator]] = {
    "logistic": logistic,
    "random_forest": random_forest,
    "extra_trees": random_forest,
    "boosted_trees": boosted_trees,
    "naive_bayes": gaussian_nb,
    "svm": linear_svm,
    "ridge": ridge_classifier,
    "mlp": mlp,
    "knn": knn,
}


class _ScoreParams(HasLabelCol, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasWeightCol):
    kind = Param(Params._dummy(), "kind", "boost, svm or ridge", TypeConverters.toString)


class ClassScores(Estimator, _ScoreParams, DefaultParamsWritable, DefaultParamsReadable):
    """One binary learner per class; their scores give class probabilities.

    boost: gradient-boosted trees, probabilities of the classes brought to sum 1.
    svm: linear machines, softmax of the margins.
    ridge: least squares on +-1 targets with L2, softmax of the scores.
    """

    @keyword_only
    def __init__(self, kind: str = "boost", labelCol: str = "label"):
        super().__init__()
        self._setDefault(kind="boost")
        self._set(**self._input_kwargs)
        self.base_params: dict = {}

    def with_params(self, params: dict) -> ClassScores:
        self.base_params = params
        return self

    def setWeightCol(self, value: str) -> ClassScores:
        return self._set(weightCol=value)

    def _fit(self, dataset: DataFrame) -> ClassScoresModel:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        size = dataset.agg(F.count("*").alias("n"), F.count(label).alias("labelled")).first()
        if size.labelled < size.n:
            raise ValueError(f"{label} has null labels: leave such rows out before fitting")
        known = LabelMap.fit(dataset, label)  # one model is fitted for each class
        kind = self.getOrDefault("kind")
        weight = self.getWeightCol() if self.isDefined("weightCol") else None
        # MLlib's learners keep the rows in a form of their own, for each class at a time: a large table is not held beside it as well
        small = size.n * vector_bytes(dataset, features) <= HELD_BYTES
        own = small and dataset.storageLevel == StorageLevel.NONE
        held = dataset.persist() if own else dataset

        def fit(y):
            hit = F.col(label).cast("string" if known.text else "double") == F.lit(y)
            target = F.when(hit, 1.0).otherwise(-1.0) if kind == "ridge" else hit.cast("double")
            learner = {"boost": GBTClassifier, "svm": LinearSVC, "ridge": LinearRegression}[kind]
            estimator = learner(featuresCol=features, labelCol="__y", **self.base_params)
            return _weighted(estimator, weight).fit(held.withColumn("__y", target))

        try:
            with ThreadPool(PARALLEL if small else 1) as pool:
                models = pool.map(fit, known.classes)
        finally:
            if own:
                held.unpersist()
        return self._copyValues(ClassScoresModel(known.classes, models))


class ClassScoresModel(Kept, Model, _ScoreParams):
    """Scores by class; probability has one place a class, in the order of `classes`."""

    def __init__(self, classes: Sequence, models: list):
        super().__init__()
        self._setDefault(kind="boost")
        self.known = LabelMap.of(list(classes))
        self.models = models

    @property
    def classes(self) -> list:
        return list(self.known.classes)

    def told(self) -> dict:
        return {"classes": self.classes}

    def parts(self) -> dict[str, object]:
        return {f"part-{i}": m for i, m in enumerate(self.models)}

    @classmethod
    def made(cls, told, part):
        return cls(told["classes"], [part(f"part-{i}") for i in range(len(told["classes"]))])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kind = self.getOrDefault("kind")
        boost = kind == "boost"
        out = dataset
        names = [f"__s{i}" for i in range(len(self.classes))]
        for name, model in zip(names, self.models, strict=True):
            model = model.copy().setFeaturesCol(self.getFeaturesCol())
            if boost:
                model = model.setPredictionCol("__p").setRawPredictionCol("__r").setProbabilityCol("__q")
                out = model.transform(out).withColumn(name, vector_to_array("__q")[1]).drop("__p", "__r", "__q")
            elif kind == "svm":
                model = model.setPredictionCol("__p").setRawPredictionCol("__r")
                out = model.transform(out).withColumn(name, vector_to_array("__r")[1]).drop("__p", "__r")
            else:
                out = model.setPredictionCol(name).transform(out)
        shares = shares_of(names) if boost else softmax(names)
        out = out.withColumns({f"__c{i}": c for i, c in enumerate(shares)})
        picked = [f"__c{i}" for i in range(len(names))]
        return out.withColumns({
            self.getProbabilityCol(): array_to_vector(F.array(*picked)),
            self.getPredictionCol(): self.known.pick(picked),
        }).drop(*names, *picked)


class KnnClassifier(Estimator):
    """k nearest neighbours by Euclidean distance over all labelled rows, exact.

    The labelled rows are written once as columns; the model reads them from there. weights: uniform or distance.
    """

    def __init__(self, k: int = 5, weights: str = "uniform", label: str = "label"):
        super().__init__()
        self.k, self.weights, self.label = k, weights, label

    def _fit(self, df: DataFrame) -> KnnModel:
        known = LabelMap.fit(df, self.label)
        rows = df.where(F.col(self.label).isNotNull()).select(
            vector_to_array("features").alias("x"), known.slot(self.label).cast("int").alias("y")
        )
        return KnnModel(keep(rows), self.k, self.weights, known)


class KnnModel(Kept, Model):
    """Labelled rows: features x and slots y. probability has one place a class, in the order of `classes`.

    Up to LOCAL_ROWS labelled rows go to every executor and are compared there. More are searched by `neighbours.nearest`, for each
    different vector once, whose votes come back by that vector. Both take the same neighbours: the nearest, and of equally far ones those with the
    smaller hash of features and label.
    """

    def __init__(self, rows: DataFrame, k: int, weights: str, known: LabelMap):
        super().__init__()
        self.rows, self.k, self.weights, self.known = rows, k, weights, known

    @property
    def classes(self) -> list:
        return list(self.known.classes)

    def told(self) -> dict:
        return {"k": self.k, "weights": self.weights, "classes": self.classes}

    def parts(self) -> dict[str, object]:
        return {"rows": self.rows}

    @classmethod
    def made(cls, told, part):
        return cls(part("rows"), told["k"], told["weights"], LabelMap.of(told["classes"]))

    def _transform(self, df: DataFrame) -> DataFrame:
        size = self.rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
        local = size.n <= LOCAL_ROWS and 8 * size.n * (size.width or 0) <= DONOR_BYTES
        voted = self._sent(df, min(self.k, size.n)) if local else self._searched(df, size.width)
        places = [f"__share{i}" for i in range(len(self.known))]
        out = voted.withColumns({c: F.get("__shares", F.lit(i)) for i, c in enumerate(places)})
        return out.withColumns({"probability": array_to_vector("__shares"), "prediction": self.known.pick(places)}).drop("__shares", *places)

    def _sent(self, df: DataFrame, k: int) -> DataFrame:
        """The labelled rows are sent once to each executor, not with every task."""
        rows = self.rows.withColumn("h", F.xxhash64("x", "y")).toPandas().sort_values("h", kind="stable")
        known = np.array(rows["x"].tolist(), float), rows["y"].to_numpy(int)
        sent, by_distance, n = df.sparkSession.sparkContext.broadcast(known), self.weights == "distance", len(self.known)

        @pandas_udf("array<double>")
        def shares(features: pd.Series) -> pd.Series:
            x, y = sent.value
            hits = (y[:, None] == np.arange(n)[None, :]).astype(float)
            out = []
            for at in range(0, len(features), 256):
                q = np.array(features.iloc[at : at + 256].tolist(), float)
                i, j, far = close(q, x, np.full(len(q), np.inf), None, k)
                gap = np.sqrt(far)
                order = np.lexsort((j, gap, i))
                i, j, gap = i[order], j[order], gap[order]
                first = np.arange(len(i)) - np.searchsorted(i, i) < k
                near, gap = j[first].reshape(len(q), k), gap[first].reshape(len(q), k)
                exact = gap == 0
                w = np.where(exact.any(1)[:, None], exact, 1 / np.where(exact, 1.0, gap)) if by_distance else np.ones_like(gap)
                votes = (hits[near] * w[:, :, None]).sum(1)
                out += (votes / votes.sum(1, keepdims=True)).tolist()
            return pd.Series(out)

        return df.withColumn("__shares", shares(vector_to_array("features")))

    def _searched(self, df: DataFrame, width: int) -> DataFrame:
        """Neighbours by the tree over all labelled rows; each different vector is looked up once, under a number written with it."""
        x = [f"x{i}" for i in range(width)]
        spread = [F.get("x", F.lit(i)).alias(c) for i, c in enumerate(x)]
        identity = {"__h1": F.xxhash64("__x"), "__h2": F.xxhash64(F.lit(1), "__x")}
        hashed = df.withColumn("__x", vector_to_array("features")).withColumns(identity)
        each = hashed.where("__x IS NOT NULL").groupBy("__h1", "__h2").agg(F.count("*").alias("__n"), F.first("__x").alias("x"))
        asked = keep(each.withColumn("__q", F.monotonically_increasing_id()))
        donors = self.rows.select(F.xxhash64("x", "y").alias("__row"), "y", *spread)
        found = nearest(asked.select("__q", F.lit(None).cast("bigint").alias("__row"), *spread), donors, "__row", x, {"y": F.col("y")}, self.k, row="__q")
        weighted = found.withColumn("w", neighbour_weight(["__q"], self.weights))
        votes = [F.sum(F.when(F.col("value") == i, F.col("w")).otherwise(0.0)) / F.sum("w") for i in range(len(self.known))]
        shares = weighted.groupBy("__q").agg(F.array(*votes).alias("__shares"))
        table = keep(asked.select("__h1", "__h2", "__n", "__q").join(shares, "__q").drop("__q"))
        back = lookup(hashed, State.of(table, count="__n"), {"__h1": "__h1", "__h2": "__h2"}, {"__shares": "__shares"})
        return back.drop("__x", "__h1", "__h2")


def save_model(spark: SparkSession, model, path: str) -> None:
    """Any learner's model under one folder; its own metadata tell load_model what it is."""
    save_stage(model, path)


def load_model(spark: SparkSession, path: str):
    return load_stage(spark, path)


def shares_of(names: list[str]) -> list[Column]:
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return [F.when(total > 0, F.col(n) / total).otherwise(1.0 / len(names)) for n in names]


def softmax(names: list[str]) -> list[Column]:
    """Softmax over columns, shifted by the largest for safety."""
    top = F.greatest(*names)
    parts = [F.exp(F.col(n) - top) for n in names]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def feature_importance(model, names: list[str], df: DataFrame) -> DataFrame:
    """Importance per feature: split gains, or mean absolute coefficient over classes, largest first."""
    values = importance_values(model, len(names))
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def importance_values(model, width: int) -> list[float]:
    if isinstance(model, ClassScoresModel):
        parts = [importance_values(m, width) for m in model.models]
        return [sum(p[i] for p in parts) / len(parts) for i in range(width)]
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray().tolist()
    if hasattr(model, "coefficientMatrix"):
        return abs(model.coefficientMatrix.toArray()).mean(axis=0).tolist()
    if hasattr(model, "coefficients"):
        return abs(model.coefficients.toArray()).tolist()
    if hasattr(model, "models"):
        parts = [importance_values(m, width) for m in model.models]
        return [sum(p[i] for p in parts) / len(parts) for i in range(width)]
    raise TypeError(f"{type(model).__name__} has no importances")


def gaussian_statistics(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Prior, mean and population variance per class and column, as Gaussian naive Bayes learns them."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]
    long = df.select(label, F.inline(F.array(*cells)))
    return long.groupBy(label, "column").agg(F.avg("v").alias("mean"), F.var_pop("v").alias("variance"))


def majority_share(df: DataFrame, label: str) -> float:
    counts = [r["count"] for r in df.groupBy(label).count().collect()]
    return max(counts) / math.fsum(counts)
