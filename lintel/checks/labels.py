"""Learners and ensembles on labels with gaps and on text labels, and pipelines that are saved, loaded and streamed."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.checks.common import KEY, LABEL, WITH
from lintel.checks.learning import VALID, config, prepared
from lintel.checks.tables import scratch
from lintel.operators import ranking
from lintel.plans import ensemble, models
from lintel.plans.features import fit_features
from lintel.plans.labels import Labelled
from lintel.plans.persist import load_stage, save_stage
from lintel.plans.steps import FeatureTable, RowFunction
from lintel.session import cut, keep
from lintel.sources.listing import NUMERIC, listing, numeric_rows
from lintel.streaming.scoring import predict_stream

GAPS = [1.0, 3.0, 7.0]
TEXTS = ["high", "low", "mid"]

LEARNERS = {
    "boosted_trees": lambda: models.boosted_trees({"maxIter": 3, "maxDepth": 3}),
    "svm": lambda: models.linear_svm({"maxIter": 5}),
    "ridge": lambda: models.ridge_classifier(),
    "knn": lambda: models.knn(),
    "random_forest": lambda: Labelled(lambda: models.random_forest({"numTrees": 5, "maxDepth": 5})),
    "naive_bayes": lambda: Labelled(models.gaussian_nb),
    "logistic": lambda: Labelled(lambda: models.logistic({"maxIter": 10})),
    "mlp": lambda: Labelled(lambda: models.mlp({"maxIter": 20})),
}
BASE = {
    "forest": lambda: models.random_forest({"numTrees": 5, "maxDepth": 5}),
    "ridge": lambda: models.ridge_classifier(),
    "knn": lambda: models.knn(),
}
ENSEMBLES = {
    "voting_soft": lambda: ensemble.VotingLearner(BASE),
    "voting_hard": lambda: ensemble.VotingLearner(BASE, soft=False),
    "stack": lambda: ensemble.StackLearner(BASE, KEY, folds=2),
}


def relabelled(rows: DataFrame, labels: list) -> DataFrame:
    return rows.withColumn("label", F.element_at(F.array(*map(F.lit, labels)), (F.col("label") % len(labels) + 1).cast("int")))


def held_facts(spark: SparkSession, sf: str, learners: dict, labels: list) -> DataFrame:
    """A line for each learner, fitted, saved and loaded: rows and keys complete, one share a class, shares that add up to 1, predictions that
    are labels and are those of the largest share, and the same predictions before saving and after loading.
    """
    train, valid = (cut(relabelled(t, labels)) for t in prepared(spark, sf))
    lines = []
    for name, build in learners.items():
        model, path = build().fit(train), scratch(spark, f"labels-{name}")
        save_stage(model, path)
        loaded = load_stage(spark, path)
        now = loaded.transform(valid).select(KEY, "prediction", vector_to_array("probability").alias("p"))
        both = now.join(model.transform(valid).select(KEY, F.col("prediction").alias("before")), KEY)
        best = F.element_at(F.array(*map(F.lit, labels)), F.array_position("p", F.array_max("p")).cast("int"))
        total = F.aggregate("p", F.lit(0.0), lambda a, b: a + b)
        lines.append(both.agg(
            F.lit(name).alias("model"), F.count("*").alias("n_rows"), F.count_distinct(KEY).alias("n_keys"),
            F.count_if(F.size("p") == len(labels)).alias("n_shares"), F.count_if(F.abs(total - 1) < 1e-6).alias("n_sum_one"),
            F.count_if(F.col("prediction").isin(labels)).alias("n_in_range"), F.count_if(F.col("prediction") == best).alias("n_best"),
            F.count_if(F.col("prediction") == F.col("before")).alias("n_same"),
        ))
    return reduce(DataFrame.unionByName, lines)


def held_sql(learners: dict) -> str:
    counts = ", ".join(f"count(*) AS {c}" for c in ("n_rows", "n_keys", "n_shares", "n_sum_one", "n_in_range", "n_best", "n_same"))
    return f"{VALID} SELECT UNNEST({list(learners)}) AS model, {counts} FROM valid"


def labels_query(learners: dict, labels: list):
    return lambda spark, sf: held_facts(spark, sf, learners, labels)


def pipelines(spark: SparkSession, sf: str) -> DataFrame:
    """One pipeline a kind of learner, from raw numeric rows to predictions: a function step, an assembler, the learner; fitted on the training
    rows, saved, loaded and scored on the others as before saving. The rows are joined once and marked once, written as columns. A pipeline is many
    short jobs, so that several are fitted side by side while the rows are few.
    """
    rows = keep(numeric_rows(spark, sf, *NUMERIC).withColumn("label", F.col(LABEL).cast("double")))
    split = keep(ranking.stratified_split(rows, LABEL, KEY))
    train, valid = split.where("is_valid = 0"), split.where("is_valid = 1")
    learners = {**LEARNERS, **ENSEMBLES}

    def line(name: str) -> DataFrame:
        stages = [RowFunction("fill", columns=NUMERIC, value=0.0), VectorAssembler(inputCols=NUMERIC, outputCol="features"), learners[name]()]
        fitted, path = Pipeline(stages=stages).fit(train), scratch(spark, f"pipeline-{name}")
        fitted.write().overwrite().save(path)
        now = PipelineModel.load(path).transform(valid).select(KEY, F.col("prediction").alias("now"))
        both = fitted.transform(valid).select(KEY, "prediction").join(now, KEY)
        return both.agg(F.lit(name).alias("model"), F.count("*").alias("n_rows"), F.count_if(F.col("prediction") == F.col("now")).alias("n_same"))

    small = train.count() * 8 * len(NUMERIC) <= models.HELD_BYTES
    with ThreadPool(models.PARALLEL if small else 1) as pool:
        # ensembles, which take longest, first
        lines = dict(zip(reversed(learners), pool.map(line, reversed(learners), 1), strict=True))
    return reduce(DataFrame.unionByName, [lines[name] for name in learners])


PIPELINES_SQL = f"{VALID} SELECT UNNEST({[*LEARNERS, *ENSEMBLES]}) AS model, count(*) AS n_rows, count(*) AS n_same FROM valid"


def slim_pipeline(spark: SparkSession, sf: str):
    """The feature table (without derived columns) and a forest as one pipeline, saved and loaded. The rows are joined once, and written as columns."""
    rows = keep(listing(spark, sf))
    stages = [FeatureTable(config(wide=False, group_statistics=False)), Labelled(lambda: models.random_forest({"numTrees": 5, "maxDepth": 5}, LABEL), LABEL)]
    path = scratch(spark, "feature-pipeline")
    Pipeline(stages=stages).fit(rows).write().overwrite().save(path)
    return rows, PipelineModel.load(path)


def function_step(spark: SparkSession, sf: str) -> DataFrame:
    """A registered function as a step: fitted into a pipeline, saved, loaded by its name, and applied."""
    path = scratch(spark, "step")
    Pipeline(stages=[RowFunction("fill", columns=NUMERIC, value=-1.0)]).fit(listing(spark, sf)).write().overwrite().save(path)
    return PipelineModel.load(path).transform(listing(spark, sf)).select(KEY, *NUMERIC)


STEP_SQL = WITH + f" SELECT {KEY}, " + ", ".join(f'coalesce(CAST("{c}" AS DOUBLE), -1.0e0) AS "{c}"' for c in NUMERIC) + " FROM listing"


def stream_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """All rows streamed in several batches through a loaded pipeline: each once, and predicted as the whole table is."""
    rows, model = slim_pipeline(spark, sf)
    source, out, marks = scratch(spark, "rows"), scratch(spark, "predicted"), scratch(spark, "marks")
    plain = rows.drop(LABEL)
    # a file for each core in each of three batches
    files = spark.sparkContext.defaultParallelism
    plain.repartition(3 * files, KEY).write.parquet(source)
    stream = spark.readStream.schema(plain.schema).option("maxFilesPerTrigger", files).parquet(source)
    predict_stream(stream, lambda batch: model.transform(batch).select(KEY, "prediction"), out, marks).awaitTermination()
    streamed = spark.read.parquet(out).select(KEY, F.col("prediction").alias("now"))
    whole = model.transform(plain).select(KEY, "prediction")
    return whole.join(streamed, KEY, "full").select(KEY, F.coalesce(F.col("prediction") == F.col("now"), F.lit(False)).alias("same"))


def rows_of_features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table fitted and applied by a pipeline that was saved equals the one fitted here: largest difference of a slot."""
    rows, model = slim_pipeline(spark, sf)
    fitted = fit_features(rows, config(wide=False, group_statistics=False))
    here = models.assemble(fitted.apply(rows), fitted.names).select(KEY, vector_to_array("features").alias("a"))
    there = model.stages[0].transform(rows).select(KEY, vector_to_array("features").alias("b"))
    gap = F.array_max(F.zip_with("a", "b", lambda x, y: F.abs(x - y)))
    return here.join(there, KEY).select(KEY, (gap < 1e-9).alias("same"))


def entries() -> dict:
    same = f"{WITH} SELECT {KEY}, true AS same FROM listing"
    return {
        "voting_labels": (labels_query({n: ENSEMBLES[n] for n in ("voting_soft", "voting_hard")}, GAPS), held_sql({"voting_soft": 0, "voting_hard": 0})),
        "stack_labels": (labels_query({"stack": ENSEMBLES["stack"]}, GAPS), held_sql({"stack": 0})),
        "learner_labels": (labels_query(LEARNERS, GAPS), held_sql(LEARNERS)),
        "text_labels": (labels_query({**{n: LEARNERS[n] for n in ("ridge", "knn", "random_forest")}, **ENSEMBLES}, TEXTS), held_sql({"ridge": 0, "knn": 0, "random_forest": 0, **ENSEMBLES})),
        "pipelines_saved": (pipelines, PIPELINES_SQL),
        "pipeline_features": (rows_of_features, same),
        "function_step": (function_step, STEP_SQL),
        "stream_prediction": (stream_prediction, same),
    }
