"""What must not grow on the driver, in a task or on disk: checked on small rows."""

from multiprocessing.pool import ThreadPool
from threading import Barrier

import pytest
from conftest import SMALL
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lintel.checks import labels
from lintel.checks.learning import prepared
from lintel.operators import encode
from lintel.plans import ensemble, jobs, models, persist
from lintel.plans.models import assemble
from lintel.session import keep


def test_wide_one_hot_names_no_slot(spark):
    """The column says its size alone; slots are counted without a vector of all of them."""
    rows = spark.createDataFrame([(f"k{i % 40}",) for i in range(100)] + [(None,)], "c string")
    fitted = encode.fit_one_hot(rows, ["c"], most=10)
    out = fitted.apply(rows.unionByName(spark.createDataFrame([("new",)], "c string")))
    assert out.schema["OneHot__c"].metadata == {"ml_attr": {"num_attrs": 41}}
    assert "__hot_c" not in out.columns
    values = sorted({*(f"k{i}" for i in range(40)), "__MISSING__"})
    sizes = {r.slot: r.n for r in encode.slot_counts(out, "OneHot__c").collect()}
    assert sizes == {i: 1 if v == "__MISSING__" else 3 if int(v[1:]) < 20 else 2 for i, v in enumerate(values)}
    unseen = out.where(F.col("c") == "new").first()["OneHot__c"]
    assert unseen.size == 41 and unseen.numNonzeros() == 0
    assert assemble(out, ["OneHot__c"]).first().features.size == 41


def test_kept_rows_are_columns_of_the_same_rows(spark):
    rows = spark.createDataFrame([(1, "a", 0.1), (1, "a", 0.1), (None, None, None)], "k long, c string, x double")
    kept = keep(rows)
    assert kept.schema == rows.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    assert kept.inputFiles()
    assert keep(rows.limit(0)).count() == 0


def test_rows_are_joined_once(spark):
    """Learners' rows come from written columns: neither train nor valid joins the sources again, and no vector is written."""
    for part in prepared(spark, SMALL):
        files = part.inputFiles()
        assert files and all("/kept-" in f for f in files)


def test_large_tables_are_not_held(spark, monkeypatch):
    """Above the bound learners are fitted one at a time, and neither they nor the jobs keep rows of their own; the models are the same."""
    rows = spark.range(200).select(
        (F.col("id") % 3).cast("double").alias("label"),
        array_to_vector(F.array((F.col("id") % 3).cast("double"), (F.col("id") % 7).cast("double"))).alias("features"),
    )
    build = {n: (lambda n=n: models.BUILDERS[n]({"maxIter": 2})) for n in ("boosted_trees", "svm")}

    def predicted() -> list:
        voting = ensemble.VotingLearner(build).fit(rows)
        return [r.prediction for r in voting.transform(rows).select("prediction").collect()]

    want, seen = predicted(), []
    monkeypatch.setattr(models, "HELD_BYTES", 0)
    monkeypatch.setattr(jobs, "HELD_BYTES", 0)
    monkeypatch.setattr(models, "ThreadPool", lambda n: seen.append(n) or ThreadPool(n))
    monkeypatch.setattr(ensemble, "ThreadPool", lambda n: seen.append(n) or ThreadPool(n))
    monkeypatch.setattr(type(rows), "persist", lambda *a: pytest.fail("a large table was held"))
    assert predicted() == want
    assert set(seen) == {1}
    assert jobs.hold(rows) == []


def test_slim_pipeline_rows_are_joined_once(spark):
    rows, _ = labels.slim_pipeline(spark, SMALL)
    assert rows.inputFiles() and all("/kept-" in f for f in rows.inputFiles())


def test_streamed_batches_take_all_cores(spark, monkeypatch, tmp_path):
    """Three batches as before, each of a file for every core; every row is predicted once."""
    rows = spark.range(2000).select(F.col("id").alias(labels.KEY), F.lit(1).alias(labels.LABEL), (F.col("id") * 2).alias("x"))

    class Model:
        def transform(self, df):
            return df.withColumn("prediction", F.col("x") % 5)

    monkeypatch.setattr(labels, "slim_pipeline", lambda spark, sf: (rows, Model()))
    monkeypatch.setattr(labels, "scratch", lambda spark, name: str(tmp_path / name))
    got = labels.stream_prediction(spark, SMALL)
    assert got.count() == 2000 and got.where("NOT same").count() == 0
    cores = spark.sparkContext.defaultParallelism
    assert len(list((tmp_path / "rows").glob("part-*"))) == 3 * cores
    assert sorted(p.name for p in (tmp_path / "predicted").glob("batch=*")) == ["batch=0", "batch=1", "batch=2"]


class Meets(Estimator):
    """A learner that waits until others are fitted beside it, and tells the files of its rows."""

    def __init__(self, barrier: Barrier, files: list):
        super().__init__()
        self.barrier, self.files = barrier, files

    def _fit(self, df):
        self.barrier.wait()
        self.files += df.inputFiles()
        return models.gaussian_nb().fit(df.withColumn("features", F.transform(vector_to_array("features"), F.abs)).withColumn("features", array_to_vector("features")))


@pytest.mark.parametrize("held", [models.HELD_BYTES, 0])
def test_pipelines_side_by_side_on_written_columns(spark, monkeypatch, held):
    """Few rows: pipelines are fitted side by side, on rows that are joined once; many rows: one at a time. Lines are in the order of the learners."""
    files: list = []
    barrier = Barrier(models.PARALLEL if held else 1, timeout=120)
    names = [f"m{i}" for i in range(models.PARALLEL)]
    monkeypatch.setattr(labels, "LEARNERS", {n: lambda: Meets(barrier, files) for n in names})
    monkeypatch.setattr(labels, "ENSEMBLES", {})
    monkeypatch.setattr(models, "HELD_BYTES", held)
    got = labels.pipelines(spark, SMALL).collect()
    assert [r.model for r in got] == names
    assert {(r.n_rows, r.n_same) for r in got} == {(1198, 1198)}
    assert files and all("/kept-" in f for f in files)


def test_parts_are_written_and_read_side_by_side(spark, tmp_path, monkeypatch):
    """Three parts that wait for each other; the model read back has each of them under its own name."""
    rows = spark.range(60).select((F.col("id") % 3).cast("double").alias("label"), array_to_vector(F.array((F.col("id") % 3).cast("double"))).alias("features"))
    model = models.ridge_classifier().fit(rows)
    barrier, load = Barrier(3, timeout=120), persist.load_stage

    def met(spark, path):
        if "part-" in path:
            barrier.wait()
        return load(spark, path)

    monkeypatch.setattr(persist, "load_stage", met)
    models.save_model(spark, model, str(tmp_path / "m"))
    loaded = load(spark, str(tmp_path / "m"))
    assert [m.coefficients for m in loaded.models] == [m.coefficients for m in model.models]
