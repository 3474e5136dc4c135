"""Learned models by contract: better than the largest class, probabilities add up, no key lost."""

import pytest
from conftest import SMALL
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lintel.checks.learning import config, forest
from lintel.plans import ensemble, jobs, models
from lintel.sources.listing import LABEL, listing


def test_train_job_reports_both_sets(spark):
    trained = jobs.train_job(listing(spark, SMALL), config(wide=False, group_statistics=False, drop=["BuildingStyle"]), forest())
    got = {r["set"]: r for r in trained.metrics.collect()}
    assert got["train"].accuracy >= got["valid"].accuracy > 0.3
    assert trained.score(listing(spark, SMALL).drop(LABEL)).count() == 6000


def test_train_with_neighbour_imputation(spark, tmp_path):
    rows = listing(spark, SMALL).select("listing_id", LABEL, "PlotSize", "UpperFloorArea", "UnfinishedBasementArea", "RoofType")
    trained = jobs.train_job(rows, config(impute="knn", wide=False, group_statistics=False), forest())
    jobs.save_trained(spark, trained, str(tmp_path / "t"))
    loaded = jobs.load_trained(spark, str(tmp_path / "t"))
    assert jobs.predict_job(loaded, rows.drop(LABEL)).count() == 6000


def test_null_labels_are_refused_and_many_classes_fitted(spark):
    rows = spark.createDataFrame([(float(i % 1500), float(i)) for i in range(1500)] , "label double, x double")
    with pytest.raises(ValueError, match="null labels"):
        models.ridge_classifier().fit(models.assemble(rows.union(spark.sql("SELECT CAST(NULL AS DOUBLE), 1D")), ["x"]))
    from lintel.operators.encode import label_classes

    assert len(label_classes(rows, "label")) == 1500


def test_knn_votes_of_near_rows(spark):
    rows = models.assemble(spark.createDataFrame([(0.0, 0.0), (0.0, 0.1), (1.0, 5.0), (1.0, 5.1), (2.0, 9.0)], "label double, x double"), ["x"])
    for weights in ("uniform", "distance"):
        model = models.knn({"k": 2, "weights": weights}).fit(rows)
        got = {r.x: r for r in model.transform(rows).collect()}
        assert [got[x].prediction for x in (0.0, 0.1, 5.0, 5.1)] == [0.0, 0.0, 1.0, 1.0]
        assert all(abs(sum(r.probability.toArray()) - 1) < 1e-9 for r in got.values())


def test_voting_by_count_and_by_mean(spark):
    class Says:
        def __init__(self, probs):
            self.probs = probs

        def transform(self, df):
            best = float(max(range(len(self.probs)), key=self.probs.__getitem__))
            return df.withColumns({"probability": array_to_vector(F.array(*map(F.lit, self.probs))), "prediction": F.lit(best)})

    base = {"a": Says([0.4, 0.6]), "b": Says([0.45, 0.55]), "c": Says([1.0, 0.0])}
    one = spark.range(1)
    assert ensemble.Voting(base, [0, 1], soft=True).transform(one).first().prediction == 0.0
    assert ensemble.Voting(base, [0, 1], soft=False).transform(one).first().prediction == 1.0
