"""Recorded numbers."""

import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from lintel.functions.derived import add_derived
from lintel.operators.evaluate import combine_reports
from lintel.sources.listing import listing

REPORTS = [
    (1, 0, 0.8449984980474617, 0.8429727299970033, 0.843984398439844, 3337),
    (1, 1, 0.7195945945945946, 0.7571780147662018, 0.7379080612924717, 3657),
    (1, 2, 0.7691380349608198, 0.7390674775557486, 0.75380298331118, 3453),
    (1, 3, 0.8333803213983648, 0.8428856572569148, 0.8381060391267366, 3507),
    (1, 4, 0.948235974551764, 0.9247038917089678, 0.9363221016561964, 3546),
    (2, 0, 0.8425381903642774, 0.8591971240263631, 0.8507861168792643, 3338),
    (2, 1, 0.7314392924149021, 0.7462400875034181, 0.7387655657823498, 3657),
    (2, 2, 0.7591283863368669, 0.7465971618882131, 0.7528106292889473, 3453),
    (2, 3, 0.8305610374964759, 0.8402738163148887, 0.8353891960867715, 3506),
    (2, 4, 0.9570426651081239, 0.9235758601240834, 0.9400114810562572, 3546),
]


def test_combined_report(spark):
    reports = spark.createDataFrame(REPORTS, "fold int, class int, precision double, recall double, f1 double, support long")
    accuracies = spark.createDataFrame([(1, 0.8210857142857143), (2, 0.8226285714285714)], "fold int, accuracy double")
    got = {r["class"]: r for r in combine_reports(reports, accuracies).collect()}
    zero = got["0"]
    assert (zero.precision, zero.recall, zero.f1, zero.support) == pytest.approx(
        (0.8437681599131591, 0.8510861423220973, 0.8473857671515721, 6675), abs=1e-12
    )
    assert got["weighted avg"].f1 == pytest.approx(0.8222978154072471, abs=1e-12)
    assert got["macro avg"].f1 == pytest.approx(0.8227887979305029, abs=1e-12)
    assert got["accuracy"].f1 == pytest.approx(0.8218571428571428, abs=1e-9)


def test_control_sums(spark):
    names = ["BuildingAge", "IsRenovated", "BuildingLifeStage", "ValueDensity", "RoomDensity", "SeasonalStrength", "SeasonListed", "RenovationNeed"]
    made = add_derived(listing(spark, MEDIUM), names)
    got = made.agg(F.count("BuildingAge").alias("ages"), *[F.sum(c).alias(c) for c in names[1:]]).first()
    assert got.ages == 55853
    assert got.IsRenovated == 46905
    assert got.BuildingLifeStage == 239223
    assert got.ValueDensity == pytest.approx(1113040.254, abs=0.01)
    assert got.RoomDensity == pytest.approx(495.99482, abs=1e-4)
    assert got.SeasonalStrength == pytest.approx(30548.5, abs=1e-6)
    assert got.SeasonListed == 147662
    assert got.RenovationNeed == 127356
