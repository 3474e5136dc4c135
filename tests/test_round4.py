"""Keys beyond BIGINT, rows that are joined once, and nearest neighbours among all labelled rows."""

import datetime

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lintel.plans import models
from lintel.sources import listing as source
from lintel.sources.listing import KEY

ORDERS = (7, 14_000_000, 54_000_000)


@pytest.fixture
def far(spark, tmp_path):
    """Three small tables whose order numbers go beyond what the listing's key holds as a BIGINT."""
    parts = 12
    lines = [(o + i, p, s, 1 + i % 7, float(q), 100.0 + i, 0.01 * (i % 9)) for o in ORDERS for i in range(20) for p, s, q in [(i % parts, i % 5, 1 + i * 2)]]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double").withColumns(
        {"l_returnflag": F.lit("R"), "l_linestatus": F.lit("O")}
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o + i, datetime.date(1992 + i % 7, 1 + i % 12, 1), 1000.0 + i, f"{i % 5}-X", "FOP"[i % 3]) for o in ORDERS for i in range(20)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate date, o_totalprice double, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        [(p, 900.0 + p, 1 + p, f"B{p % 3}", f"T{p % 4}", f"N{p}") for p in range(parts)],
        "p_partkey long, p_retailprice double, p_size int, p_brand string, p_type string, p_name string",
    ).write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path), lines


def test_keys_beyond_bigint_end_no_job(spark, far):
    """A key is the number that the text has, as long as that fits; beyond, the same number in 64 bits, so that rows keep keys of their own."""
    path, lines = far
    want = [((((o * 100_000 + p) * 10_000 + s) * 10 + n) * 64 + int(q)) for o, p, s, n, q, _, _ in lines]
    assert max(want) >= 1 << 63 and min(want) < 1 << 62
    wrapped = sorted((k + (1 << 63)) % (1 << 64) - (1 << 63) for k in want)
    got = sorted(r[0] for r in source.listing(spark, path, KEY).collect())
    assert got == wrapped and len(set(got)) == len(lines)
    assert source.KEY_TEXT in source.BODY


@pytest.mark.parametrize(("module", "name", "operator"), [
    ("profiles", "P", "iqr_outlier_rate"), ("cleaning", "clean", "fit_outlier_bounds"), ("cleaning", "clean", "fit_impute"),
    ("cleaning", "scale", "fit_robust"), ("cleaning", "encode", "target_encode_oof"),
])
def test_rows_of_several_scans_are_joined_once(spark, monkeypatch, far, module, name, operator):
    """What an operator scans again and again are written columns, not the joins of the sources."""
    import importlib

    at = importlib.import_module(f"lintel.checks.{module}")
    query = {"fit_outlier_bounds": "outlier_nan", "fit_impute": "median_impute", "fit_robust": "robust_scale"}.get(operator, operator)
    seen, original = [], getattr(getattr(at, name), operator)
    monkeypatch.setattr(getattr(at, name), operator, lambda df, *a, **kw: seen.append(df.inputFiles()) or original(df, *a, **kw))
    assert at.entries()[query][0](spark, far[0]).count()
    assert seen and all("/kept-" in f for files in seen for f in files)


def labelled(spark, n: int, seed: int, width: int = 14):
    import numpy as np

    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 1)
    x[n // 2 :] = x[: n - n // 2]  # every vector at least twice
    y = rng.integers(0, 3, n)
    rows = spark.createDataFrame([(i, float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))], "k long, label double, a array<double>")
    return x, y, rows.select("k", "label", array_to_vector("a").alias("features"))


@pytest.mark.parametrize("weights", ["uniform", "distance"])
@pytest.mark.parametrize("local", [True, False])
def test_neighbours_among_all_labelled_rows(spark, monkeypatch, tmp_path, local, weights):
    """More labelled rows than the old bound of 20,000: votes are those of brute force over all of them, sent or searched, before and after saving."""
    import numpy as np

    monkeypatch.setattr(models, "LOCAL_ROWS", (1 << 16) if local else 0)
    x, y, rows = labelled(spark, 24_000, 1)
    q, _, asks = labelled(spark, 300, 2)
    q[:100] = x[23_900:]  # of rows that come last
    asks = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(q)], "k long, a array<double>").select("k", array_to_vector("a").alias("features"))
    k = 4
    model = models.knn({"k": k, "weights": weights}).fit(rows)
    assert model.rows.count() == 24_000
    models.save_model(spark, model, str(tmp_path / "m"))
    got = {r.k: np.array(r.probability.toArray()) for r in models.load_model(spark, str(tmp_path / "m")).transform(asks).collect()}
    assert len(got) == 300
    far = np.zeros((300, 24_000))
    for i in range(x.shape[1]):
        far += (q[:, i][:, None] - x[:, i][None, :]) ** 2
    checked = 0
    for i in range(300):
        order = np.sort(far[i])
        if order[k] - order[k - 1] < 1e-9:
            continue  # a tie at the last place: votes depend on the order of hashes
        near = np.argsort(far[i], kind="stable")[:k]
        gap = np.sqrt(far[i, near])
        w = np.ones(k) if weights == "uniform" else (gap == 0).astype(float) if (gap == 0).any() else 1 / gap
        want = np.bincount(y[near], w, 3) / w.sum()
        assert np.allclose(got[i], want), i
        checked += 1
    assert checked > 100


def test_sent_and_searched_neighbours_are_the_same(spark, monkeypatch):
    """Ties included, repeated and null keys included; columns that are there stay."""
    _, _, rows = labelled(spark, 600, 3, 2)
    asks = rows.withColumn("k", F.when(F.col("k") % 5 > 0, F.col("k") % 7)).withColumn("x", F.lit(1))
    model = models.knn({"k": 5}).fit(rows)
    seen = []
    for most in (1 << 16, 0):
        monkeypatch.setattr(models, "LOCAL_ROWS", most)
        out = model.transform(asks)
        seen.append(sorted(str(r) for r in out.select("k", "x", "label", "features", "probability", "prediction").collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 600
