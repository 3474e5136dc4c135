"""The feature table against SQL, and learned models by contract (no second engine)."""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lintel.checks.common import KEY, LABEL, WITH, rounded, rs
from lintel.checks.derived_columns import BASE, catalogue
from lintel.checks.profiles import MISSING_SQL, PAIRS
from lintel.checks.tables import RANKED, scratch
from lintel.functions.derived import DERIVED
from lintel.operators import clean, encode, evaluate, ranking, scale
from lintel.operators.state import Fitted
from lintel.plans import ensemble, jobs, models, search
from lintel.plans.features import FREQUENCY, GROUP_VALUES, GROUPS, TARGET, FeatureConfig, fit_features
from lintel.session import cut, keep
from lintel.sources.listing import CLASSES, NUMERIC, listing, numeric_rows, table
from lintel.sources.tables import write_report
from lintel.streaming.scoring import apply_stream

COLUMNS = NUMERIC


def config(**kw) -> FeatureConfig:
    return FeatureConfig(KEY, LABEL, classes=CLASSES, **kw)


def build_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = keep(listing(spark, sf))
    return rounded(fit_features(rows, config()).apply(rows), digits=5)


def features_robust(spark: SparkSession, sf: str) -> DataFrame:
    """Robust scale, no derived or group columns."""
    rows = keep(listing(spark, sf))
    fitted = fit_features(rows, config(model="logistic", wide=False, group_statistics=False))
    return rounded(fitted.apply(rows).select(KEY, LABEL, *NUMERIC), digits=5)


FLAGGED = ["ConstructionYear", "RenovationYear", "GroundFloorArea", "UpperFloorArea", "BasementArea", "FinishedBasementArea1",
           "FinishedBasementArea2", "UnfinishedBasementArea", "PlotSize", "ParkingSpots", "Restrooms", "BasementQuality", "BasementCondition"]

# The categories of the one-hot columns in the test tables.
CATEGORIES = {
    "Proximity1": ["1", "2", "3", "4", "5", "n/a"],
    "Proximity2": ["1", "2", "3", "4", "5", "6", "7", "__MISSING__"],
    "ConferenceRoomQuality": ["", "  ", "F", "O", "P", "__MISSING__"],
}


def filled_sql(columns: list[str]) -> str:
    def one(c: str) -> str:
        value = f'coalesce(CAST("{c}" AS DOUBLE), (SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.5) FROM listing))'
        return f'ln(1 + greatest({value}, 0)) AS "{c}"' if c == "PlotSize" else f'{value} AS "{c}"'

    return f"filled AS (SELECT {KEY}, {', '.join(one(c) for c in columns)} FROM listing)"


def features_sql() -> str:
    exprs = catalogue()
    ks = range(5)
    derived = f"d AS (SELECT {KEY}, {', '.join(f'CAST({e} AS DOUBLE) AS {q(c)}' for c, e in exprs.items())} FROM shared)"
    keyed = list(dict.fromkeys([*FREQUENCY, *TARGET]))
    prior = "prior AS (SELECT " + ", ".join(f"CAST(count(*) FILTER ({LABEL} = {k}) AS DOUBLE) / count(*) AS p{k}" for k in ks) + ", count(*) AS total FROM listing)"
    maps = ", ".join(
        f"m_{c} AS (SELECT coalesce({c}, 'nan') AS v, count(*) AS n, {', '.join(f'count(*) FILTER ({LABEL} = {k}) AS n{k}' for k in ks)} FROM listing GROUP BY 1)"
        for c in keyed
    )
    groups = ", ".join(
        f"g_{g} AS (SELECT {g} AS g, {', '.join(f'avg(d.{v}) AS m_{v}, stddev_samp(d.{v}) AS s_{v}' for v in GROUP_VALUES)} FROM d JOIN listing USING ({KEY}) WHERE {g} IS NOT NULL GROUP BY 1)"
        for g in GROUPS
    )
    rel = {}
    for g in GROUPS:
        for v in GROUP_VALUES:
            rel[f"{v}_ZScore__{g}"] = f"(d.{v} - g_{g}.m_{v}) / (g_{g}.s_{v} + 0.000001e0)"
            rel[f"{v}_RelShift__{g}"] = f"(d.{v} - g_{g}.m_{v}) / (abs(g_{g}.m_{v}) + 0.000001e0)"
    related = f"""rel AS (SELECT {KEY}, {', '.join(f'{e} AS {q(n)}' for n, e in rel.items())} FROM d JOIN listing USING ({KEY})
 {' '.join(f'LEFT JOIN g_{g} ON {g} = g_{g}.g' for g in GROUPS)})"""
    sums = f"stats AS (SELECT {', '.join(f'avg({q(c)}) AS m_{c}, stddev_pop({q(c)}) AS s_{c}' for c in NUMERIC)} FROM filled)"
    mids = f"mids AS (SELECT {', '.join(f'quantile_cont({q(c)}, 0.5) AS {q(c)}' for c in exprs)} FROM d)"
    rel_mids = f"rel_mids AS (SELECT {', '.join(f'quantile_cont({q(c)}, 0.5) AS {q(c)}' for c in rel)} FROM rel)"
    out = [f"l.{KEY}", f"l.{LABEL}"]
    out += [rs(f"(f.{q(c)} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", c, 5) for c in NUMERIC]
    out += [f'CAST(l.{q(c)} IS NULL AS INT) AS "{c}_missing"' for c in FLAGGED]
    out += [f"CAST(coalesce(l.{c}, '__MISSING__') = '{v}' AS INT) AS \"{c}_{v}\"" for c, vs in CATEGORIES.items() for v in vs]
    out += ["""CASE WHEN l.ConferenceRoomQuality IS NULL OR regexp_full_match(l.ConferenceRoomQuality, '\\s*') THEN 1 ELSE 0 END AS "ConferenceRoomQuality_blank\""""]
    out += [rs(f"coalesce(d.{q(c)}, mids.{q(c)})", c, 5) for c in DERIVED]
    out += [rs(f"CAST(m_{c}.n AS DOUBLE) / total", f"FE__{c}", 5) for c in FREQUENCY]
    out += [rs(f"(m_{c}.n{k} + 10.0e0 * p{k}) / (m_{c}.n + 10.0e0)", f"TE__{c}__p{k}", 5) for c in TARGET for k in ks]
    out += [rs(f"coalesce(rel.{q(c)}, rel_mids.{q(c)})", c, 5) for c in rel]
    joins = " ".join(f"LEFT JOIN m_{c} ON coalesce(l.{c}, 'nan') = m_{c}.v" for c in keyed)
    return f"""{BASE}, {derived}, {filled_sql(NUMERIC)}, {sums}, {mids}, {prior}, {maps}, {groups}, {related}, {rel_mids}
 SELECT {', '.join(out)} FROM listing l JOIN filled f USING ({KEY}) JOIN d USING ({KEY}) JOIN rel USING ({KEY}) {joins}
 CROSS JOIN stats CROSS JOIN mids CROSS JOIN prior CROSS JOIN rel_mids"""


def q(name: str) -> str:
    return f'"{name}"'


def robust_sql() -> str:
    stats = ", ".join(
        f"quantile_cont({q(c)}, 0.5) AS m_{c}, quantile_cont({q(c)}, 0.75) - quantile_cont({q(c)}, 0.25) AS s_{c}" for c in NUMERIC
    )
    out = ", ".join(rs(f"(f.{q(c)} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", c, 5) for c in NUMERIC)
    return WITH + f", {filled_sql(NUMERIC)}, stats AS (SELECT {stats} FROM filled) SELECT {KEY}, {LABEL}, {out} FROM filled f JOIN listing USING ({KEY}) CROSS JOIN stats"


def prepared(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Assembled training and validation rows over all numeric columns. The raw rows are written out once, as columns; what is made of them
    is a projection that each scan makes anew, so that no vector is written or held.
    """
    split = ranking.stratified_split(keep(numeric_rows(spark, sf, *COLUMNS)), LABEL, KEY)
    train = split.where("is_valid = 0")
    imputer = clean.fit_impute(train, COLUMNS, "median")
    scaler = scale.fit_standard(imputer.apply(train), COLUMNS)
    ready = models.assemble(scaler.apply(imputer.apply(split)), COLUMNS)
    label = F.col(LABEL).cast("double").alias("label")
    weighted = evaluate.class_weights(ready.select(KEY, label, "features", "is_valid"), "label")
    return weighted.where("is_valid = 0"), weighted.where("is_valid = 1")


def facts(scored: DataFrame, name: str, train: DataFrame, label: str = "label", above: bool = True) -> DataFrame:
    """One line of what must hold whatever the learner finds: no row or key lost, probabilities that add up to 1, labels in
    range, and more rows right than the largest class holds.
    """
    floor = models.majority_share(train, label)
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b)
    hits = F.avg((F.col(label) == F.col("prediction")).cast("double"))
    return scored.agg(
        F.count("*").alias("n_rows"), F.count_distinct(KEY).alias("n_keys"), F.count_if(F.abs(total - 1) < 1e-6).alias("n_sum_one"),
        F.count_if(F.col("prediction").isin([float(c) for c in CLASSES])).alias("n_in_range"),
        (hits > floor).alias("above_majority") if above else F.lit(True).alias("above_majority"),
    ).select(F.lit(name).alias("model"), "*")


def learner(name: str, build, above: bool = True):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        train, valid = prepared(spark, sf)
        return facts(build().fit(train).transform(valid), name, train, above=above)

    return query


VALID = RANKED + ", valid AS (SELECT * FROM ranked WHERE k <= floor(n * CAST(0.2 AS DOUBLE))), train AS (SELECT * FROM ranked WHERE k > floor(n * CAST(0.2 AS DOUBLE)))"


def facts_sql(name: str, rows: str = "valid") -> str:
    counts = ", ".join(f"count(*) AS {c}" for c in ("n_rows", "n_keys", "n_sum_one", "n_in_range"))
    return f"{VALID} SELECT '{name}' AS model, {counts}, true AS above_majority FROM {rows}"


def boosted(spark: SparkSession, sf: str) -> DataFrame:
    """Early stopping on the validation rows."""
    train, valid = prepared(spark, sf)
    both = train.unionByName(valid).withColumn("held", F.col("is_valid") == 1)
    model = models.boosted_trees({"maxIter": 8, "maxDepth": 4, "validationTol": 0.01}, weight="weight", validation="held").fit(both)
    return facts(model.transform(valid), "boosted_trees", train)


BASE_LEARNERS = {
    "forest": lambda: models.random_forest({"numTrees": 10, "maxDepth": 6}),
    "bayes": lambda: models.gaussian_nb(),
    "logistic": lambda: models.logistic({"maxIter": 20}),
    "svm": lambda: models.linear_svm({"maxIter": 5}),
}


def stacked(spark: SparkSession, sf: str) -> tuple[ensemble.Stack, DataFrame, DataFrame]:
    train, valid = prepared(spark, sf)
    return ensemble.StackLearner(BASE_LEARNERS, KEY).fit(train), train, valid


def stack(spark: SparkSession, sf: str) -> DataFrame:
    model, train, valid = stacked(spark, sf)
    return facts(model.transform(valid), "stack", train)


def stack_importance(spark: SparkSession, sf: str) -> DataFrame:
    """A line per base model, none negative."""
    model, train, _ = stacked(spark, sf)
    return model.importance(train).select("model", (F.col("importance") >= 0).alias("not_negative"))


def voting(soft: bool):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        train, valid = prepared(spark, sf)
        model = ensemble.VotingLearner(BASE_LEARNERS, soft=soft).fit(train)
        return facts(model.transform(valid), "voting_soft" if soft else "voting_hard", train)

    return query


def out_of_fold(spark: SparkSession, sf: str) -> DataFrame:
    """One row per key, none lost, probabilities adding up to one."""
    train, _ = prepared(spark, sf)
    folded = cut(ranking.stratified_folds(train, "label", KEY, 3))
    scored = ensemble.out_of_fold(folded, "fold", {"bayes": lambda: models.gaussian_nb()})
    total = F.aggregate("__pr_bayes", F.lit(0.0), lambda a, b: a + b)
    return scored.agg(
        F.count("*").alias("n_rows"), F.count_distinct(KEY).alias("n_keys"),
        F.count_if(F.abs(total - 1) < 1e-6).alias("n_sum_one"),
    )


def forest(**p):
    return lambda: models.random_forest({"numTrees": 10, "maxDepth": 6, **p}, LABEL, "weight")


def train_job(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of both sets over the whole feature table, as facts: in range, and above the largest class."""
    rows = keep(listing(spark, sf))
    floor = models.majority_share(rows, LABEL)
    got = jobs.train_job(rows, config(), forest()).metrics
    inside = reduce(lambda a, b: a & b, [F.col(m).between(0, 1) for m in ("accuracy", "precision", "recall", "f1")])
    return got.select("set", inside.alias("in_range"), (F.col("accuracy") > floor).alias("above_majority"))


def cv_job(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the combined report with their support: every row is validated once."""
    done = jobs.cv_job(keep(listing(spark, sf)), config(), forest(numTrees=5), k=3)
    ordered = done.summary.where("NOT (min <= mean AND mean <= max)").count() == 0 and done.folds.count() == 3
    return done.report.select("class", F.col("support").cast("bigint").alias("support"), F.lit(ordered).alias("ordered"))


CV_SQL = WITH + f""" SELECT CAST({LABEL} AS VARCHAR) AS class, count(*) AS support, true AS ordered FROM listing GROUP BY 1
 UNION ALL SELECT UNNEST(['macro avg', 'weighted avg']), count(*), true FROM listing UNION ALL SELECT 'accuracy', NULL, true"""


def predict_job(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the whole feature table, save, load, and score all rows with what was loaded."""
    rows = keep(listing(spark, sf))
    trained = jobs.train_job(rows, config(), forest())
    path = scratch(spark, "trained")
    jobs.save_trained(spark, trained, path)
    out = jobs.predict_job(jobs.load_trained(spark, path), rows.drop(LABEL), proba=True)
    total = F.aggregate("probs", F.lit(0.0), lambda a, b: a + b)
    return out.select(KEY, "Id", F.col(LABEL).isin(CLASSES).alias("in_range"), (F.abs(total - 1) < 1e-6).alias("sum_one"))


PREDICT_SQL = WITH + f" SELECT {KEY}, row_number() OVER (ORDER BY {KEY}) - 1 AS Id, true AS in_range, true AS sum_one FROM listing"

SAVED = {
    "random_forest": lambda: models.random_forest({"numTrees": 5, "maxDepth": 4}),
    "boosted_trees": lambda: models.boosted_trees({"maxIter": 2, "maxDepth": 3}),
    "svm": lambda: models.linear_svm({"maxIter": 3}),
    "ridge": lambda: models.ridge_classifier(),
    "knn": lambda: models.knn(),
    "stack": lambda: ensemble.StackLearner({n: SAVED[n] for n in ("ridge", "knn")}, KEY, folds=2),
    "vote": lambda: ensemble.VotingLearner({n: SAVED[n] for n in ("random_forest", "ridge")}),
}


def saved_learners(spark: SparkSession, sf: str) -> DataFrame:
    """Every kind of learner fitted, saved, loaded by its manifest, and scoring the validation rows as before saving."""
    train, valid = prepared(spark, sf)
    lines = []
    for name, build in SAVED.items():
        model, path = build().fit(train), scratch(spark, f"model-{name}")
        models.save_model(spark, model, path)
        now = models.load_model(spark, path).transform(valid).select(KEY, F.col("prediction").alias("now"))
        both = model.transform(valid).select(KEY, "prediction").join(now, KEY)
        lines.append(both.agg(F.lit(name).alias("model"), F.count("*").alias("n_rows"), F.count_if(F.col("prediction") == F.col("now")).alias("n_same")))
    return reduce(DataFrame.unionByName, lines)


def tuned(spark: SparkSession, sf: str) -> DataFrame:
    """Four drawn candidates on five folds of the whole feature table; trials by falling accuracy."""
    folds = jobs.fold_tables(keep(listing(spark, sf)), config(), 5)
    space = {"numTrees": (3, 6), "maxDepth": [3, 5]}
    best, trials = search.param_search(spark, folds, lambda p: models.random_forest(p, LABEL), search.draw(space, 4), LABEL)
    top = F.first("params").over(W.partitionBy(F.lit(0)).orderBy(F.desc("mean_accuracy"), "trial"))
    return trials.select(
        "trial", F.col("mean_accuracy").between(0, 1).alias("in_range"), (top == json.dumps(best, sort_keys=True)).alias("best_first")
    )


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """A pool of kinds with drawn parameters, all built by the same call, each fitted and scored on the validation rows."""
    train, valid = prepared(spark, sf)
    spaces = {
        "logistic": ({"maxIter": (5, 10)}, 1), "random_forest": ({"numTrees": (3, 6)}, 1), "boosted_trees": ({"maxIter": (2, 3)}, 1),
        "naive_bayes": ({}, 1), "svm": ({"maxIter": (3, 5)}, 1), "ridge": ({}, 1), "mlp": ({"maxIter": (20, 30)}, 1), "knn": ({"k": (3, 7)}, 1),
    }
    lines = []
    for kind, params in search.model_pool(spaces, len(spaces)):
        weight = None if kind in ("mlp", "knn") else "weight"
        model = models.BUILDERS[kind](params, "label", weight).fit(train)
        lines.append(facts(model.transform(valid), kind, train, above=False))
    return reduce(DataFrame.unionByName, lines)


def importance(spark: SparkSession, sf: str) -> DataFrame:
    """A line per column; gains are shares, so they add up to 1."""
    train, _ = prepared(spark, sf)
    got = models.feature_importance(models.random_forest({"numTrees": 10, "maxDepth": 6}).fit(train), COLUMNS, train)
    total = F.sum("importance").over(W.partitionBy(F.lit(0)))  # one line per column
    return got.select("feature", (F.col("importance") >= 0).alias("not_negative"), (F.abs(total - 1) < 1e-6).alias("sum_one"))


def plain_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = keep(numeric_rows(spark, sf))
    return clean.fit_impute(rows, COLUMNS, "median").apply(rows)


DRIFTING = [c for c in NUMERIC if c != "YearListed"]


def adversarial(spark: SparkSession, sf: str) -> DataFrame:
    """The parts are cut by year, which is left out: the AUC is a share, and its level is the one of its range."""
    rows = plain_rows(spark, sf)
    got = jobs.adversarial_validation(rows.where("YearListed < 1997"), rows.where("YearListed >= 1997"), KEY, DRIFTING)[0]
    level = F.when(F.col("auc") < 0.55, "none").when(F.col("auc") < 0.65, "mild").when(F.col("auc") < 0.75, "moderate").otherwise("high")
    return got.select(F.col("auc").between(0, 1).alias("in_range"), (F.col("drift") == level).alias("level_fits"))


def drift_weights(spark: SparkSession, sf: str) -> DataFrame:
    rows = plain_rows(spark, sf)
    train = rows.where("YearListed < 1997")
    _, model = jobs.adversarial_validation(train, rows.where("YearListed >= 1997"), KEY, DRIFTING)
    return jobs.drift_weights(train, model, DRIFTING).select(KEY, F.col("drift_weight").between(0, 1).alias("in_range"))


def rfe(spark: SparkSession, sf: str) -> DataFrame:
    """How many of all columns are left, all different and known."""
    rows = plain_rows(spark, sf).withColumn(LABEL, F.col(LABEL).cast("double"))
    left = jobs.rfe(rows, COLUMNS, LABEL, 5, 0.3, {"numTrees": 5, "maxDepth": 4})
    table_ = spark.createDataFrame([(c,) for c in left], "feature string")
    return table_.agg(F.count("*").alias("n"), F.count_distinct("feature").alias("n_distinct"), F.bool_and(F.col("feature").isin(COLUMNS)).alias("known"))


def audit(spark: SparkSession, sf: str) -> DataFrame:
    """All numeric columns of the whole feature table through every report, five permutations each: a line per feature, column, pair or set, and
    whether its values are such as they must be. Which pairs correlate is a result that SQL states as well.
    """
    rows = keep(listing(spark, sf))
    split = ranking.stratified_split(rows, LABEL, KEY)
    trained = jobs.train_job(rows, config(), forest())
    reports = jobs.audit_job(trained, split.where("is_valid = 0"), split.where("is_valid = 1"), NUMERIC, 5, 0.6)
    level = F.when(F.col("auc") < 0.55, "none").when(F.col("auc") < 0.65, "mild").when(F.col("auc") < 0.75, "moderate").otherwise("high")
    told = {
        "feature_importance": (F.col("feature"), F.col("importance").between(0, 1)),
        "permutation_importance": (F.col("feature"), F.col("importance_mean").between(-1, 1) & (F.col("importance_std") >= 0)),
        "adversarial_validation": (F.lit("auc"), F.col("auc").between(0, 1) & (F.col("drift") == level)),
        "high_correlations": (F.concat_ws(" ~ ", "feature1", "feature2"), F.abs("correlation").between(0.6, 1)),
    }
    lines = [reports[name].select(F.lit(name).alias("report"), line.alias("line"), holds.alias("holds")) for name, (line, holds) in told.items()]
    out = reduce(DataFrame.union, lines)
    return out.where((F.col("report") != "feature_importance") | F.col("line").isin(NUMERIC))


def audit_sql() -> str:
    def filled(c: str) -> str:
        value = f'coalesce(CAST("{c}" AS DOUBLE), (SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.5) FROM fitted))'
        return f'ln(1 + greatest({value}, 0)) AS "{c}"' if c == "PlotSize" else f'{value} AS "{c}"'

    pairs = ", ".join(f"{{'line': '{a} ~ {b}', 'c': corr(\"{a}\", \"{b}\")}}" for a, b in PAIRS)
    names = " UNION ALL ".join(f"SELECT '{r}' AS report, UNNEST({NUMERIC}) AS line, true AS holds" for r in ("feature_importance", "permutation_importance"))
    return f"""{VALID}, fitted AS (SELECT * FROM listing WHERE {KEY} IN (SELECT {KEY} FROM train)),
 filled AS (SELECT {", ".join(map(filled, NUMERIC))} FROM fitted), pairs AS (SELECT UNNEST([{pairs}], recursive := true) FROM filled)
 {names} UNION ALL SELECT 'adversarial_validation', 'auc', true UNION ALL SELECT 'high_correlations', line, true FROM pairs WHERE abs(c) > 0.6e0"""


def evaluate_job(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of both sets of a fitted learner, as facts."""
    train, valid = prepared(spark, sf)
    model = models.gaussian_nb().fit(train)
    sets = {"train": model.transform(train), "valid": model.transform(valid)}
    got = evaluate.evaluate_sets(sets, "label", "prediction", CLASSES)
    return got.select("set", *[F.col(m).between(0, 1).alias(m) for m in ("accuracy", "precision", "recall", "f1")])


def saved_state(spark: SparkSession, sf: str) -> DataFrame:
    """An encoding applied after saving and loading its state."""
    rows = listing(spark, sf, KEY, "RoofType", "HeatingType")
    path = scratch(spark, "state")
    encode.fit_frequency(rows, ["RoofType", "HeatingType"]).save(spark, path)
    return rounded(Fitted.load(spark, path).apply(rows).select(KEY, "FE__RoofType", "FE__HeatingType"))


SHARES = ", ".join(rs(f"CAST(count(*) OVER (PARTITION BY {c}) AS DOUBLE) / count(*) OVER ()", f"FE__{c}") for c in ("RoofType", "HeatingType"))


def report(spark: SparkSession, sf: str) -> DataFrame:
    from lintel.operators.profile import missing_profile

    path = scratch(spark, "report")
    write_report(missing_profile(listing(spark, sf)), path)
    return rounded(spark.read.schema("column STRING, n_missing BIGINT, pct_missing DOUBLE").json(path))


def streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Frequency encoding of the event stream, equal to the batch result."""
    events = table(spark, sf, "events")
    fitted = encode.fit_frequency(events, ["event_type"])
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(os.path.abspath(sf))
    out, marks = scratch(spark, "stream"), scratch(spark, "marks")
    query = apply_stream(stream.select("event_id", "event_type"), fitted, out, marks)
    query.awaitTermination()
    return rounded(spark.read.parquet(out).select("event_id", "FE__event_type"))


def probabilities_sum(spark: SparkSession, sf: str) -> DataFrame:
    train, valid = prepared(spark, sf)
    scored = models.ridge_classifier().fit(train).transform(valid).withColumn("p", vector_to_array("probability"))
    total = F.aggregate("p", F.lit(0.0), lambda a, b: a + b)
    return scored.agg(F.count("*").alias("n_rows"), F.count_if(F.abs(total - 1) < 1e-9).alias("n_sum_one"))


def entries() -> dict:
    w = "weight"
    base = ", ".join(f"'{n}'" for n in BASE_LEARNERS)
    kinds = ["logistic", "random_forest", "boosted_trees", "naive_bayes", "svm", "ridge", "mlp", "knn"]
    pooled = " UNION ALL ".join(facts_sql(k).replace(VALID, "") for k in kinds)
    learners = {
        "logistic": lambda: models.logistic(weight=w),
        "random_forest": lambda: models.random_forest({"numTrees": 20, "maxDepth": 8}, weight=w),
        "gaussian_nb": lambda: models.gaussian_nb(weight=w),
        "linear_svm": lambda: models.linear_svm({"maxIter": 10}, weight=w),
        "ridge_classifier": lambda: models.ridge_classifier(weight=w),
        "mlp": lambda: models.mlp({"maxIter": 30}),
        "knn_learner": lambda: models.knn(),
    }
    return {
        "build_features": (build_features, features_sql()),
        "build_features_robust": (features_robust, robust_sql()),
        **{name: (learner(name, build), facts_sql(name)) for name, build in learners.items()},
        "boosted_trees": (boosted, facts_sql("boosted_trees")),
        "ridge_probabilities": (probabilities_sum, f"{VALID} SELECT count(*) AS n_rows, count(*) AS n_sum_one FROM valid"),
        "stack": (stack, facts_sql("stack")),
        "stack_importance": (stack_importance, f"SELECT UNNEST([{base}]) AS model, true AS not_negative"),
        "voting_soft": (voting(True), facts_sql("voting_soft")),
        "voting_hard": (voting(False), facts_sql("voting_hard")),
        "out_of_fold": (out_of_fold, f"{VALID} SELECT count(*) AS n_rows, count(*) AS n_keys, count(*) AS n_sum_one FROM train"),
        "model_pool": (pool, f"{VALID} {pooled}"),
        "param_search": (tuned, "SELECT CAST(UNNEST(range(4)) AS INT) AS trial, true AS in_range, true AS best_first"),
        "train_job": (train_job, "SELECT UNNEST(['train', 'valid']) AS set, true AS in_range, true AS above_majority"),
        "cv_job": (cv_job, CV_SQL),
        "predict_job": (predict_job, PREDICT_SQL),
        "saved_learners": (saved_learners, f"{VALID} SELECT UNNEST({list(SAVED)}) AS model, count(*) AS n_rows, count(*) AS n_same FROM valid"),
        "feature_importance": (importance, f"SELECT UNNEST({NUMERIC}) AS feature, true AS not_negative, true AS sum_one"),
        "adversarial_validation": (adversarial, "SELECT true AS in_range, true AS level_fits"),
        "drift_weights": (drift_weights, f"{WITH} SELECT {KEY}, true AS in_range FROM listing WHERE YearListed < 1997"),
        "rfe": (rfe, "SELECT 5 AS n, 5 AS n_distinct, true AS known"),
        "audit_job": (audit, audit_sql()),
        "evaluate_job": (evaluate_job, "SELECT UNNEST(['train', 'valid']) AS set, true AS accuracy, true AS precision, true AS recall, true AS f1"),
        "save_load_fitted": (saved_state, WITH + f" SELECT {KEY}, {SHARES} FROM listing"),
        "write_report": (report, MISSING_SQL),
        "stream_scoring": (streamed, f"SELECT event_id, {rs('CAST(count(*) OVER (PARTITION BY event_type) AS DOUBLE) / count(*) OVER ()', 'FE__event_type')} FROM events"),
    }
