"""Weights, evaluation and votes of fixed rule predictors against SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.checks.common import KEY, LABEL, WITH, rounded, rs
from lintel.checks.tables import RANKED
from lintel.operators import evaluate as E
from lintel.operators import ranking
from lintel.plans import ensemble
from lintel.plans.models import softmax
from lintel.session import cut
from lintel.sources.listing import CLASSES, listing, table

# Three rule predictors, in both engines.
RULES = {
    "a": "CAST(floor(least(coalesce(UnfinishedBasementArea, 0) / 3, 49) / 10) AS INT)",
    "b": "CAST(floor(least(coalesce(UpperFloorArea, 0) / 10, 49) / 10) AS INT)",
    "c": "CAST(BuildingGrade % 5 AS INT)",
}


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf)
    return rows.select(KEY, LABEL, "YearListed", *[F.expr(e).alias(f"pred_{n}") for n, e in RULES.items()]).withColumn(
        "prediction", F.col("pred_a")
    )


RULED = WITH + f", pred AS (SELECT {KEY}, {LABEL}, YearListed, {', '.join(f'{e} AS pred_{n}' for n, e in RULES.items())}, {RULES['a']} AS prediction FROM listing)"


def grid_sql(by: str = "", source: str = "pred") -> str:
    """Confusion counts, absent pairs as 0; the classes are the five and all that are seen on either side."""
    keys = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM {source}) g CROSS JOIN " if by else ""
    match = f" AND g.{by} = m.{by}" if by else ""
    pick = f"g.{by}, " if by else ""
    return f"""seen AS (SELECT UNNEST(range(5)) AS c UNION SELECT {LABEL} FROM {source} WHERE {LABEL} IS NOT NULL UNION SELECT prediction FROM {source} WHERE prediction IS NOT NULL),
 matrix AS (SELECT {pick}CAST(x.c AS INT) AS actual, CAST(y.c AS INT) AS predicted, coalesce(m.n, 0) AS n
 FROM {groups}seen x CROSS JOIN seen y
 LEFT JOIN (SELECT {keys}{LABEL} AS ya, prediction AS yp, count(*) AS n FROM {source} GROUP BY ALL) m ON ya = x.c AND yp = y.c{match}
 UNION ALL SELECT {keys}{LABEL}, prediction, count(*) FROM {source} WHERE {LABEL} IS NULL OR prediction IS NULL GROUP BY ALL)"""


def classes_sql(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    same = f" AND t.{by} = o.{by}" if by else ""
    return f"""sums AS (SELECT {keys}actual AS class, sum(n) AS support, coalesce(sum(n) FILTER (actual = predicted), 0) AS hit FROM matrix WHERE actual IS NOT NULL GROUP BY ALL),
 called AS (SELECT {keys}predicted AS c, sum(n) AS called FROM matrix WHERE actual IS NOT NULL GROUP BY ALL),
 per AS (SELECT {f't.{by}, ' if by else ''}class, CASE WHEN called > 0 THEN CAST(hit AS DOUBLE) / called ELSE 0 END AS precision,
 CASE WHEN support > 0 THEN CAST(hit AS DOUBLE) / support ELSE 0 END AS recall,
 CASE WHEN called + support > 0 THEN 2.0e0 * hit / (called + support) ELSE 0 END AS f1, CAST(support AS BIGINT) AS support, hit
 FROM sums t JOIN called o ON class = c{same})"""


MEASURES = ("precision", "recall", "f1")


def metrics_select(by: str = "", average: str = "weighted") -> str:
    keys = f"{by}, " if by else ""
    each = ", ".join(
        rs(f"sum({m} * support) / sum(support)" if average == "weighted" else f"avg({m})", m) for m in MEASURES
    )
    return f"SELECT {keys}{rs('CAST(sum(hit) AS DOUBLE) / sum(support)', 'accuracy')}, {each} FROM per" + (f" GROUP BY {by}" if by else "")


def folded(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.stratified_folds(predicted(spark, sf), LABEL, KEY, 5, 42)


FOLDED = RANKED + f""", pred AS (SELECT {KEY}, {LABEL}, CAST((k - 1) % 5 AS INT) AS fold, {RULES['a']} AS prediction
 FROM ranked JOIN listing USING ({KEY}, {LABEL}))"""


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return E.confusion_matrix(predicted(spark, sf), LABEL, "prediction", CLASSES)


# A predictor that names a class that no row has, and no class at all for some rows.
UNSEEN = f"CASE WHEN BuildingGrade = 7 THEN 9 WHEN BuildingGrade <> 3 THEN {RULES['a']} END"
UNSEEN_SQL = RULED.replace(f"{RULES['a']} AS prediction", f"{UNSEEN} AS prediction")


def unseen(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf).select(KEY, LABEL, F.expr(UNSEEN).alias("prediction"))
    return E.confusion_matrix(rows, LABEL, "prediction")


def metrics(average: str):
    return lambda s, d: rounded(E.classification_metrics(confusion(s, d), average=average))


def by_fold(spark: SparkSession, sf: str) -> DataFrame:
    return E.confusion_matrix(folded(spark, sf), LABEL, "prediction", CLASSES, ["fold"])


def fold_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = E.metric_rows(E.classification_metrics(by_fold(spark, sf), ["fold"]), ["fold"])
    return rounded(E.aggregate_folds(rows))


def combined(spark: SparkSession, sf: str) -> DataFrame:
    matrix = cut(by_fold(spark, sf))  # folds x classes x classes
    reports = E.class_report(matrix, ["fold"])
    accuracies = E.classification_metrics(matrix, ["fold"]).select("fold", "accuracy")
    return rounded(E.combine_reports(reports, accuracies))


def sets(spark: SparkSession, sf: str) -> DataFrame:
    rows = predicted(spark, sf)
    parts = {"train": rows.where("YearListed < 1997"), "valid": rows.where("YearListed >= 1997")}
    return rounded(E.evaluate_sets(parts, LABEL, "prediction", CLASSES))


def weights(power: float):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(E.class_weights(listing(spark, sf, KEY, LABEL), LABEL, power))

    return query


def weights_sql(power: str, key: str = KEY, label: str = LABEL, source: str = "listing", head: str = WITH + ",") -> str:
    return f"""{head} c AS (SELECT {label} AS y, pow((SELECT count(*) FROM {source}) / CAST(count(*) AS DOUBLE), {power}) AS w, count(*) AS n FROM {source} GROUP BY 1)
 SELECT {key}, {label}, {rs("w / (SELECT sum(w * n) / sum(n) FROM c)", "weight")} FROM {source} JOIN c ON {label} = y"""


def toxic_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(E.class_weights(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic", 0.5))


def rule_probs(rule: str) -> Column:
    return F.array(*[F.when(F.col(f"pred_{rule}") == y, 0.6).otherwise(0.1) for y in CLASSES])


def soft(spark: SparkSession, sf: str) -> DataFrame:
    rows = predicted(spark, sf).select(KEY, *[rule_probs(n).alias(f"pr_{n}") for n in RULES])
    return rounded(ensemble.vote_soft([f"pr_{n}" for n in RULES], CLASSES, rows).drop(*[f"pr_{n}" for n in RULES]))


def hard(spark: SparkSession, sf: str) -> DataFrame:
    rows = predicted(spark, sf)
    return rows.select(KEY, ensemble.vote_hard([f"pred_{n}" for n in RULES], CLASSES).alias("prediction"))


def votes(rows: DataFrame) -> DataFrame:
    cells = [F.struct(F.lit(n).alias("model"), F.col(f"pred_{n}").alias("prediction"), rule_probs(n).alias("probs")) for n in RULES]
    return rows.select(KEY, F.inline(F.array(*cells)))


def soft_long(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ensemble.vote_soft_long(votes(predicted(spark, sf)), KEY, CLASSES))


def hard_long(spark: SparkSession, sf: str) -> DataFrame:
    return ensemble.vote_hard_long(votes(predicted(spark, sf)), KEY)


def softmaxed(spark: SparkSession, sf: str) -> DataFrame:
    names = ["TotalRooms", "BuildingGrade", "BuildingCondition"]
    rows = listing(spark, sf, KEY, *names)
    return rounded(rows.select(KEY, *[c.alias(f"p{i}") for i, c in enumerate(softmax(names))]))


def entries() -> dict:
    report = " UNION ALL ".join([
        f"SELECT CAST(class AS VARCHAR) AS class, {', '.join(rs(m, m) for m in MEASURES)}, support FROM per",
        f"SELECT 'macro avg', {', '.join(rs(f'avg({m})', m) for m in MEASURES)}, CAST(sum(support) AS BIGINT) FROM per",
        f"SELECT 'weighted avg', {', '.join(rs(f'sum({m} * support) / sum(support)', m) for m in MEASURES)}, CAST(sum(support) AS BIGINT) FROM per",
        f"SELECT 'accuracy', {', '.join(rs('CAST(sum(hit) AS DOUBLE) / sum(support)', m) for m in MEASURES)}, CAST(sum(support) AS BIGINT) FROM per",
    ])
    whole = f"{RULED}, {grid_sql()}, {classes_sql()}"
    fold_lines = "UNNEST([" + ", ".join(f"{{'metric': '{m}', 'v': {m}}}" for m in ("accuracy", *MEASURES)) + "], recursive := true)"
    raw_metrics = metrics_select("fold").replace("round(", "(").replace(", 6)", ")")
    votes_sql = ", ".join(f"sum(CASE WHEN p = {y} THEN 0.6e0 ELSE 0.1e0 END) / 3 AS p{y}" for y in CLASSES)
    long = f"v AS (SELECT {KEY}, UNNEST([pred_a, pred_b, pred_c]) AS p FROM pred)"
    soft_sql = f"""{RULED}, {long}, m AS (SELECT {KEY}, {votes_sql} FROM v GROUP BY 1), x AS (SELECT {KEY}, {', '.join(rs(f'p{y}', f'p{y}') for y in CLASSES)} FROM m)
 SELECT *, CASE greatest(p0, p1, p2, p3, p4) WHEN p0 THEN 0 WHEN p1 THEN 1 WHEN p2 THEN 2 WHEN p3 THEN 3 ELSE 4 END AS prediction FROM x"""
    hard_sql = f"""{RULED}, {long} SELECT {KEY}, p AS prediction FROM (SELECT {KEY}, p, count(*) AS n FROM v GROUP BY 1, 2)
 QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY n DESC, p) = 1"""
    return {
        "confusion_matrix": (confusion, f"{RULED}, {grid_sql()} SELECT * FROM matrix"),
        "confusion_matrix_unseen_class": (unseen, f"{UNSEEN_SQL}, {grid_sql()} SELECT * FROM matrix"),
        "classification_metrics_unseen_class": (
            lambda s, d: rounded(E.classification_metrics(unseen(s, d))), f"{UNSEEN_SQL}, {grid_sql()}, {classes_sql()} {metrics_select()}"),
        "classification_metrics": (metrics("weighted"), f"{whole} {metrics_select()}"),
        "classification_metrics_macro": (metrics("macro"), f"{whole} {metrics_select(average='macro')}"),
        "classification_report": (lambda s, d: rounded(E.classification_report(confusion(s, d))), f"{whole} {report}"),
        "aggregate_folds": (fold_summary, f"""{FOLDED}, {grid_sql('fold')}, {classes_sql('fold')}, fm AS ({raw_metrics}), l AS (SELECT {fold_lines} FROM fm)
 SELECT metric, {rs("avg(v)", "mean")}, {rs("stddev_pop(v)", "std")}, {rs("min(v)", "min")}, {rs("max(v)", "max")} FROM l GROUP BY 1"""),
        "combine_reports": (combined, f"""{FOLDED}, {grid_sql('fold')}, {classes_sql('fold')}, fm AS ({raw_metrics}),
 cls AS (SELECT CAST(class AS VARCHAR) AS class, {', '.join(f'sum({m} * support) / sum(support) AS {m}' for m in MEASURES)}, CAST(sum(support) AS DOUBLE) AS support FROM per GROUP BY 1)
 SELECT class, {', '.join(rs(m, m) for m in MEASURES)}, support FROM cls
 UNION ALL SELECT 'macro avg', {', '.join(rs(f'avg({m})', m) for m in MEASURES)}, sum(support) FROM cls
 UNION ALL SELECT 'weighted avg', {', '.join(rs(f'sum({m} * support) / sum(support)', m) for m in MEASURES)}, sum(support) FROM cls
 UNION ALL SELECT 'accuracy', {', '.join(rs('avg(accuracy)', m) for m in MEASURES)}, CAST(NULL AS DOUBLE) FROM fm"""),
        "evaluate_sets": (sets, f"""{RULED.replace("AS (SELECT " + KEY + ", " + LABEL, "AS (SELECT CASE WHEN YearListed < 1997 THEN 'train' ELSE 'valid' END AS set, " + KEY + ", " + LABEL)},
 {grid_sql('set')}, {classes_sql('set')} {metrics_select('set')}"""),
        "class_weights": (weights(1.0), weights_sql("1.0e0")),
        "class_weights_sqrt": (weights(0.5), weights_sql("0.5e0")),
        "class_weights_labels": (toxic_weights, weights_sql("0.5e0", "doc_id", "toxic", "labels", "WITH")),
        "prediction_distribution": (lambda s, d: E.prediction_distribution(predicted(s, d)), f"{RULED} SELECT prediction AS predicted, count(*) AS n FROM pred GROUP BY 1"),
        "vote_soft": (soft, soft_sql),
        "vote_soft_long": (soft_long, soft_sql),
        "vote_hard": (hard, hard_sql),
        "vote_hard_long": (hard_long, hard_sql),
        "softmax": (softmaxed, WITH + f""" SELECT {KEY}, {', '.join(rs(f'exp({c}) / (exp(TotalRooms) + exp(BuildingGrade) + exp(BuildingCondition))', f'p{i}') for i, c in enumerate(("TotalRooms", "BuildingGrade", "BuildingCondition")))} FROM listing"""),
    }
