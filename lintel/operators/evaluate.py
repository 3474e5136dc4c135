"""Class weights and evaluation of predicted labels, all from the confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.operators.state import State, lookup
from lintel.session import cut


def weight_table(df: DataFrame, label: str, power: float = 1.0) -> DataFrame:
    """(N / n_c) ** power per class, divided by its mean over the rows."""
    counts = {r[label]: r.n for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}  # classes
    total = sum(counts.values())
    raw = {y: (total / n) ** power for y, n in counts.items()}
    mean = sum(raw[y] * n for y, n in counts.items()) / total
    rows = [(y, n, raw[y] / mean) for y, n in counts.items()]
    kind = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"`{label}` {kind}, n long, weight double")


def class_weights(df: DataFrame, label: str, power: float = 1.0, name: str = "weight") -> DataFrame:
    """Each row with the weight of its class."""
    table = State.of(weight_table(df, label, power), count="n")
    return lookup(df, table, {label: label}, {"weight": name})


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: list[int] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Rows per (true, predicted) for every pair of classes, absent pairs as 0.

    The classes are those given and those seen on either side, so no row falls out of the grid. Rows with a null
    label or prediction are lines of their own, where there are any.
    """
    by = by or []
    # (classes + 1) ** 2 lines per fold: written once, then read for the classes and for the grid
    counts = cut(df.groupBy(
        *by, F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count("*").alias("n")))
    seen = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).where("c IS NOT NULL").distinct()
    every = sorted({*(classes or []), *(r.c for r in seen.collect())})
    if not every:
        return counts
    line = F.array(*[F.lit(c) for c in every])
    grid = (
        (counts.select(*by).distinct() if by else df.sparkSession.range(1))
        .select(*by, F.explode(line).alias("actual")).withColumn("predicted", F.explode(line)).withColumn("n", F.lit(0))
    )
    return grid.unionByName(counts).groupBy(*by, "actual", "predicted").agg(F.sum("n").alias("n"))


def class_report(matrix: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator gives 0.

    A row without a prediction is a miss of its class; a row without a label cannot be judged and counts nowhere.
    """
    by = by or []
    matrix = matrix.where("actual IS NOT NULL")
    sides = matrix.select(
        *by,
        F.inline(F.array(
            F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).alias("called"),
                     F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("predicted").alias("class"), F.lit(0).alias("support"), F.col("n").alias("called"),
                     F.lit(0).alias("hit")),
        )),
    )
    sums = sides.where("class IS NOT NULL").groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hit")])
    precision = ratio0(F.col("hit"), F.col("called"))
    recall = ratio0(F.col("hit"), F.col("support"))
    return sums.select(
        *by, "class", precision.alias("precision"), recall.alias("recall"),
        # 2 * hit / (called + support) is the harmonic mean of both
        ratio0(2 * F.col("hit"), F.col("called") + F.col("support")).alias("f1"),
        "support", "hit",
    )


def ratio0(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(0.0)


def classification_report(matrix: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The per-class rows plus accuracy, macro avg and weighted avg, as text-labelled rows."""
    by = by or []
    per_class = class_report(matrix, by)
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    weighted = [ratio0(F.sum(F.col(m) * F.col("support")), total) for m in measures]
    macro = [F.avg(m) for m in measures]
    accuracy = ratio0(F.sum("hit"), total)

    def row(name: str, values: list[Column]) -> Column:
        return F.struct(
            F.lit(name).alias("class"), *[v.alias(m) for v, m in zip(values, measures, strict=True)],
            total.alias("support"),
        )

    lines = per_class.groupBy(*by).agg(
        F.array(
            row("accuracy", [accuracy] * 3), row("macro avg", macro), row("weighted avg", weighted)
        ).alias("lines")
    )
    return per_class.select(*by, F.col("class").cast("string"), *measures, "support").unionByName(
        lines.select(*by, F.inline("lines"))
    )


def classification_metrics(matrix: DataFrame, by: list[str] | None = None, average: str = "weighted") -> DataFrame:
    """One row: accuracy and averaged precision, recall and F1. average: weighted, macro or micro."""
    by = by or []
    per_class = class_report(matrix, by)
    total = F.sum("support")
    accuracy = ratio0(F.sum("hit"), total)
    averages = {
        "weighted": lambda m: ratio0(F.sum(F.col(m) * F.col("support")), total),
        "macro": F.avg,
        "micro": lambda m: accuracy,
    }
    average_of = averages[average]
    return per_class.groupBy(*by).agg(
        accuracy.alias("accuracy"), *[average_of(m).alias(m) for m in ("precision", "recall", "f1")]
    )


def metric_rows(metrics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(metric, value) rows from a one-row-per-fold table of metrics."""
    by = by or []
    names = [c for c in metrics.columns if c not in by]
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names]
    return metrics.select(*by, F.inline(F.array(*cells)))


def aggregate_folds(rows: DataFrame) -> DataFrame:
    """Mean, population std, min and max per metric over folds."""
    return rows.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )


def combine_reports(reports: DataFrame, accuracies: DataFrame) -> DataFrame:
    """Fold reports (fold, class, precision, recall, f1, support) as one report.

    Classes are averaged by support, then over classes plainly and by support; accuracy is the
    plain mean of the fold accuracies (fold, accuracy).
    """
    measures = ("precision", "recall", "f1")
    per_class = reports.groupBy(F.col("class").cast("string").alias("class")).agg(
        *[ratio0(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").cast("double").alias("support"),
    )
    total = F.sum("support")
    macro = per_class.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], total.alias("support"))
    weighted = per_class.agg(
        F.lit("weighted avg").alias("class"),
        *[ratio0(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in measures],
        total.alias("support"),
    )
    accuracy = accuracies.agg(F.avg("accuracy").alias("a")).select(
        F.lit("accuracy").alias("class"), *[F.col("a").alias(m) for m in measures], F.lit(None).cast("double").alias("support")
    )
    return per_class.unionByName(macro).unionByName(weighted).unionByName(accuracy)


def prediction_distribution(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(prediction).cast("int").alias("predicted")).agg(F.count("*").alias("n")).orderBy("predicted")


def evaluate_sets(sets: dict[str, DataFrame], label: str, prediction: str, classes: list[int] | None = None) -> DataFrame:
    """Accuracy and weighted metrics per named set (train, valid), in one aggregation."""
    marked = [df.select(F.lit(name).alias("set"), label, prediction) for name, df in sets.items()]
    both = marked[0]
    for more in marked[1:]:
        both = both.unionByName(more)
    matrix = confusion_matrix(both, label, prediction, classes, ["set"])
    return classification_metrics(matrix, ["set"])
