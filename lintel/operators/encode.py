"""Encodings of text columns: frequency, smoothed class probabilities, one-hot, ordinal."""

from __future__ import annotations

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lintel.functions.nullsafe import to_category
from lintel.operators.clean import MISSING
from lintel.operators.profile import melt
from lintel.operators.ranking import dense_position
from lintel.operators.state import Fitted, State, lookup
from lintel.session import cut

#: 0/1 columns that one-hot encoding makes at most; columns beyond that become sparse vectors.
MAX_ONE_HOT = 2_000


def _categories(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """Melted columns with a missing value as its own category."""
    return melt(df.withColumns({c: to_category(c) for c in columns}), columns, "string", list(keep))


def _per_column(state: State, columns: list[str]) -> dict[str, State]:
    return {
        c: State(state.df.where(F.col("column") == c).drop("column"), state.small, state.count)
        for c in columns
    }


class FrequencyEncoder(Fitted):
    """FE__<col>: share of the value among the fitted rows; unseen 0."""

    def apply(self, df: DataFrame) -> DataFrame:
        for c in self.params["columns"]:
            key = "__cat"
            name = f"FE__{c}"
            df = lookup(
                df.withColumn(key, to_category(c)), self.states[c], {key: "value"}, {"share": name}, {name: 0.0}
            ).drop(key)
        return df


def fit_frequency(df: DataFrame, columns: list[str]) -> FrequencyEncoder:
    counts = _categories(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    whole = State.of(counts, count="n")
    total = whole.df.where(F.col("column") == columns[0]).agg(F.sum("n")).first()[0]
    shares = State(whole.df.withColumn("share", F.col("n") / F.lit(float(total or 1))), whole.small, "n")
    return FrequencyEncoder({"columns": columns}, _per_column(shares, columns))


def label_classes(df: DataFrame, target: str) -> list[int]:
    """Class labels in order, without null. They come to the driver, as each becomes a column of what is fitted."""
    return sorted(r[0] for r in df.select(target).where(F.col(target).isNotNull()).distinct().collect())


def class_counts(target: str, classes: list[int]) -> list[Column]:
    return [F.count_if(F.col(target) == y).alias(f"n{i}") for i, y in enumerate(classes)]


def smoothed(counts: Column, n: Column, prior: Column | float, alpha: float) -> Column:
    return (counts + alpha * (prior if isinstance(prior, Column) else F.lit(prior))) / (n + alpha)


def _probability_names(column: str, classes: int) -> dict[str, str]:
    return {f"p{i}": f"TE__{column}__p{i}" for i in range(classes)}


class TargetEncoder(Fitted):
    """TE__<col>__p<k>: smoothed class probabilities of the value; unseen gets the prior."""

    def apply(self, df: DataFrame) -> DataFrame:
        prior = self.params["prior"]
        for c in self.params["columns"]:
            key = F.col(c).cast("string") if self.params["null_is_prior"] else to_category(c)
            names = _probability_names(c, len(prior))
            fills = dict(zip(names.values(), prior, strict=True))
            df = lookup(df.withColumn("__cat", key), self.states[c], {"__cat": "value"}, names, fills).drop("__cat")
        return df


def fit_target(
    df: DataFrame,
    columns: list[str],
    target: str,
    classes: list[int] | None = None,
    alpha: float = 10.0,
    null_is_prior: bool = False,
) -> TargetEncoder:
    """With null_is_prior a missing value is no category: it is encoded by the prior."""
    classes = classes or label_classes(df, target)
    # over the rows with a label, so that the shares add up to 1
    sizes = df.agg(F.count(target).alias("n"), *class_counts(target, classes)).first()
    prior = [sizes[f"n{i}"] / (sizes.n or 1) for i in range(len(classes))]
    long = _categories(df, columns, target)
    if null_is_prior:
        long = melt(df, columns, "string", [target]).where("value IS NOT NULL")
    counts = long.groupBy("column", "value").agg(F.count(target).alias("n"), *class_counts(target, classes))
    table = counts.select(
        "column", "value", "n",
        *[smoothed(F.col(f"n{i}"), F.col("n"), prior[i], alpha).alias(f"p{i}") for i in range(len(classes))],
    )
    return TargetEncoder(
        {"columns": columns, "prior": prior, "null_is_prior": null_is_prior},
        _per_column(State.of(table, count="n"), columns),
    )


def target_encode_oof(
    df: DataFrame, columns: list[str], target: str, fold: str, classes: list[int] | None = None, alpha: float = 10.0
) -> DataFrame:
    """Training rows encoded by the other folds: a row's own label has no part in its encoding."""
    classes = classes or label_classes(df, target)
    ks = range(len(classes))
    per_fold = df.groupBy(fold).agg(F.count(target).alias("n"), *class_counts(target, classes)).collect()
    total = {"n": sum(r.n for r in per_fold), **{f"n{i}": sum(r[f"n{i}"] for r in per_fold) for i in ks}}
    rest = {r[fold]: [(total[f"n{i}"] - r[f"n{i}"]) / ((total["n"] - r.n) or 1) for i in ks] for r in per_fold}
    prior = F.create_map(*[x for f, p in rest.items() for x in (F.lit(f), F.array(*[F.lit(v) for v in p]))])

    counts = _categories(df, columns, target, fold).groupBy("column", "value", fold).agg(
        F.count(target).alias("n"), *class_counts(target, classes)
    )
    whole = W.partitionBy("column", "value")  # one row per fold
    others = counts.select(
        "column", "value", F.col(fold).alias("__fold"), "n", prior[F.col(fold)].alias("prior"),
        (F.sum("n").over(whole) - F.col("n")).alias("m"),
        *[(F.sum(f"n{i}").over(whole) - F.col(f"n{i}")).alias(f"m{i}") for i in ks],
    ).select(
        "column", "value", "__fold", "n",
        *[smoothed(F.col(f"m{i}"), F.col("m"), F.get("prior", F.lit(i)), alpha).alias(f"p{i}") for i in ks],
    )
    for c, state in _per_column(State.of(others, count="n"), columns).items():
        on = {"__cat": "value", fold: "__fold"}
        names = _probability_names(c, len(classes))
        df = lookup(df.withColumn("__cat", to_category(c)), state, on, names).drop("__cat")
    return df


class MeanTargetEncoder(Fitted):
    """<col>_te: mean label of the value; missing or unseen gets the overall mean."""

    def apply(self, df: DataFrame) -> DataFrame:
        for c in self.params["columns"]:
            key = F.col(c).cast("string")
            name = f"{c}_te"
            fills = {name: self.params["mean"]}
            df = lookup(df.withColumn("__cat", key), self.states[c], {"__cat": "value"}, {"m": name}, fills).drop("__cat")
        return df


def fit_mean_target(df: DataFrame, columns: list[str], target: str) -> MeanTargetEncoder:
    overall = df.agg(F.avg(target)).first()[0]
    long = melt(df, columns, "string", [target]).where("value IS NOT NULL")
    table = long.groupBy("column", "value").agg(F.count("*").alias("n"), F.avg(target).alias("m"))
    return MeanTargetEncoder({"columns": columns, "mean": overall}, _per_column(State.of(table, count="n"), columns))


class OneHot(Fitted):
    """<col>_<value> 0/1 per fitted value in order; an unseen value is all zero.

    A column with too many values for columns of their own becomes one sparse vector, OneHot__<col>, whose slots are
    the values in order; its values are a fitted table, found by join.
    """

    def apply(self, df: DataFrame) -> DataFrame:
        return self.vectors(df.select("*", *self.columns()))

    def columns(self) -> list[Column]:
        return [
            (F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) == v).cast("int").alias(name)
            for c, v, name in self.names()
        ]

    def names(self) -> list[tuple[str, str, str]]:
        """(column, value, output name): plain and unique, whatever the values hold."""
        out: list[tuple[str, str, str]] = []
        taken: set[str] = set()
        for c, vs in self.params["values"].items():
            for v in vs:
                plain = f"{c}_{v}".replace(".", "_").replace("`", "_")
                name, n = plain, 1
                while name.lower() in taken:
                    n += 1
                    name = f"{plain}__{n}"
                taken.add(name.lower())
                out.append((c, v, name))
        return out

    def vectors(self, df: DataFrame) -> DataFrame:
        for c, n in self.params.get("wide", {}).items():
            code = f"__hot_{c}"
            key = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
            df = lookup(df.withColumn("__cat", key), self.states[c], {"__cat": "value"}, {"code": code}, {code: n}).drop("__cat")
            # the size alone goes with the column: MLlib's encoder would name every slot, on the driver
            size = {"ml_attr": {"num_attrs": n}}
            df = df.withColumn(f"OneHot__{c}", _one_slot(n)(F.col(code)).alias(f"OneHot__{c}", metadata=size)).drop(code)
        return df


def _one_slot(n: int):
    """Sparse vectors of n slots with a 1 in the slot given; n itself, an unseen value, has no slot."""

    def vector(code: int) -> SparseVector:
        return SparseVector(n, [code], [1.0]) if code < n else SparseVector(n, [], [])

    return F.udf(vector, VectorUDT(), useArrow=False)


def slot_counts(df: DataFrame, vectors: str) -> DataFrame:
    """Rows per slot (slot, n) of a column of sparse vectors, slot by slot: no table of all slots is held anywhere."""
    cells = df.select(F.unwrap_udt(vectors).alias("v")).select(F.inline(F.arrays_zip("v.indices", "v.values")).alias("slot", "x"))
    return cells.where("x <> 0").groupBy("slot").agg(F.count("*").alias("n"))


def fit_one_hot(df: DataFrame, columns: list[str], most: int = MAX_ONE_HOT) -> OneHot:
    """Values with columns of their own while these are `most` at most, columns with few values first; the rest as vectors."""
    filled = df.select([F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in columns])
    found = cut(melt(filled, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n")))
    sizes = {r["column"]: r.values for r in found.groupBy("column").agg(F.count("*").alias("values")).collect()}
    narrow, total = [], 0
    for c in sorted(columns, key=lambda c: (sizes.get(c, 0), columns.index(c))):
        total += sizes.get(c, 0)
        if total <= most:
            narrow.append(c)
    values = {r: [] for r in columns if r in narrow}
    for r in found.where(F.col("column").isin(narrow)).collect() if narrow else ():
        values[r["column"]].append(r.value)
    wide = {c: sizes[c] for c in columns if c not in narrow}
    states = {}
    for c in wide:
        own = found.where(F.col("column") == c).select("value", "n")
        states[c] = State.of(dense_position(own, "value", "code").withColumn("code", F.col("code").cast("int")), count="n")
    return OneHot({"values": {c: sorted(v) for c, v in values.items()}, "wide": wide}, states)


class OrdinalEncoder(Fitted):
    """<col> replaced by the 0-based place of its value among all fitted values; null stays null."""

    def apply(self, df: DataFrame) -> DataFrame:
        order = df.columns
        for c in self.params["columns"]:
            out = lookup(
                df.withColumn("__cat", F.col(c).cast("string")), self.states[c], {"__cat": "value"}, {"code": "__code"}
            )
            df = out.drop(c, "__cat").withColumnRenamed("__code", c)
        return df.select(*order)


def fit_ordinal(tables: list[DataFrame], columns: list[str]) -> OrdinalEncoder:
    """Codes over the values of all given tables together."""
    values = [melt(t, columns, "string").where("value IS NOT NULL") for t in tables]
    both = values[0]
    for more in values[1:]:
        both = both.union(more)
    distinct = State.of(both.groupBy("column", "value").agg(F.count("*").alias("n")), count="n")
    states = {}
    for c in columns:
        own = distinct.df.where(F.col("column") == c).select("value", "n")
        if distinct.small:
            coded = own.select("value", "n", (F.row_number().over(W.partitionBy(F.lit(0)).orderBy("value")) - 1).alias("code"))
        else:
            coded = dense_position(own, "value", "code").withColumn("code", F.col("code").cast("int"))
        states[c] = State.of(coded, count="n")
    return OrdinalEncoder({"columns": columns}, states)
