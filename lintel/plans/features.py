"""The whole feature table: every branch side by side, in one plan.

Fitting takes a handful of aggregations, whatever the number of columns: one for all that is asked of whole columns, the search for
medians, and one grouped pass that gives each value of each key column its frequency, its class
probabilities and its group statistics; what does not depend on each other runs side by side. Applying is one projection plus one join per key column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lintel.functions.derived import DERIVED, INPUTS, PLOT_BINS, add_derived
from lintel.functions.nullsafe import blank_or_null_flag, equal_width_edges, log1p_clip, to_category, to_num
from lintel.operators.encode import MAX_ONE_HOT, OneHot, class_counts, fit_one_hot, label_classes, smoothed
from lintel.operators.groups import relative_to_group
from lintel.operators.neighbours import knn_fill
from lintel.operators.profile import melt
from lintel.operators.quantiles import column_quantiles
from lintel.operators.schema import infer_column_types
from lintel.operators.state import Fitted, State, lookup

# Default column roles.
DROP = ["AlleyAccess", "ExteriorFinishType", "RecreationQuality", "MiscellaneousFeature"]
# Columns of few values, nearly all of them one; the longer policy drops them as well.
IMBALANCED = [
    "ZoningClassification", "StreetType", "LandFlatness", "UtilitiesAvailable", "PlotConfiguration", "PlotSlope", "Proximity1", "Proximity2",
    "BuildingType", "FunctionalityRating", "ParkingType", "ParkingQuality", "ParkingCondition", "PavedAccess", "ListingType", "ListingCondition",
]
DROP_POLICIES = {"short": DROP, "long": [*DROP, *IMBALANCED]}
FREQUENCY = ["RoofType", "ExteriorCovering1", "FoundationType"]
TARGET = ["ZoningClassification", "BuildingType", "BuildingStyle", "HeatingType"]
LOG = ["PlotSize"]
BUSINESS = "ConferenceRoomQuality"
GROUPS = ["ZoningClassification", "BuildingType"]
GROUP_VALUES = ["TotalLivingArea", "BuildingAge", "OverallQuality"]
ROBUST_MODELS = {"svm", "ridge", "logistic", "mlp", "knn", "naive_bayes", "ensemble"}
PLAIN_MODELS = {"tabnet"}


@dataclass
class FeatureConfig:
    key: str
    label: str
    drop: list[str] | str = "short"  # columns, or the name of a policy
    frequency: list[str] = field(default_factory=lambda: list(FREQUENCY))
    target: list[str] = field(default_factory=lambda: list(TARGET))
    log: list[str] = field(default_factory=lambda: list(LOG))
    business: str | None = BUSINESS
    groups: list[str] = field(default_factory=lambda: list(GROUPS))
    alpha: float = 10.0
    model: str = "tree"
    wide: bool = True
    group_statistics: bool = True
    impute: str = "median"  # or "knn"
    neighbours: int = 5
    classes: list[int] | None = None
    most_one_hot: int = MAX_ONE_HOT


class Features(Fitted):
    """Fitted feature table. `apply` keeps key and label (if present) and yields the features."""

    def apply(self, df: DataFrame, donors: DataFrame | None = None) -> DataFrame:
        p = self.params
        key, label = p["key"], p["label"]
        kept = [c for c in (key, label, *p["carry"]) if c in df.columns]
        numeric, derived, grouped = p["numeric"], p["derived"], p["grouped"]

        if p["impute"] == "knn":
            if donors is None:
                raise ValueError("nearest-neighbour imputation needs the fitted rows as donors")
            df = knn_fill(df, donors, key, numeric, p["neighbours"])

        # derived columns get a prefix, so that they cannot clash with raw ones
        joined = df
        if derived or grouped:
            names = sorted({*derived, *grouped}, key=DERIVED.index)
            raw = df.drop(*[c for c in names if c not in numeric])
            own = [c for c in names if c in numeric]
            raw = raw.withColumns({f"__own_{c}": F.col(c) for c in own})
            made = add_derived(raw, names, p["plot_edges"]).withColumnsRenamed({c: f"__d_{c}" for c in names})
            joined = made.withColumnsRenamed({f"__own_{c}": c for c in own})

        for c in p["keyed"]:
            fills = {
                f"__{c}_{s}": F.lit(v)
                for s, v in (("fe", 0.0), *((f"p{i}", v) for i, v in enumerate(p["prior"])))
            }
            add = {s: f"__{c}_{s}" for s in ["fe", *[f"p{i}" for i in range(len(p["prior"]))]]}
            if c in p["groups"]:
                add.update({f"{m}_{v}": f"__{c}_{m}_{v}" for v in grouped for m in ("mean", "std")})
            joined = lookup(
                joined.withColumn("__cat", to_category(c)), self.states[c], {"__cat": "value"}, add, fills
            ).drop("__cat")
        joined = self.one_hot().vectors(joined)
        return joined.select(*kept, *[col.alias(name) for name, col in self._outputs(joined).items()])

    def one_hot(self) -> OneHot:
        wide = self.params.get("wide_one_hot", {})
        return OneHot({"values": self.params["one_hot"], "wide": wide}, {c: self.states[f"hot_{c}"] for c in wide})

    def _outputs(self, joined: DataFrame) -> dict[str, Column]:
        p = self.params
        out: dict[str, Column] = {}
        for c in p["numeric"]:
            value = F.coalesce(_filled(joined, c), F.lit(p["medians"].get(c)))
            if c in p["log"]:
                value = log1p_clip(value)
            centre, spread = p["scale"][c]
            out[c] = (value - centre) / spread
        for c in p["flags"]:
            out[f"{c}_missing"] = F.col(c).isNull().cast("int")
        one_hot = self.one_hot()
        out.update({f"OneHot__{c}": F.col(f"OneHot__{c}") for c in p.get("wide_one_hot", {})})
        out.update({name: col for (_, _, name), col in zip(one_hot.names(), one_hot.columns(), strict=True)})
        if p["business"]:
            out[f"{p['business']}_blank"] = blank_or_null_flag(joined, p["business"])
        for c in p["derived"]:
            out[_wide_name(c, p["numeric"])] = F.coalesce(F.col(f"__d_{c}"), F.lit(p["derived_medians"][c]).cast("double"))
        for c in p["frequency"]:
            out[f"FE__{c}"] = F.col(f"__{c}_fe")
        for c in p["target"]:
            for i in range(len(p["prior"])):
                out[f"TE__{c}__p{i}"] = F.col(f"__{c}_p{i}")
        if p["groups"]:
            for name, col in _group_columns(p["groups"], p["grouped"]).items():
                out[name] = F.coalesce(col, F.lit(p["group_medians"].get(name)).cast("double"))
        return out

    @property
    def names(self) -> list[str]:
        """Feature names in output order."""
        p = self.params
        one_hot = [f"OneHot__{c}" for c in p.get("wide_one_hot", {})] + [n for _, _, n in self.one_hot().names()]
        return [
            *p["numeric"], *[f"{c}_missing" for c in p["flags"]], *one_hot,
            *([f"{p['business']}_blank"] if p["business"] else []),
            *[_wide_name(c, p["numeric"]) for c in p["derived"]],
            *[f"FE__{c}" for c in p["frequency"]],
            *[f"TE__{c}__p{i}" for c in p["target"] for i in range(len(p["prior"]))],
            *[f"{v}_{kind}__{g}" for g in p["groups"] for v in p["grouped"] for kind in ("ZScore", "RelShift")],
        ]

    @property
    def slots(self) -> list[str]:
        """Names of the slots of the assembled vector: a sparse one-hot column has one for each value."""
        wide = {f"OneHot__{c}": n for c, n in self.params.get("wide_one_hot", {}).items()}
        return [s for name in self.names for s in ([f"{name}[{i}]" for i in range(wide[name])] if name in wide else [name])]


def _wide_name(c: str, numeric: list[str]) -> str:
    return f"wide__{c}" if c in numeric else c


def _filled(df: DataFrame, c: str) -> Column:
    name = f"__knn_{c}"
    return F.col(name if name in df.columns else c).cast("double")


def _group_columns(groups: list[str], values: list[str]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for g in groups:
        present = F.col(g).isNotNull()
        for v in values:
            mean = F.when(present, F.col(f"__{g}_mean_{v}"))
            for name, col in relative_to_group(f"__d_{v}", g, mean, F.col(f"__{g}_std_{v}")).items():
                out[name.removeprefix("__d_")] = col
    return out


def fit_features(df: DataFrame, config: FeatureConfig, carry: list[str] | None = None) -> Features:
    """Learn everything from df: column statistics, categories, and per-value statistics."""
    key, label = config.key, config.label
    carry = carry or []
    dropped = DROP_POLICIES[config.drop] if isinstance(config.drop, str) else config.drop
    df = df.drop(*[c for c in dropped if c != key])
    numeric, text = infer_column_types(df, label, [key, *carry])
    if not numeric and not text:
        raise ValueError("every feature column is on the drop list")
    frequency = [c for c in config.frequency if c in df.columns]
    target = [c for c in config.target if c in df.columns]
    one_hot_columns = [c for c in text if c not in {*frequency, *target}]
    plain = config.model in PLAIN_MODELS
    derived = DERIVED if config.wide and not plain and any(c in df.columns for c in INPUTS) else []
    groups = [g for g in config.groups if g in df.columns] if config.group_statistics and not plain else []
    grouped = GROUP_VALUES if groups else []
    log = [c for c in config.log if c in numeric]
    classes = config.classes or label_classes(df, label)
    business = config.business if config.business in df.columns else None

    keyed = [c for c in text if c in {*frequency, *target, *groups}]
    keyed += [c for c in groups if c not in keyed]
    # read several times below; recomputed where an executor is lost
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counted = _counted(df, numeric, log, label, classes, bool(derived))
        plot_edges = equal_width_edges(counted.plot_lo, counted.plot_hi, PLOT_BINS) if derived and counted.plot_lo is not None else None
        # made as apply() makes them, whether or not the input has some of its own
        need = DERIVED if derived else sorted(grouped, key=DERIVED.index)
        made = add_derived(df, need, plot_edges) if need else df
        # one search for the medians of raw and derived columns; where names clash, the raw ones are searched apart
        by_median = config.impute == "median"
        raw = [c for c in numeric if c not in derived] if by_median else []

        def middles() -> dict[str, float | None]:
            found = {c: q[0] for c, q in column_quantiles(made, [*raw, *derived], [0.5]).items()}
            rest = [c for c in numeric if c in derived] if by_median else []
            return found | {f"__own_{c}": q[0] for c, q in column_quantiles(df, rest, [0.5]).items()}

        def keyed_parts() -> tuple[dict[str, State], list[float], dict]:
            states, prior = _keyed_fit(made, keyed, grouped, label, classes, config.alpha, counted)
            return states, prior, _group_medians(made, groups, grouped, states)

        def one_hot_part() -> OneHot:
            return fit_one_hot(df, one_hot_columns, config.most_one_hot) if one_hot_columns else OneHot({"values": {}, "wide": {}})

        # the branches need nothing of each other: their jobs and the planning of these overlap
        with ThreadPool(3) as pool:
            waiting = [pool.apply_async(part) for part in (keyed_parts, middles, one_hot_part)]
            (states, prior, group_medians), mids, hot = (part.get() for part in waiting)
        medians, flags, scale = _numeric_fit(df, numeric, log, config, {c: mids.get(f"__own_{c}", mids.get(c)) for c in numeric}, counted)
        derived_medians = {c: mids[c] for c in derived}
        states.update({f"hot_{c}": state for c, state in hot.states.items()})
    finally:
        df.unpersist()

    return Features(
        {
            "key": key, "label": label, "carry": carry, "numeric": numeric, "flags": flags, "log": log,
            "medians": medians, "scale": scale, "one_hot": hot.params["values"], "wide_one_hot": hot.params["wide"],
            "business": business, "derived": derived, "derived_medians": derived_medians,
            "plot_edges": plot_edges, "frequency": frequency, "target": target, "prior": prior,
            "keyed": keyed, "groups": groups, "grouped": grouped, "group_medians": group_medians,
            "impute": config.impute, "neighbours": config.neighbours,
        },
        states,
    )


def _counted(df: DataFrame, numeric: list[str], log: list[str], label: str, classes: list, plot: bool) -> Row:
    """What the branches of the fit need of whole columns, in one aggregation: rows, class sizes, the range of plot sizes, and count, mean and
    variance of every numeric column (of its logarithm, where it is to be logged).
    """
    value = {c: log1p_clip(F.col(c).cast("double")) if c in log else F.col(c).cast("double") for c in numeric}
    parts = [F.count("*").alias("n"), F.count(label).alias("labelled"), *class_counts(label, classes)]
    parts += [f(v).alias(f"{p}_{i}") for i, v in enumerate(value.values()) for p, f in (("c", F.count), ("m", F.avg), ("v", F.var_pop))]
    if plot:
        size = to_num(df, "PlotSize")
        parts += [F.min(size).alias("plot_lo"), F.max(size).alias("plot_hi")]
    return df.agg(*parts).first()


def _filled_moments(counted: Row, i: int, fill: float | None) -> tuple[float | None, float | None]:
    """Mean and population deviation of column i after its nulls are filled: those of the values and of the fill, put together."""
    n, mean, variance = counted[f"c_{i}"], counted[f"m_{i}"], counted[f"v_{i}"]
    gone = counted.n - n
    if not n or fill is None:
        return mean, None
    whole = (n * mean + gone * fill) / counted.n
    return whole, math.sqrt((n * (variance + (mean - whole) ** 2) + gone * (fill - whole) ** 2) / counted.n)


def _numeric_fit(
    df: DataFrame, numeric: list[str], log: list[str], config: FeatureConfig, mids: dict[str, float | None], counted: Row
) -> tuple[dict, list[str], dict]:
    """Medians, flagged columns, and centre and spread of the imputed (and logged) columns.

    Mean and deviation after filling follow from those before it. Quartiles survive filling with the median and a monotone logarithm only
    up to interpolation, so the robust scale is measured on the filled columns themselves, as is any after neighbours filled them.
    """
    if not numeric:
        return {}, [], {}
    robust = config.model in ROBUST_MODELS
    if config.impute == "knn":
        filled = knn_fill(df, df, config.key, numeric, config.neighbours)
        medians, flags = {}, numeric
        columns = [F.col(f"__knn_{c}").alias(c) for c in numeric]
    else:
        medians, flags = mids, [c for i, c in enumerate(numeric) if counted[f"c_{i}"] < counted.n]
        if not robust:
            fills = {c: math.log1p(max(m, 0.0)) if m is not None and c in log else m for c, m in mids.items()}
            moments = [_filled_moments(counted, i, fills[c]) for i, c in enumerate(numeric)]
            return medians, flags, {c: [centre or 0.0, spread or 1.0] for c, (centre, spread) in zip(numeric, moments, strict=True)}
        filled = df
        columns = [F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) for c in numeric]
    ready = filled.select(columns).select([log1p_clip(F.col(c)).alias(c) if c in log else F.col(c) for c in numeric])
    if robust:
        quartiles = column_quantiles(ready, numeric, [0.25, 0.5, 0.75])
        scale = {c: [q[1] or 0.0, (q[2] - q[0] if q[2] is not None else 0.0) or 1.0] for c, q in quartiles.items()}
    else:
        row = ready.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(numeric)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(numeric)],
        ).first()
        scale = {c: [row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0] for i, c in enumerate(numeric)}
    return medians, flags, scale


def _keyed_fit(
    made: DataFrame, keyed: list[str], grouped: list[str], label: str, classes: list[int], alpha: float, sizes: Row
) -> tuple[dict[str, State], list[float]]:
    """Frequency, smoothed class probabilities and group mean and std per value of each key column."""
    if not keyed:
        return {}, []
    prior = [sizes[f"n{i}"] / (sizes.labelled or 1) for i in range(len(classes))]
    slim = made.select(label, *grouped, *[to_category(c).alias(c) for c in keyed])
    counts = melt(slim, keyed, "string", [label, *grouped]).groupBy("column", "value").agg(
        F.count("*").alias("n"), F.count(label).alias("labelled"), *class_counts(label, classes),
        *[F.avg(v).alias(f"mean_{v}") for v in grouped],
        *[F.stddev_samp(v).alias(f"std_{v}") for v in grouped],
    )
    table = counts.select(
        "column", "value", "n", (F.col("n") / F.lit(float(sizes.n))).alias("fe"),
        *[smoothed(F.col(f"n{i}"), F.col("labelled"), prior[i], alpha).alias(f"p{i}") for i in range(len(classes))],
        *[f"{m}_{v}" for v in grouped for m in ("mean", "std")],
    )
    whole = State.of(table, count="n")
    return {
        c: State(whole.df.where(F.col("column") == c).drop("column"), whole.small, "n") for c in keyed
    }, prior


def _group_medians(made: DataFrame, groups: list[str], grouped: list[str], states: dict[str, State]) -> dict:
    """Medians of the group columns over the fitted rows, which fill rows without a group."""
    if not groups:
        return {}
    joined = made.select(*groups, *[F.col(v).alias(f"__d_{v}") for v in grouped])
    for g in groups:
        add = {f"{m}_{v}": f"__{g}_{m}_{v}" for v in grouped for m in ("mean", "std")}
        joined = lookup(joined.withColumn("__cat", to_category(g)), states[g], {"__cat": "value"}, add).drop("__cat")
    columns = _group_columns(groups, grouped)
    table = joined.select([c.alias(n) for n, c in columns.items()])
    return {c: q[0] for c, q in column_quantiles(table, list(columns), [0.5]).items()}
