"""Fitted cleaning, encoding, group statistics and scaling against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.checks.common import KEY, LABEL, WITH, per_column_sql, rounded, rs
from lintel.checks.tables import RANKED
from lintel.operators import clean, encode, groups, neighbours, ranking, scale
from lintel.plans.features import FeatureConfig, fit_features
from lintel.session import keep
from lintel.sources.listing import CLASSES, NUMERIC, TEXT, listing, numeric_rows, table

IMPUTED = NUMERIC
# The numeric columns of the test tables that have nulls.
NULLED = ["ConstructionYear", "RenovationYear", "GroundFloorArea", "UpperFloorArea", "BasementArea", "FinishedBasementArea1",
          "FinishedBasementArea2", "UnfinishedBasementArea", "PlotSize", "ParkingSpots", "Restrooms", "BasementQuality", "BasementCondition"]
WORDS = TEXT
FREQUENT = ["RoofType", "ExteriorCovering1", "FoundationType", "HeatingType"]
ENCODED = ["ZoningClassification", "BuildingType", "BuildingStyle", "HeatingType"]
ONE_HOT = ["HeatingType", "RoofType", "FoundationType"]
GROUPED = ["ZoningClassification", "BuildingType"]
VALUES = ["TotalLivingArea", "BuildingAge", "OverallQuality"]
BOUNDED = NUMERIC
#: Rows are removed by these alone: by all columns hardly any would be left.
REMOVED = ["GroundFloorArea", "PlotSize", "UpperFloorArea", "BuildingGrade"]


def train(df: DataFrame) -> DataFrame:
    """Rows fitted on: listings before 1997; everything is encoded from them."""
    return df.where("YearListed < 1997")


def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    rows = numeric_rows(spark, sf, *IMPUTED)
    return rounded(clean.fit_impute(keep(rows), IMPUTED, "median", add_indicator=True).apply(rows).drop(LABEL))


def impute_by(strategy: str, columns: list[str], **kw):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = listing(spark, sf, KEY, *columns)
        return rounded(clean.fit_impute(rows, columns, strategy, **kw).apply(rows))

    return query


def prefilled(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "ParkingSpots", "HeatingType", "PlotSize")
    return rounded(clean.prefill(rows, {"ParkingSpots": 0, "HeatingType": "none", "PlotSize": 0.0, "Absent": 1}))


def all_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "ParkingSpots").withColumns(
        {"GoneNumber": F.lit(None).cast("double"), "GoneText": F.lit(None).cast("string")}
    )
    return clean.fit_all_null(rows).apply(rows)


def collapse(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "YearListed", "BuildingStyle", "ExteriorCovering1")
    fitted = clean.fit_rare(train(rows), ["BuildingStyle", "ExteriorCovering1"], 0.0156)
    return fitted.apply(rows).drop("YearListed")


def clean_missing(spark: SparkSession, sf: str) -> DataFrame:
    rows = keep(listing(spark, sf, KEY, "YearListed", "ParkingSpots", "PlotSize", "BuildingStyle", "HeatingType"))
    rows = rows.withColumn("GoneNumber", F.lit(None).cast("double"))
    fitted = clean.fit_clean_missing(
        train(rows), ["ParkingSpots", "PlotSize", "GoneNumber"], ["BuildingStyle", "HeatingType"],
        text_strategy="constant", prefill_values={"ParkingSpots": 0}, rare_threshold=0.0156,
    )
    return rounded(fitted.apply(rows).drop("YearListed"))


def bounds(method: str, threshold: float):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = numeric_rows(spark, sf, *BOUNDED)
        rows = keep(rows) if method == "iqr" else rows  # the other takes one scan
        return rounded(clean.fit_outlier_bounds(rows, BOUNDED, method, threshold).table(spark))

    return query


def apply_bounds(action: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        columns = REMOVED if action == "remove" else BOUNDED
        rows = numeric_rows(spark, sf, *columns).drop(LABEL)
        return rounded(clean.fit_outlier_bounds(keep(rows), columns, "iqr", 0.3).apply(rows, action))

    return query


def outlier_info(spark: SparkSession, sf: str) -> DataFrame:
    rows = keep(numeric_rows(spark, sf, *BOUNDED))
    return rounded(clean.fit_outlier_bounds(rows, BOUNDED, "iqr", 0.3).info(rows))


def outlier_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events")
    return rounded(clean.fit_outlier_bounds(rows, ["value"], "iqr", 1.5).info(rows))


def frequency(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "YearListed", *FREQUENT)
    fitted = encode.fit_frequency(train(rows).where("RoofType > '2'"), FREQUENT)
    return rounded(fitted.apply(rows).select(KEY, *[f"FE__{c}" for c in FREQUENT]))


def frequency_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events")
    return rounded(encode.fit_frequency(rows, ["event_type"]).apply(rows).select("event_id", "FE__event_type"))


def target(null_is_prior: bool, columns: list[str]):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = listing(spark, sf, KEY, LABEL, "YearListed", *columns)
        fitted = encode.fit_target(train(rows), columns, LABEL, CLASSES, 10.0, null_is_prior)
        made = [f"TE__{c}__p{i}" for c in columns for i in range(len(CLASSES))]
        return rounded(fitted.apply(rows).select(KEY, *made))

    return query


def target_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    fitted = encode.fit_target(docs.select("doc_id", "source", "lang").join(labels, "doc_id"), ["source", "lang"], "quality", [0, 1])
    made = [f"TE__{c}__p{i}" for c in ("source", "lang") for i in (0, 1)]
    return rounded(fitted.apply(docs.select("doc_id", "source", "lang")).select("doc_id", *made))


def mean_target(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, LABEL, "YearListed", "HeatingType", "BuildingStyle")
    fitted = encode.fit_mean_target(train(rows), ["HeatingType", "BuildingStyle"], LABEL)
    return rounded(fitted.apply(rows).select(KEY, "HeatingType_te", "BuildingStyle_te"))


def target_oof(spark: SparkSession, sf: str) -> DataFrame:
    # joined and ranked once, for each count and for the encoding; rows of one key and class are dealt to folds in the order of the joins
    rows = keep(ranking.stratified_folds(listing(spark, sf, KEY, LABEL, *ENCODED), LABEL, KEY, 5, 42))
    out = encode.target_encode_oof(rows, ENCODED, LABEL, "fold", CLASSES)
    return rounded(out.select(KEY, *[f"TE__{c}__p{i}" for c in ENCODED for i in range(5)]))


def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "YearListed", *ONE_HOT)
    fitted = encode.fit_one_hot(train(rows).where("RoofType > '2'"), ONE_HOT)
    return rows.select(KEY, *fitted.columns())


def ordinal(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "YearListed", *WORDS)
    fitted = encode.fit_ordinal([train(rows), rows.where("YearListed >= 1997")], WORDS)
    return fitted.apply(rows).drop("YearListed")


def mode_impute(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "HeatingType", "ZoningClassification", "Proximity2", "Restrooms")
    filled = clean.fit_impute(rows, ["HeatingType", "ZoningClassification", "Proximity2"], "most_frequent").apply(rows)
    return filled.fillna(0, ["Restrooms"])


def scaled(fit):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = numeric_rows(spark, sf, *BOUNDED).drop(LABEL).withColumn("flat", F.lit(3.0))
        return rounded(fit(keep(rows), [*BOUNDED, "flat"]).apply(rows))

    return query


def grouped(spark: SparkSession, sf: str) -> DataFrame:
    from lintel.functions.derived import ensure_derived

    return ensure_derived(listing(spark, sf))


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(groups.group_stats(grouped(spark, sf), GROUPED, VALUES, median=True))


def relative(*kinds: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = grouped(spark, sf).select(KEY, *GROUPED, *VALUES)
        made = [f"{v}_{kind}__{g}" for kind in kinds for g in GROUPED for v in VALUES]
        return rounded(groups.fit_group_stats(rows, GROUPED, VALUES).apply(rows).select(KEY, *made))

    return query


PARTS = ["p_size", "p_retailprice", "p_weight"]


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with nulls put in."""
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double")).alias("p_size"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice")).alias("p_retailprice"),
        F.when(F.col("p_partkey") % 3 != 0, (F.col("p_partkey") * 37 % 101).cast("double")).alias("p_weight"),
    )


PARTS_SQL = """WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS p_size,
 CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END AS p_retailprice,
 CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey * 37 % 101 AS DOUBLE) END AS p_weight FROM part)"""


def knn_sql(k: int, weighted: bool, digits: int = 6) -> str:
    total = " + ".join(f"coalesce((q.{c} - d.{c}) * (q.{c} - d.{c}), 0)" for c in PARTS)
    shared = " + ".join(f"CAST(q.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INT)" for c in PARTS)
    searches = " UNION ALL ".join(
        f"""SELECT q.p_partkey AS k, '{c}' AS t, d.p_partkey AS dk, d.{c} AS v, sqrt(({total}) * 3 / ({shared})) AS dist
 FROM p q JOIN p d ON q.{c} IS NULL AND d.{c} IS NOT NULL WHERE {shared} > 0""" for c in PARTS
    )
    weight = "CASE WHEN min(dist) OVER (PARTITION BY k, t) = 0 THEN CAST(dist = 0 AS DOUBLE) ELSE 1 / dist END" if weighted else "1.0e0"
    fill = ", ".join(
        f'round(coalesce({c}, (SELECT m FROM f WHERE k = p_partkey AND t = \'{c}\'), (SELECT avg({c}) FROM p)), {digits}) + 0.0 AS {c}, CAST({c} IS NULL AS INT) AS "{c}_missing"'
        for c in PARTS
    )
    return PARTS_SQL + f""", near AS (SELECT * FROM ({searches}) QUALIFY row_number() OVER (PARTITION BY k, t ORDER BY dist, dk) <= {k}),
 w AS (SELECT *, {weight} AS w FROM near), f AS (SELECT k, t, sum(v * w) / sum(w) AS m FROM w GROUP BY 1, 2)
 SELECT p_partkey, {fill} FROM p"""


def knn(weights: str, scale_first: bool = False):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = parts(spark, sf)
        return rounded(neighbours.knn_impute(rows, rows, "p_partkey", PARTS, 5, weights, scale_first))

    return query


TRAIN = "SELECT * FROM listing WHERE YearListed < 1997"


def coalesced(columns: list[str], aggregate: str) -> str:
    return ", ".join(
        rs(f'coalesce(CAST("{c}" AS DOUBLE), (SELECT {aggregate.format(c=c)} FROM listing))', c) for c in columns
    )


def flags(columns: list[str]) -> str:
    return ", ".join(f'CAST("{c}" IS NULL AS INT) AS "{c}_missing"' for c in columns)


def mode_of(c: str, source: str = "listing") -> str:
    return f'(SELECT "{c}" FROM {source} WHERE "{c}" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, "{c}" LIMIT 1)'


def bounds_cte(names: list[str], threshold: str = "0.3e0") -> str:
    return ", ".join(
        f"""b_{c} AS (SELECT q1 - {threshold} * (q3 - q1) AS lo, q3 + {threshold} * (q3 - q1) AS hi
 FROM (SELECT quantile_cont(CAST("{c}" AS DOUBLE), 0.25) AS q1, quantile_cont(CAST("{c}" AS DOUBLE), 0.75) AS q3 FROM listing))""" for c in names
    )


def bounds_sql(action: str) -> str:
    cases = {
        "clip": 'CASE WHEN "{c}" IS NOT NULL THEN greatest(least(CAST("{c}" AS DOUBLE), b_{c}.hi), b_{c}.lo) END',
        "nan": 'CASE WHEN "{c}" BETWEEN b_{c}.lo AND b_{c}.hi THEN CAST("{c}" AS DOUBLE) END',
        "remove": 'CAST("{c}" AS DOUBLE)',
    }
    names = REMOVED if action == "remove" else BOUNDED
    columns = ", ".join(rs(cases[action].format(c=c), c) for c in names)
    where = " WHERE " + " AND ".join(f'"{c}" BETWEEN b_{c}.lo AND b_{c}.hi' for c in names) if action == "remove" else ""
    return WITH + f", {bounds_cte(names)} SELECT {KEY}, {columns} FROM listing, {', '.join(f'b_{c}' for c in names)}{where}"


def info_sql() -> str:
    lines = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {rs("min(lo)", "lower")}, {rs("min(hi)", "upper")}, count(*) FILTER ("{c}" < lo) AS n_below,
 count(*) FILTER ("{c}" > hi) AS n_above, count(*) FILTER ("{c}" < lo OR "{c}" > hi) AS n_total,
 {rs(f'count(*) FILTER ("{c}" < lo OR "{c}" > hi) * 100.0e0 / count(*)', "pct_outliers")} FROM listing, b_{c}""" for c in BOUNDED
    )
    return WITH + f", {bounds_cte(BOUNDED)} {lines}"


def target_sql(columns: list[str], null_is_prior: bool) -> str:
    ks = range(5)
    cat = (lambda c: f'"{c}"') if null_is_prior else (lambda c: f"coalesce(\"{c}\", 'nan')")
    priors = "prior AS (SELECT " + ", ".join(f"CAST(count(*) FILTER ({LABEL} = {k}) AS DOUBLE) / count(*) AS p{k}" for k in ks) + " FROM fitted)"
    maps, joins, out = [], [], []
    for i, c in enumerate(columns):
        keep = f' WHERE "{c}" IS NOT NULL' if null_is_prior else ""
        counts = ", ".join(f"count(*) FILTER ({LABEL} = {k}) AS n{k}" for k in ks)
        maps.append(f"m{i} AS (SELECT {cat(c)} AS v, count(*) AS n, {counts} FROM fitted{keep} GROUP BY 1)")
        joins.append(f" LEFT JOIN m{i} ON {cat(c)} = m{i}.v")
        out += [rs(f"coalesce((m{i}.n{k} + 10.0e0 * p{k}) / (m{i}.n + 10.0e0), p{k})", f"TE__{c}__p{k}") for k in ks]
    return WITH + f", fitted AS ({TRAIN}), {priors}, {', '.join(maps)} SELECT {KEY}, {', '.join(out)} FROM listing CROSS JOIN prior{''.join(joins)}"


def group_sql(*kinds: str) -> str:
    maps, joins, out = [], [], []
    for i, g in enumerate(GROUPED):
        each = ", ".join(f"avg({v}) AS m_{v}, stddev_samp({v}) AS s_{v}" for v in VALUES)
        maps.append(f"g{i} AS (SELECT {g} AS g, {each} FROM base WHERE {g} IS NOT NULL GROUP BY 1)")
        joins.append(f" LEFT JOIN g{i} ON {g} = g{i}.g")
    for kind in kinds:
        for i, g in enumerate(GROUPED):
            for v in VALUES:
                below = f"g{i}.s_{v}" if kind == "ZScore" else f"abs(g{i}.m_{v})"
                out.append(rs(f"({v} - g{i}.m_{v}) / ({below} + 0.000001e0)", f"{v}_{kind}__{g}"))
    return GROUP_BASE + f", {', '.join(maps)} SELECT {KEY}, {', '.join(out)} FROM base{''.join(joins)}"


GROUP_BASE = WITH + f""", base AS (SELECT {KEY}, {", ".join(GROUPED)}, GroundFloorArea + UpperFloorArea AS TotalLivingArea,
 CAST(CASE WHEN YearListed - ConstructionYear >= 0 THEN YearListed - ConstructionYear END AS DOUBLE) AS BuildingAge,
 CAST(BuildingGrade * BuildingCondition AS DOUBLE) AS OverallQuality FROM listing)"""


def stats_sql() -> str:
    lines = " UNION ALL ".join(
        f"""SELECT '{g}' AS "column", {g} AS "value", '{v}' AS measure, count({v}) AS n, {rs(f"avg({v})", "mean")},
 {rs(f"stddev_samp({v})", "std")}, {rs(f"median({v})", "median")} FROM base WHERE {g} IS NOT NULL GROUP BY {g}"""
        for g in GROUPED for v in VALUES
    )
    return GROUP_BASE + " " + lines


def scaled_sql(centre: str, spread: str) -> str:
    columns = ", ".join(
        rs(f'(CAST("{c}" AS DOUBLE) - (SELECT {centre.format(c=c)} FROM t)) / (SELECT CASE WHEN {spread.format(c=c)} = 0 THEN 1 ELSE {spread.format(c=c)} END FROM t)', c)
        for c in [*BOUNDED, "flat"]
    )
    return WITH + f""", t AS (SELECT {KEY}, {", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in BOUNDED)}, 3.0e0 AS flat FROM listing)
 SELECT {KEY}, {columns} FROM t"""


def one_hot_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A key taken as text: more values than columns are made for, so one sparse vector; rows are counted slot by slot."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("order"))
    fitted = encode.fit_one_hot(rows, ["order"], most=100)
    return encode.slot_counts(fitted.apply(rows), "OneHot__order")


def one_hot_sql() -> str:
    # The categories of these columns in the test tables.
    values = {
        "HeatingType": ["A", "N", "R", "__MISSING__"],
        "RoofType": ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
        "FoundationType": ["F", "O"],
    }
    out = ", ".join(f"CAST(coalesce({c}, '__MISSING__') = '{v}' AS INT) AS \"{c}_{v}\"" for c, vs in values.items() for v in vs)
    return WITH + f" SELECT {KEY}, {out} FROM listing"


def rare_case(c: str) -> str:
    return f"""CASE WHEN "{c}" IN (SELECT "{c}" FROM fitted WHERE "{c}" IS NOT NULL GROUP BY 1
 HAVING CAST(count(*) AS DOUBLE) / (SELECT count("{c}") FROM fitted) < 0.0156e0) THEN '__RARE__' ELSE "{c}" END"""


def oof_sql() -> str:
    ks = range(5)
    sums = ", ".join(f"CAST(count(*) FILTER ({LABEL} = {k}) AS DOUBLE) AS n{k}" for k in ks)
    rest = ", ".join(f"((SELECT count(*) FROM f WHERE {LABEL} = {k}) - n{k}) / ((SELECT count(*) FROM f) - n) AS p{k}" for k in ks)
    others = ", ".join(f"sum(n{k}) OVER (PARTITION BY v) - n{k} AS m{k}" for k in ks)
    parts = [
        f"""t{i} AS (SELECT {KEY}, {LABEL}, fold, coalesce({c}, 'nan') AS v FROM f JOIN listing USING ({KEY}, {LABEL})),
 counts{i} AS (SELECT v, fold, CAST(count(*) AS DOUBLE) AS n, {sums} FROM t{i} GROUP BY 1, 2),
 others{i} AS (SELECT v, fold, sum(n) OVER (PARTITION BY v) - n AS m, {others} FROM counts{i}),
 out{i} AS (SELECT {KEY}, {", ".join(rs(f"(m{k} + 10.0e0 * p{k}) / (m + 10.0e0)", f"TE__{c}__p{k}") for k in ks)} FROM t{i} JOIN others{i} USING (v, fold) JOIN rest USING (fold))"""
        for i, c in enumerate(ENCODED)
    ]
    joined = " ".join(f"JOIN out{i} USING ({KEY})" for i in range(1, len(ENCODED)))
    return RANKED + f""", f AS (SELECT {KEY}, {LABEL}, CAST((k - 1) % 5 AS INT) AS fold FROM ranked),
 per_fold AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, {sums} FROM f GROUP BY 1), rest AS (SELECT fold, {rest} FROM per_fold),
 {", ".join(parts)} SELECT * FROM out0 {joined}"""


def features_by_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """A feature table with nearest-neighbour imputation, of all parts: filled, flagged and scaled."""
    rows = parts(spark, sf).withColumn("kind", (F.col("p_partkey") % 3).cast("int"))
    fitted = fit_features(rows, FeatureConfig("p_partkey", "kind", impute="knn", classes=[0, 1, 2]))
    return rounded(fitted.apply(rows, rows), digits=5)


def features_by_neighbours_sql() -> str:
    scaled_ = ", ".join(rs(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", c, 5) for c in PARTS)
    flagged = ", ".join(f'"{c}_missing"' for c in PARTS)
    return f"SELECT p_partkey, CAST(p_partkey % 3 AS INT) AS kind, {scaled_}, {flagged} FROM ({knn_sql(5, False, 12)})"


def listing_by_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """All numeric columns of the whole listing filled from their nearest rows: what was there is as it was, and what was filled lies among the
    values of its column. tests/test_scale_paths.py holds filled values to brute force.
    """
    rows = numeric_rows(spark, sf).drop(LABEL)
    filled = neighbours.knn_impute(rows, rows, KEY, NUMERIC)
    spans = rows.agg(*[f(c).alias(f"{p}_{c}") for c in NULLED for p, f in (("lo", F.min), ("hi", F.max))]).first()
    inside = F.lit(True)
    for c in NULLED:
        inside = inside & F.col(c).between(spans[f"lo_{c}"], spans[f"hi_{c}"])
    kept = [F.when(F.col(f"{c}_missing") == 0, F.col(c)).alias(c) for c in NULLED]
    return rounded(filled.select(KEY, *[c for c in NUMERIC if c not in NULLED], *kept, *[f"{c}_missing" for c in NUMERIC], inside.alias("inside")))


def entries() -> dict:
    zoned = f"coalesce(ZoningClassification, {mode_of('ZoningClassification')}) AS ZoningClassification"
    fitted = f"{WITH}, fitted AS ({TRAIN})"
    return {
        "median_impute": (median_impute, WITH + f' SELECT {KEY}, {coalesced(IMPUTED, "quantile_cont(CAST({c} AS DOUBLE), 0.5)")}, {flags(NULLED)} FROM listing'),
        "mean_impute": (impute_by("mean", IMPUTED), WITH + f' SELECT {KEY}, {coalesced(IMPUTED, "avg({c})")} FROM listing'),
        "most_frequent_impute": (impute_by("most_frequent", ["ParkingSpots", "Restrooms", "HeatingType"]), WITH + f""" SELECT {KEY},
 {", ".join(f'CAST(coalesce({c}, {mode_of(c)}) AS DOUBLE) AS {c}' for c in ("ParkingSpots", "Restrooms"))}, coalesce(HeatingType, {mode_of("HeatingType")}) AS HeatingType FROM listing"""),
        "constant_impute": (impute_by("constant", WORDS, fill_value=clean.MISSING), WITH + f""" SELECT {KEY}, {", ".join(f"coalesce({c}, '__MISSING__') AS {c}" for c in WORDS)} FROM listing"""),
        "prefill": (prefilled, WITH + f" SELECT {KEY}, coalesce(ParkingSpots, 0) AS ParkingSpots, coalesce(HeatingType, 'none') AS HeatingType, {rs('coalesce(PlotSize, 0)', 'PlotSize')} FROM listing"),
        "all_null_prefill": (all_null, WITH + f" SELECT {KEY}, ParkingSpots, 0.0e0 AS GoneNumber, '__ALLNAN__' AS GoneText FROM listing"),
        "collapse_rare": (collapse, fitted + f" SELECT {KEY}, {rare_case('BuildingStyle')} AS BuildingStyle, {rare_case('ExteriorCovering1')} AS ExteriorCovering1 FROM listing"),
        "clean_missing": (clean_missing, fitted + f""" SELECT {KEY}, CAST(coalesce(ParkingSpots, 0) AS DOUBLE) AS ParkingSpots,
 {rs("coalesce(PlotSize, (SELECT quantile_cont(CAST(PlotSize AS DOUBLE), 0.5) FROM fitted))", "PlotSize")}, 0.0e0 AS GoneNumber,
 {rare_case("BuildingStyle")} AS BuildingStyle, coalesce(HeatingType, '__MISSING__') AS HeatingType,
 0 AS "ParkingSpots_missing", CAST(PlotSize IS NULL AS INT) AS "PlotSize_missing", 0 AS "GoneNumber_missing" FROM listing"""),
        "outlier_bounds_iqr": (bounds("iqr", 3.0), WITH + f""", b AS ({per_column_sql(BOUNDED, {"q1": "quantile_cont(CAST({c} AS DOUBLE), 0.25)", "q3": "quantile_cont(CAST({c} AS DOUBLE), 0.75)"})})
 SELECT "column", {rs("q1 - 3 * (q3 - q1)", "lower")}, {rs("q3 + 3 * (q3 - q1)", "upper")} FROM b"""),
        "outlier_bounds_zscore": (bounds("zscore", 3.0), WITH + f""", b AS ({per_column_sql(BOUNDED, {"m": "avg({c})", "s": "stddev_samp({c})"})})
 SELECT "column", {rs("m - 3 * s", "lower")}, {rs("m + 3 * s", "upper")} FROM b"""),
        "outlier_clip": (apply_bounds("clip"), bounds_sql("clip")),
        "outlier_nan": (apply_bounds("nan"), bounds_sql("nan")),
        "outlier_remove": (apply_bounds("remove"), bounds_sql("remove")),
        "outlier_info": (outlier_info, info_sql()),
        "outlier_info_events": (outlier_events, f"""WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
 f AS (SELECT q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM b)
 SELECT 'value' AS "column", {rs("min(lo)", "lower")}, {rs("min(hi)", "upper")}, count(*) FILTER (value < lo) AS n_below, count(*) FILTER (value > hi) AS n_above,
 count(*) FILTER (value < lo OR value > hi) AS n_total, {rs("count(*) FILTER (value < lo OR value > hi) * 100.0e0 / count(*)", "pct_outliers")} FROM events, f"""),
        "frequency_encode": (frequency, WITH + f", fitted AS ({TRAIN} AND RoofType > '2'), " + ", ".join(
            f"m{i} AS (SELECT coalesce({c}, 'nan') AS v, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fitted) AS s FROM fitted GROUP BY 1)" for i, c in enumerate(FREQUENT))
            + f" SELECT {KEY}, " + ", ".join(rs(f"coalesce(m{i}.s, 0)", f"FE__{c}") for i, c in enumerate(FREQUENT)) + " FROM listing"
            + "".join(f" LEFT JOIN m{i} ON coalesce({c}, 'nan') = m{i}.v" for i, c in enumerate(FREQUENT))),
        "frequency_encode_events": (frequency_events, f"""SELECT event_id, {rs('CAST(count(*) OVER (PARTITION BY event_type) AS DOUBLE) / count(*) OVER ()', 'FE__event_type')} FROM events"""),
        "target_encode": (target(False, ENCODED), target_sql(ENCODED, False)),
        "target_encode_null_prior": (target(True, ["HeatingType", "ZoningClassification"]), target_sql(["HeatingType", "ZoningClassification"], True)),
        "target_encode_documents": (target_documents, "WITH f AS (SELECT source, lang, quality FROM documents JOIN labels USING (doc_id)), "
            + "p AS (SELECT avg(quality) AS p1, 1 - avg(quality) AS p0 FROM f), "
            + ", ".join(f"m_{c} AS (SELECT {c} AS v, count(*) AS n, sum(quality) AS n1, sum(1 - quality) AS n0 FROM f GROUP BY 1)" for c in ("source", "lang"))
            + " SELECT doc_id, " + ", ".join(rs(f"coalesce((m_{c}.n{k} + 10.0e0 * p{k}) / (m_{c}.n + 10.0e0), p{k})", f"TE__{c}__p{k}") for c in ("source", "lang") for k in (0, 1))
            + " FROM documents CROSS JOIN p LEFT JOIN m_source ON source = m_source.v LEFT JOIN m_lang ON lang = m_lang.v"),
        "mean_target_encode": (mean_target, fitted + ", " + ", ".join(f"m_{c} AS (SELECT {c} AS v, avg({LABEL}) AS m FROM fitted WHERE {c} IS NOT NULL GROUP BY 1)" for c in ("HeatingType", "BuildingStyle"))
            + f" SELECT {KEY}, " + ", ".join(rs(f"coalesce(m_{c}.m, (SELECT avg({LABEL}) FROM fitted))", f"{c}_te") for c in ("HeatingType", "BuildingStyle"))
            + " FROM listing LEFT JOIN m_HeatingType ON HeatingType = m_HeatingType.v LEFT JOIN m_BuildingStyle ON BuildingStyle = m_BuildingStyle.v"),
        "target_encode_oof": (target_oof, oof_sql()),
        "one_hot_wide": (one_hot_wide, """SELECT CAST(row_number() OVER (ORDER BY CAST(l_orderkey AS VARCHAR)) - 1 AS INT) AS slot, count(*) AS n
 FROM lineitem GROUP BY l_orderkey"""),
        "one_hot": (one_hot, one_hot_sql()),
        "ordinal_encode": (ordinal, WITH + ", " + ", ".join(f"m{i} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {c} AS v FROM listing WHERE {c} IS NOT NULL))" for i, c in enumerate(WORDS))
            + f" SELECT {KEY}, " + ", ".join(f"CAST(m{i}.code AS INT) AS {c}" for i, c in enumerate(WORDS)) + " FROM listing"
            + "".join(f" LEFT JOIN m{i} ON {c} = m{i}.v" for i, c in enumerate(WORDS))),
        "mode_impute": (mode_impute, WITH + f" SELECT {KEY}, coalesce(HeatingType, {mode_of('HeatingType')}) AS HeatingType, {zoned}, coalesce(Proximity2, {mode_of('Proximity2')}) AS Proximity2, coalesce(Restrooms, 0) AS Restrooms FROM listing"),
        "standard_scale": (scaled(scale.fit_standard), scaled_sql('avg("{c}")', 'stddev_pop("{c}")')),
        "robust_scale": (scaled(scale.fit_robust), scaled_sql('quantile_cont("{c}", 0.5)', '(quantile_cont("{c}", 0.75) - quantile_cont("{c}", 0.25))')),
        "group_stats_fit": (stats, stats_sql()),
        "group_zscore": (relative("ZScore"), group_sql("ZScore")),
        "group_relshift": (relative("RelShift"), group_sql("RelShift")),
        "knn_impute": (knn("uniform"), knn_sql(5, False)),
        "knn_impute_distance": (knn("distance"), knn_sql(5, True)),
        "build_features_knn": (features_by_neighbours, features_by_neighbours_sql()),
        "knn_impute_listing": (listing_by_neighbours, WITH + f""" SELECT {KEY}, {", ".join(rs(f'CAST("{c}" AS DOUBLE)', c) for c in NUMERIC)},
 {flags(NUMERIC)}, true AS inside FROM listing"""),
    }


