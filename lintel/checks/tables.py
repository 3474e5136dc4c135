"""Sources, projections, filters, joins, set operations, splits."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.checks.common import KEY, LABEL, WITH, ls, rounded, rs
from lintel.functions.derived import ensure_derived
from lintel.functions.nullsafe import blank_or_null_flag, missing_flag, to_category, to_num
from lintel.operators import ranking, schema
from lintel.operators.state import State, lookup
from lintel.plans.features import DROP_POLICIES
from lintel.session import ensure_checkpoint_dir
from lintel.sources import tables as src
from lintel.sources.listing import NUMERIC, TEXT, listing, table

PART_CSV = "p_partkey BIGINT, p_brand STRING, p_size INT, p_retailprice DOUBLE"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a sink below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/lintel-{name}-{os.urandom(6).hex()}"


def read_csv_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table written with NA texts in it, read back typed."""
    path = scratch(spark, "csv")
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 7 == 0, "NA").when(F.col("p_partkey") % 7 == 1, "null")
        .otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_partkey") % 5 == 0, "N/A").otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.when(F.col("p_partkey") % 3 == 0, "NaN").otherwise(F.col("p_retailprice").cast("string")).alias("p_retailprice"),
    )
    part.write.option("header", True).csv(path)
    return src.read_table(spark, path, PART_CSV, "csv")


def read_csv_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """A file whose columns stand in another order than the schema's."""
    path = scratch(spark, "csv")
    table(spark, sf, "part").select("p_retailprice", "p_size", "p_brand", "p_partkey").write.option("header", True).csv(path)
    return rounded(src.read_table(spark, path, PART_CSV, "csv"))


def read_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "csv")
    customer = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 == 0, "NA").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
    )
    customer.write.option("header", True).csv(path)
    return src.read_table(spark, path, fmt="csv")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "BuildingGrade")
    return src.number_predictions(rows.withColumn("prediction", F.col("BuildingGrade") % 5), KEY)


def written_predictions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "predictions")
    rows = listing(spark, sf, KEY, "BuildingGrade")
    src.write_predictions(rows.withColumn("prediction", F.col("BuildingGrade") % 5), KEY, path)
    return spark.read.schema(f"Id BIGINT, {LABEL} INT").option("header", True).csv(path)


def ranked_list(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "ranked")
    stats = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    src.write_ranked_list(stats, "value", "o_orderpriority", path)
    return spark.read.schema("o_orderpriority STRING, value DOUBLE").option("header", True).csv(path)


def split_target(spark: SparkSession, sf: str) -> DataFrame:
    features, label = src.split_target(listing(spark, sf), LABEL)
    return label.groupBy(LABEL).agg(F.count("*").alias("n"), F.lit(len(features.columns)).alias("n_features"))


def numbers(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf)
    return rows.select(KEY, *[to_num(rows, c).alias(c) for c in ("Proximity1", "Proximity2", "YearListed", "Absent")])


def metric_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Three feature-metric tables over parts, each lacking some of them."""
    part = table(spark, sf, "part").withColumn("feature", F.concat(F.lit("f"), F.col("p_partkey").cast("string")))
    return {
        "perm_importance": part.where("p_size % 5 <> 0").select("feature", (F.col("p_size") / 1000.0).alias("value")),
        "leak_score": part.where("p_size % 3 <> 0").select("feature", (F.col("p_size") / 100.0).alias("value")),
        "variance": part.where("p_size % 7 <> 0").select("feature", (F.col("p_retailprice") * F.col("p_size")).alias("value")),
    }


METRICS_SQL = """WITH m AS (SELECT 'f' || CAST(p_partkey AS VARCHAR) AS feature,
 CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS DOUBLE) / 1000.0 ELSE 0 END AS perm_importance,
 CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS DOUBLE) / 100.0 ELSE 0 END AS leak_score,
 CASE WHEN p_size % 7 <> 0 THEN p_retailprice * p_size ELSE 0 END AS variance
 FROM part WHERE p_size % 5 <> 0 OR p_size % 3 <> 0 OR p_size % 7 <> 0)"""


def merged_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return schema.merge_feature_metrics(metric_tables(spark, sf))


def dropped(spark: SparkSession, sf: str) -> DataFrame:
    merged = merged_metrics(spark, sf)
    return schema.dropped_features(merged, schema.keep_features(merged))


def bounded_rows(spark: SparkSession, sf: str) -> DataFrame:
    from lintel.operators.clean import outlier_filter

    rows = listing(spark, sf, KEY, "PlotSize", "UpperFloorArea", "BuildingGrade")
    return outlier_filter(rows, {"PlotSize": (1000.0, 5000.0), "UpperFloorArea": (50.0, 400.0)})


def label_join(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = docs.select("doc_id", "source").join(labels.select("doc_id", "quality"), "doc_id")
    return rounded(rows.groupBy("source").agg(F.count("*").alias("n"), F.avg("quality").alias("mean_quality")))


def seen_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts per brand fitted on even years, looked up on all rows; null is a key."""
    rows = listing(spark, sf, KEY, "YearListed", "ZoningClassification")
    fitted = rows.where("YearListed % 2 = 0 AND (ZoningClassification IS NULL OR ZoningClassification > 'Brand#2')")
    counts = State.of(fitted.groupBy("ZoningClassification").agg(F.count("*").alias("n")), count="n")
    on = {"ZoningClassification": "ZoningClassification"}
    return lookup(rows, counts, on, {"n": "n"}, {"n": 0}).select(KEY, "n")


def domain_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, KEY, "YearListed", "PlotSize")
    return rounded(schema.domain_union(rows.where("YearListed < 1996"), rows.where("YearListed >= 1996")))


def category_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = listing(spark, sf, "YearListed", "HeatingType")
    return schema.category_union(rows.where("YearListed < 1996"), rows.where("YearListed >= 1996"), "HeatingType")


def split(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.stratified_split(listing(spark, sf, KEY, LABEL), LABEL, KEY, 0.2, 42)


def folds(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.stratified_folds(listing(spark, sf, KEY, LABEL), LABEL, KEY, 5, 42)


def one_fold(spark: SparkSession, sf: str) -> DataFrame:
    train, valid = ranking.fold_rows(folds(spark, sf), 2)
    marked = train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))
    return marked.groupBy("part", LABEL).agg(F.count("*").alias("n"), F.sum(F.col(KEY) % 1_000_003).alias("key_sum"))


RANKED = WITH + f""", ranked AS (SELECT {KEY}, {LABEL}, row_number() OVER (
 PARTITION BY {LABEL} ORDER BY md5('42:' || CAST({KEY} AS VARCHAR)), {KEY}) AS k,
 count(*) OVER (PARTITION BY {LABEL}) AS n FROM listing)"""


def entries() -> dict:
    return {
        "listing": (lambda s, d: rounded(listing(s, d)), WITH + f""" SELECT {KEY}, {LABEL},
 {", ".join(rs(c, c) if c in ("GroundFloorArea", "UpperFloorArea", "BasementArea", "UnfinishedBasementArea", "OfficeSpace", "PlotSize") else c for c in NUMERIC)},
 {", ".join(TEXT)} FROM listing"""),
        "read_table_csv": (read_csv_table, """SELECT p_partkey,
 CASE WHEN p_partkey % 7 NOT IN (0, 1) THEN p_brand END AS p_brand,
 CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS p_size,
 CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS p_retailprice FROM part"""),
        "read_table_reordered": (read_csv_reordered, f"SELECT p_partkey, p_brand, CAST(p_size AS INT) AS p_size, {rs('p_retailprice', 'p_retailprice')} FROM part"),
        "read_table_inferred": (read_csv_inferred, """SELECT c_custkey,
 CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer"""),
        "split_target": (split_target, WITH + f" SELECT {LABEL}, count(*) AS n, {len(NUMERIC + TEXT) + 1} AS n_features FROM listing GROUP BY 1"),
        "number_predictions": (predictions, WITH + f""" SELECT {KEY}, row_number() OVER (ORDER BY {KEY}) - 1 AS Id,
 CAST(BuildingGrade % 5 AS INT) AS {LABEL} FROM listing"""),
        "write_predictions": (written_predictions, WITH + f""" SELECT row_number() OVER (ORDER BY {KEY}) - 1 AS Id,
 CAST(BuildingGrade % 5 AS INT) AS {LABEL} FROM listing"""),
        "write_ranked_list": (ranked_list, "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1"),
        "preview": (lambda s, d: rounded(src.preview(listing(s, d), KEY, 20, 12)),
                    WITH + f""" SELECT {KEY}, YearListed, MonthListed, ConstructionYear, RenovationYear,
 {rs("GroundFloorArea", "GroundFloorArea")}, {rs("UpperFloorArea", "UpperFloorArea")}, {rs("BasementArea", "BasementArea")},
 FinishedBasementArea1, FinishedBasementArea2, {rs("UnfinishedBasementArea", "UnfinishedBasementArea")},
 {rs("OfficeSpace", "OfficeSpace")} FROM listing ORDER BY {KEY} LIMIT 20"""),
        "infer_column_types": (lambda s, d: schema.kinds_table(listing(s, d), [LABEL]), WITH + f""" SELECT "column",
 CASE WHEN kind = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS kind
 FROM (SELECT UNNEST([{", ".join("{'column': '%s', 'kind': typeof(%s)}" % (c, c) for c in [KEY, *NUMERIC, *TEXT])}], recursive := true)
 FROM (SELECT * FROM listing ORDER BY {KEY} LIMIT 1))"""),
        "drop_policy_long": (
            lambda s, d: schema.drop_policy_columns(listing(s, d), DROP_POLICIES["long"], [KEY, LABEL]),
            WITH + " SELECT " + ls([c for c in [KEY, LABEL, *NUMERIC, *TEXT] if c not in DROP_POLICIES["long"]]) + " FROM listing",
        ),
        "drop_policy_columns": (
            lambda s, d: rounded(schema.drop_policy_columns(listing(s, d), [*TEXT, "PlotSize", *NUMERIC[12:]], [KEY, LABEL])),
            WITH + f""" SELECT {KEY}, {LABEL}, {", ".join(rs(c, c) if c.endswith("Area") or c == "OfficeSpace" else c for c in NUMERIC[:11])} FROM listing"""),
        "to_num": (numbers, WITH + f""" SELECT {KEY}, try_cast(Proximity1 AS DOUBLE) AS Proximity1,
 try_cast(Proximity2 AS DOUBLE) AS Proximity2, CAST(YearListed AS DOUBLE) AS YearListed, CAST(NULL AS DOUBLE) AS Absent FROM listing"""),
        "to_category": (lambda s, d: listing(s, d).select(KEY, *[to_category(c).alias(c) for c in ("HeatingType", "ZoningClassification", "BuildingGrade")]),
                        WITH + f""" SELECT {KEY}, coalesce(HeatingType, 'nan') AS HeatingType,
 coalesce(ZoningClassification, 'nan') AS ZoningClassification, CAST(BuildingGrade AS VARCHAR) AS BuildingGrade FROM listing"""),
        "outlier_filter": (lambda s, d: rounded(bounded_rows(s, d)), WITH + f""" SELECT {KEY}, {rs("PlotSize", "PlotSize")},
 {rs("UpperFloorArea", "UpperFloorArea")}, BuildingGrade FROM listing
 WHERE PlotSize BETWEEN 1000 AND 5000 AND UpperFloorArea BETWEEN 50 AND 400"""),
        "keep_features": (lambda s, d: rounded(schema.keep_features(merged_metrics(s, d))), METRICS_SQL + f""" SELECT feature,
 {rs("perm_importance", "perm_importance")}, {rs("leak_score", "leak_score")}, {rs("variance", "variance")} FROM m
 WHERE perm_importance > 0.005 AND leak_score < CAST(0.3 AS DOUBLE) AND variance BETWEEN 0.001 AND 10000000"""),
        "merge_feature_metrics": (lambda s, d: rounded(merged_metrics(s, d)), METRICS_SQL + f""" SELECT feature,
 {rs("perm_importance", "perm_importance")}, {rs("leak_score", "leak_score")}, {rs("variance", "variance")} FROM m"""),
        "dropped_features": (dropped, METRICS_SQL + """ SELECT feature FROM m
 WHERE NOT (perm_importance > 0.005 AND leak_score < CAST(0.3 AS DOUBLE) AND variance BETWEEN 0.001 AND 10000000)"""),
        "ensure_derived": (
            lambda s, d: rounded(ensure_derived(listing(s, d).withColumn("BuildingAge", F.lit(7.0))).select(
                KEY, "TotalLivingArea", "BuildingAge", "OverallQuality")),
            WITH + f""" SELECT {KEY}, {rs("GroundFloorArea + UpperFloorArea", "TotalLivingArea")},
 CAST(7.0 AS DOUBLE) AS BuildingAge, CAST(BuildingGrade * BuildingCondition AS DOUBLE) AS OverallQuality FROM listing"""),
        "blank_or_null_flag": (lambda s, d: (lambda t: t.select(KEY, *[blank_or_null_flag(t, c).alias(f"{c}_blank") for c in ("ConferenceRoomQuality", "HeatingType", "Absent")]))(listing(s, d)),
                               WITH + f""" SELECT {KEY},
 CASE WHEN ConferenceRoomQuality IS NULL OR regexp_full_match(ConferenceRoomQuality, '\\s*') THEN 1 ELSE 0 END AS "ConferenceRoomQuality_blank",
 CASE WHEN HeatingType IS NULL OR regexp_full_match(HeatingType, '\\s*') THEN 1 ELSE 0 END AS "HeatingType_blank",
 0 AS "Absent_blank" FROM listing"""),
        "missing_flag": (lambda s, d: listing(s, d).select(KEY, *[missing_flag(c) for c in ("PlotSize", "BasementArea", "HeatingType", "YearListed")]),
                         WITH + f" SELECT {KEY}, " + ", ".join(f'CAST({c} IS NULL AS INT) AS "{c}_missing"' for c in ("PlotSize", "BasementArea", "HeatingType", "YearListed")) + " FROM listing"),
        "lookup": (seen_lookup, WITH + f""", fitted AS (SELECT ZoningClassification AS z, count(*) AS n FROM listing
 WHERE YearListed % 2 = 0 AND (ZoningClassification IS NULL OR ZoningClassification > 'Brand#2') GROUP BY 1)
 SELECT {KEY}, coalesce(n, 0) AS n FROM listing LEFT JOIN fitted ON ZoningClassification IS NOT DISTINCT FROM z"""),
        "attach_target": (label_join, f"""SELECT source, count(*) AS n, {rs("avg(quality)", "mean_quality")}
 FROM documents JOIN labels USING (doc_id) GROUP BY source"""),
        "domain_union": (domain_union, WITH + f""" SELECT {KEY}, YearListed, {rs("PlotSize", "PlotSize")},
 CASE WHEN YearListed < 1996 THEN 0 ELSE 1 END AS domain FROM listing"""),
        "category_union": (category_union, WITH + " SELECT DISTINCT HeatingType FROM listing"),
        "stratified_split": (split, RANKED + f" SELECT {KEY}, {LABEL}, CASE WHEN k <= floor(n * CAST(0.2 AS DOUBLE)) THEN 1 ELSE 0 END AS is_valid FROM ranked"),
        "stratified_kfold": (folds, RANKED + f" SELECT {KEY}, {LABEL}, CAST((k - 1) % 5 AS INT) AS fold FROM ranked"),
        "fold_rows": (one_fold, RANKED + f""" SELECT CASE WHEN (k - 1) % 5 = 2 THEN 'valid' ELSE 'train' END AS part, {LABEL},
 count(*) AS n, CAST(sum({KEY} % 1000003) AS BIGINT) AS key_sum FROM ranked GROUP BY 1, 2"""),
    }


__all__ = ["entries", "ls", "scratch"]
