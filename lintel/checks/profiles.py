"""Profiles against SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.checks.common import KEY, LABEL, WITH, melt_sql, per_column_sql, rounded, rs
from lintel.operators import correlation as C
from lintel.operators import profile as P
from lintel.operators.quantiles import column_quantiles
from lintel.session import keep
from lintel.sources.listing import NUMERIC, TEXT, listing, numeric_rows, table

SHARE = "CAST({0} AS DOUBLE) / {1}"


def significant(col: Column) -> Column:
    """Twelve digits: means of large keys differ beyond them."""
    return F.when(col.isNotNull(), F.format_string("%.11e", col)).cast("double")


def as_rows(reports: dict[str, DataFrame]) -> DataFrame:
    """All reports as one table: a row for each report, line (the first column, if there are more lines than one) and measure."""
    parts = []
    for name, t in reports.items():
        line, measures = (F.lit(""), t.columns) if name == "basic_info" else (F.col(t.columns[0]).cast("string"), t.columns[1:])
        cells = F.array(*[F.struct(F.lit(m).alias("measure"), significant(F.col(m).cast("double")).alias("value")) for m in measures])
        parts.append(t.select(F.lit(name).alias("report"), line.alias("line"), F.inline(cells)))
    return reduce(DataFrame.unionByName, parts)


def rows_sql(reports: dict[str, tuple[str, list[str]]]) -> str:
    """The same of SQL statements: name -> statement, and its columns, the line's first."""
    parts = []
    for name, (sql, columns) in reports.items():
        line, measures = ("''", columns) if name == "basic_info" else (f'CAST("{columns[0]}" AS VARCHAR)', columns[1:])
        cells = ", ".join(f"{{'measure': '{m}', 'value': CAST(printf('%.11e', CAST(\"{m}\" AS DOUBLE)) AS DOUBLE)}}" for m in measures)
        parts.append(f"SELECT '{name}' AS report, {line} AS line, UNNEST([{cells}], recursive := true) FROM ({sql})")
    return " UNION ALL ".join(parts)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


COUNTS = WITH + f""", long AS ({melt_sql(TEXT, "VARCHAR")}),
counts AS (SELECT "column", "value", count(*) AS n FROM long GROUP BY 1, 2)"""

QUARTILES = {f"q{int(p * 100)}": f"round(quantile_cont(CAST({{c}} AS DOUBLE), {p}), 6) + 0.0" for p in (0.25, 0.5, 0.75)}



def mutual_sql(bins: int = 10) -> str:
    cuts = ", ".join(
        f"list_distinct(quantile_cont(CAST(\"{c}\" AS DOUBLE), [{', '.join(f'{i}/{bins}.0e0' for i in range(1, bins))}])) AS \"{c}\"" for c in NUMERIC
    )
    binned = ", ".join(
        f"CASE WHEN l.\"{c}\" IS NOT NULL THEN len(list_filter(q.\"{c}\", lambda e: CAST(l.\"{c}\" AS DOUBLE) > e)) END AS \"{c}\"" for c in NUMERIC
    )
    return WITH + f""", cuts AS (SELECT {cuts} FROM listing),
binned AS (SELECT l.{LABEL}, {binned} FROM listing l, cuts q),
long AS ({melt_sql(NUMERIC, "VARCHAR", [LABEL], "binned")}),
joint AS (SELECT "column", "value", {LABEL}, count(*) AS n FROM long GROUP BY ALL),
sums AS (SELECT *, sum(n) OVER (PARTITION BY "column", "value") AS nv, sum(n) OVER (PARTITION BY "column", {LABEL}) AS ny,
 sum(n) OVER (PARTITION BY "column") AS total FROM joint)
SELECT "column", {rs("sum(CAST(n AS DOUBLE) / total * ln(CAST(n AS DOUBLE) * total / (CAST(nv AS DOUBLE) * ny)))", "mutual_information")}
FROM sums GROUP BY 1"""


def corr_sql(pairs: list[tuple[str, str]], names: tuple[str, str] = ("feature1", "feature2")) -> str:
    cells = ", ".join(
        f"{{'{names[0]}': '{a}', '{names[1]}': '{b}', 'correlation': round(corr(CAST(\"{a}\" AS DOUBLE), CAST(\"{b}\" AS DOUBLE)), 6) + 0.0}}"
        for a, b in pairs
    )
    return f"SELECT UNNEST([{cells}], recursive := true) FROM listing"


PAIRS = [(NUMERIC[j], NUMERIC[i]) for i in range(len(NUMERIC)) for j in range(i + 1, len(NUMERIC))]
NAMED = WITH + ", "


def neighbouring(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of values that lie one or two doubles apart, searched with few candidates."""
    rows = table(spark, sf, "orders").select(*[F.expr(f"CAST({e} AS DOUBLE)").alias(c) for c, e in CLOSE.items()])
    got = column_quantiles(rows, list(CLOSE), [0.1, 0.6, 0.9], most=10, slices=862)
    return spark.createDataFrame([(c, *q) for c, q in got.items()], "`column` string, q1 double, q2 double, q3 double")


# Neighbouring doubles, in both engines.
CLOSE = {
    "a": "CASE WHEN o_orderkey % 3 = 0 THEN 0.3e0 ELSE 0.1e0 + 0.2e0 END",
    "b": "0.00095e0 + (o_orderkey % 4) * 1.0e-19",
    "c": "1.0e300 * (o_orderkey % 2) + 1.0e0",
}
CLOSE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", quantile_cont(CAST({e} AS DOUBLE), 0.1) AS q1, quantile_cont(CAST({e} AS DOUBLE), 0.6) AS q2, quantile_cont(CAST({e} AS DOUBLE), 0.9) AS q3 FROM orders"""
    for c, e in CLOSE.items()
)

MISSING_SQL = WITH + f""" SELECT "column", n_missing,
 {rs("n_missing * 100.0e0 / n_rows", "pct_missing")} FROM ({per_column_sql([KEY, *NUMERIC, *TEXT, LABEL], {"n_missing": "count(*) FILTER ({c} IS NULL)", "n_rows": "count(*)"})})
 WHERE n_missing > 0"""


TARGET_SQL = WITH + f""" SELECT {LABEL}, count(*) AS n, {rs("count(*) * 100.0e0 / (SELECT count(*) FROM listing)", "pct")} FROM listing GROUP BY 1"""
CARDINALITY_SQL = COUNTS + ' SELECT "column", count(*) AS n_distinct FROM counts GROUP BY 1'
BASIC_SQL = WITH + f" SELECT count(*) AS n_rows, {len(NUMERIC + TEXT) + 2} AS n_columns, {len(NUMERIC) + 2} AS n_numeric, {len(TEXT)} AS n_categorical FROM listing"
REPORT_BASIC = ["n_rows", "n_columns", "n_numeric", "n_categorical"]
DESCRIBED = ["n", "mean", "std", "min", "max", "q25", "q50", "q75"]


def describe_sql(columns: list[str]) -> str:
    return WITH + " " + per_column_sql(columns, {
        "n": "count({c})", "mean": "round(avg({c}), 6) + 0.0", "std": "round(stddev_samp({c}), 6) + 0.0",
        "min": "round(min(CAST({c} AS DOUBLE)), 6) + 0.0", "max": "round(max(CAST({c} AS DOUBLE)), 6) + 0.0", **QUARTILES})


def eda_sql() -> str:
    return rows_sql({
        "basic_info": (BASIC_SQL, REPORT_BASIC), "missing": (MISSING_SQL, ["column", "n_missing", "pct_missing"]), "target": (TARGET_SQL, [LABEL, "n", "pct"]),
        "cardinality": (CARDINALITY_SQL, ["column", "n_distinct"]), "numeric": (describe_sql([KEY, *NUMERIC]), ["column", *DESCRIBED]),
    })


def entries() -> dict:
    label_gap = "abs(share_missing - share_present)"
    return {
        "missing_profile": (lambda s, d: rounded(P.missing_profile(listing(s, d))), MISSING_SQL),
        "quantiles_neighbouring_values": (neighbouring, CLOSE_SQL),
        "target_distribution": (lambda s, d: rounded(P.target_distribution(listing(s, d), LABEL)), TARGET_SQL),
        "class_prior": (lambda s, d: rounded(P.class_prior(listing(s, d), LABEL)), WITH + f""" SELECT {LABEL},
 {rs("CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM listing)", "prior")} FROM listing GROUP BY 1"""),
        "cardinality": (lambda s, d: P.cardinality(listing(s, d), TEXT), CARDINALITY_SQL),
        "numeric_describe": (lambda s, d: rounded(P.numeric_describe(keep(numeric_rows(s, d)), NUMERIC)), describe_sql(NUMERIC)),
        "numeric_describe_events": (lambda s, d: rounded(P.numeric_describe(events(s, d), ["value"])), per_column_sql(["value"], {
            "n": "count({c})", "mean": "round(avg({c}), 6) + 0.0", "std": "round(stddev_samp({c}), 6) + 0.0",
            "min": "round(min({c}), 6) + 0.0", "max": "round(max({c}), 6) + 0.0", **QUARTILES}, "events")),
        "basic_info": (lambda s, d: P.basic_info(listing(s, d)), BASIC_SQL),
        "eda_report": (lambda s, d: rounded(as_rows(P.eda_report(keep(listing(s, d)), LABEL))), eda_sql()),
        "value_shares": (lambda s, d: rounded(P.value_shares(listing(s, d), TEXT, 10)), COUNTS + """, placed AS (SELECT *,
 row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value" ASC NULLS FIRST) AS place, sum(n) OVER (PARTITION BY "column") AS total FROM counts)
 SELECT "column", "value", round(CAST(n AS DOUBLE) / total, 3) AS share, CAST(place AS INT) AS place FROM placed WHERE place <= 10"""),
        "category_counts": (lambda s, d: P.category_counts(listing(s, d), TEXT), COUNTS + ' SELECT "column", "value", n FROM counts WHERE "value" IS NOT NULL'),
        "category_counts_events": (lambda s, d: P.category_counts(events(s, d), ["event_type"]),
                                   """SELECT 'event_type' AS "column", event_type AS "value", count(*) AS n FROM events GROUP BY 2"""),
        "top_category": (lambda s, d: P.top_category(listing(s, d), TEXT), COUNTS + """ SELECT "column", "value", n FROM counts WHERE "value" IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value") = 1"""),
        "columns_with_nulls_top_category": (lambda s, d: rounded(P.nullable_top_category(listing(s, d), TEXT, 0.6)), COUNTS + f""", tops AS (SELECT *,
 row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value" ASC NULLS FIRST) AS place, sum(n) OVER (PARTITION BY "column") AS total,
 bool_or("value" IS NULL) OVER (PARTITION BY "column") AS has_null FROM counts)
 SELECT "column", "value" AS top_value, {rs("CAST(n AS DOUBLE) / total", "top_share")} FROM tops
 WHERE place = 1 AND has_null AND CAST(n AS DOUBLE) / total <= 0.6e0"""),
        "histogram": (lambda s, d: P.histogram(listing(s, d), NUMERIC, 10), WITH + f""", long AS ({melt_sql(NUMERIC, "DOUBLE")}),
 span AS (SELECT "column" AS c, min("value") AS lo, (max("value") - min("value")) / 10 AS w FROM long GROUP BY 1)
 SELECT "column", CAST(least(floor(("value" - lo) / w), 9) AS INT) AS bin, count(*) AS n FROM long JOIN span ON "column" = c
 WHERE "value" IS NOT NULL GROUP BY 1, 2"""),
        "missing_vs_target": (lambda s, d: rounded(P.missing_vs_target(listing(s, d), TEXT, LABEL)), WITH + f""", long AS ({melt_sql(TEXT, "VARCHAR", [LABEL])}),
 counts AS (SELECT "column", {LABEL}, CAST(count(*) FILTER ("value" IS NULL) AS DOUBLE) AS n1, CAST(count(*) FILTER ("value" IS NOT NULL) AS DOUBLE) AS n0 FROM long GROUP BY 1, 2),
 totals AS (SELECT "column" AS c, sum(n1) AS t1, sum(n0) AS t0 FROM counts GROUP BY 1 HAVING sum(n1) > 0 AND sum(n0) > 0),
 shares AS (SELECT "column", {LABEL}, n1 / t1 AS share_missing, n0 / t0 AS share_present FROM counts JOIN totals ON "column" = c)
 SELECT "column", {LABEL}, {rs("share_missing", "share_missing")}, {rs("share_present", "share_present")},
 {rs(f'max({label_gap}) OVER (PARTITION BY "column")', "max_diff")} FROM shares"""),
        "iqr_outlier_rate": (lambda s, d: rounded(P.iqr_outlier_rate(keep(numeric_rows(s, d)), NUMERIC, 0.3)), WITH + f""", long AS ({melt_sql(NUMERIC, "DOUBLE")}),
 q AS (SELECT "column" AS c, quantile_cont("value", 0.25) AS q1, quantile_cont("value", 0.75) AS q3 FROM long GROUP BY 1)
 SELECT "column", {rs('CAST(count(*) FILTER ("value" < q1 - 0.3e0 * (q3 - q1) OR "value" > q3 + 0.3e0 * (q3 - q1)) AS DOUBLE) / count(*)', "rate")}
 FROM long JOIN q ON "column" = c GROUP BY 1 HAVING CAST(count(*) FILTER ("value" < q1 - 0.3e0 * (q3 - q1) OR "value" > q3 + 0.3e0 * (q3 - q1)) AS DOUBLE) / count(*) > 0.01e0"""
                             .replace("GROUP BY 1 HAVING", 'GROUP BY "column" HAVING')),
        "zscore_outlier_counts": (lambda s, d: P.zscore_outlier_counts(numeric_rows(s, d), NUMERIC), WITH + f""", whole AS (SELECT {", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in NUMERIC)} FROM listing
 WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in NUMERIC)}),
 long AS ({melt_sql(NUMERIC, "DOUBLE", None, "whole")}),
 m AS (SELECT "column" AS c, avg("value") AS m, stddev_pop("value") AS s FROM long GROUP BY 1)
 SELECT "column", count(*) FILTER (s > 0 AND abs(("value" - m) / s) > 3) AS n_outliers FROM long JOIN m ON "column" = c GROUP BY 1"""),
        "zscore_outliers_customer": (lambda s, d: P.zscore_outlier_counts(table(s, d, "customer"), ["c_acctbal"], 1.5), """WITH m AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)
 SELECT 'c_acctbal' AS "column", count(*) FILTER (abs((c_acctbal - m) / s) > 1.5e0) AS n_outliers FROM customer, m"""),
        "correlation_matrix": (lambda s, d: rounded(C.correlations(numeric_rows(s, d), NUMERIC)), WITH + " " + corr_sql(PAIRS)),
        "target_correlation": (lambda s, d: rounded(P.target_correlation(numeric_rows(s, d), NUMERIC, LABEL)), WITH + f', t AS ({corr_sql([(c, LABEL) for c in NUMERIC])}) SELECT feature1 AS "column", correlation FROM t'),
        "redundant_pairs": (lambda s, d: rounded(C.redundant_pairs(numeric_rows(s, d), NUMERIC, 0.6)), WITH + f", t AS ({corr_sql(PAIRS)}) SELECT * FROM t WHERE abs(correlation) > 0.6e0"),
        "redundant_columns": (lambda s, d: C.redundant_columns(numeric_rows(s, d), NUMERIC, 0.6), WITH + f", t AS ({corr_sql(PAIRS)}) SELECT DISTINCT feature1 AS feature FROM t WHERE abs(correlation) > 0.6e0"),
        "variance_profile": (lambda s, d: rounded(P.variance_profile(numeric_rows(s, d), NUMERIC), digits=3), WITH + " " + per_column_sql(NUMERIC, {"variance": "round(var_samp({c}), 3) + 0.0"})),
        "low_variance_count": (lambda s, d: P.low_variance_count(numeric_rows(s, d).withColumn("flat", F.lit(1.0)), [*NUMERIC, "flat"]),
                               WITH + f""" SELECT count(*) FILTER (v <= 0.000001e0) AS n_low_variance FROM ({per_column_sql([*NUMERIC, "flat"], {"v": "var_samp({c})"}, "(SELECT *, 1.0e0 AS flat FROM listing)")})"""),
        "near_constant": (lambda s, d: rounded(P.near_constant(numeric_rows(s, d).withColumns({"flat": F.lit(1.0), "gone": F.lit(None).cast("double")}), [*NUMERIC, "flat", "gone"])),
                          WITH + f""" SELECT "column", {rs("v", "variance")} FROM ({per_column_sql([*NUMERIC, "flat", "gone"], {"v": "var_pop({c})"}, "(SELECT *, 1.0e0 AS flat, CAST(NULL AS DOUBLE) AS gone FROM listing)")})
 WHERE v IS NULL OR v <= 1e-12"""),
        "top_variance": (lambda s, d: rounded(P.top_variance(numeric_rows(s, d), NUMERIC, 8), digits=3), WITH + f""", t AS ({per_column_sql(NUMERIC, {"v": "var_pop({c})"})}),
 i AS (SELECT UNNEST([{", ".join(f"{{'c': '{c}', 'feature_index': {i}}}" for i, c in enumerate(NUMERIC))}], recursive := true))
 SELECT "column", {rs("v", "variance", 3)}, CAST(row_number() OVER (ORDER BY v DESC, "column") AS INT) AS position, feature_index
 FROM t JOIN i ON "column" = c ORDER BY v DESC, "column" LIMIT 8"""),
        "rank_desc": (lambda s, d: P.rank_desc(P.missing_profile(listing(s, d)).select("column", "n_missing"), "n_missing", "column", 10),
                      WITH + f""" SELECT "column", n_missing, CAST(row_number() OVER (ORDER BY n_missing DESC, "column") AS INT) AS position
 FROM ({per_column_sql([*NUMERIC, *TEXT], {"n_missing": "count(*) FILTER ({c} IS NULL)"})}) WHERE n_missing > 0 ORDER BY n_missing DESC, "column" LIMIT 10"""),
        "matrix_health": (lambda s, d: rounded(P.matrix_health(numeric_rows(s, d), NUMERIC)), WITH + f""", long AS ({melt_sql(NUMERIC, "DOUBLE")})
 SELECT count(*) // {len(NUMERIC)} AS n_rows, {len(NUMERIC)} AS n_columns, count(*) FILTER ("value" IS NULL) AS n_nan, count(*) FILTER (isinf("value")) AS n_inf,
 {rs('CAST(count(*) FILTER ("value" = 0) AS DOUBLE) / count(*)', "zero_share")} FROM long"""),
        "mutual_information": (lambda s, d: rounded(P.mutual_information(keep(numeric_rows(s, d)), NUMERIC, LABEL)), mutual_sql()),
    }
