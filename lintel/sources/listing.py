"""The `listing` table: labelled building rows over the order tables, with nulls put in."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.session import spread

KEY = "listing_id"
LABEL = "OfficeCategory"
CLASSES = [0, 1, 2, 3, 4]

BODY = """
SELECT
 ((((l.l_orderkey*100000+l.l_partkey)*10000+l.l_suppkey)*10+l.l_linenumber)*64+CAST(floor(l.l_quantity) AS BIGINT)) AS listing_id,
 CAST(year(o.o_orderdate) AS INT) AS YearListed, CAST(month(o.o_orderdate) AS INT) AS MonthListed,
 CASE WHEN l.l_partkey % 17 = 0 THEN NULL ELSE 1890 + l.l_partkey % 110 END AS ConstructionYear,
 CASE WHEN l.l_linenumber = 7 OR l.l_partkey % 17 = 0 THEN NULL ELSE 1890 + l.l_partkey % 110 + l.l_suppkey % 40 END AS RenovationYear,
 CASE WHEN l.l_orderkey % 23 = 0 THEN NULL ELSE l.l_extendedprice / 100 END AS GroundFloorArea,
 CASE WHEN l.l_orderkey % 19 = 0 THEN NULL ELSE l.l_quantity * 10 END AS UpperFloorArea,
 CASE WHEN l.l_partkey % 5 = 0 THEN NULL WHEN l.l_partkey % 5 = 1 THEN 0.0e0 ELSE p.p_retailprice END AS BasementArea,
 CASE WHEN l.l_suppkey % 11 = 0 THEN NULL ELSE p.p_size * 10 END AS FinishedBasementArea1,
 CASE WHEN l.l_suppkey % 7 = 0 THEN NULL ELSE p.p_size * 5 END AS FinishedBasementArea2,
 CASE WHEN l.l_linenumber = 3 THEN NULL ELSE l.l_quantity * 3 END AS UnfinishedBasementArea,
 l.l_extendedprice / 150 AS OfficeSpace,
 CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_totalprice / 50 END AS PlotSize,
 CAST(l.l_quantity AS INT) % 12 AS TotalRooms,
 CASE WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_linenumber - 1 END AS ParkingSpots,
 p.p_size % 6 AS MeetingRooms,
 CASE WHEN p.p_size % 10 = 0 THEN NULL ELSE p.p_size % 4 END AS Restrooms,
 1 + l.l_partkey % 10 AS BuildingGrade, 1 + l.l_suppkey % 9 AS BuildingCondition,
 1 + l.l_partkey % 5 AS ExteriorQuality, 1 + l.l_suppkey % 5 AS ExteriorCondition,
 CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE 1 + l.l_partkey % 4 END AS BasementQuality,
 CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE 1 + l.l_suppkey % 4 END AS BasementCondition,
 l.l_linenumber % 5 AS BasementExposure,
 CASE WHEN l.l_partkey % 6 = 0 THEN 'n/a' ELSE CAST(l.l_partkey % 6 AS STRING) END AS Proximity1,
 CASE WHEN l.l_suppkey % 8 = 0 THEN NULL ELSE CAST(l.l_suppkey % 8 AS STRING) END AS Proximity2,
 CASE WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE p.p_brand END AS ZoningClassification,
 p.p_type AS BuildingType, p.p_name AS BuildingStyle,
 CASE WHEN l.l_linenumber = 6 THEN NULL ELSE l.l_returnflag END AS HeatingType,
 o.o_orderpriority AS RoofType, p.p_brand AS ExteriorCovering1, l.l_linestatus AS FoundationType,
 CASE l.l_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE o.o_orderstatus END AS ConferenceRoomQuality,
 CAST(floor((l.l_quantity + l.l_tax*100 - 1) / 12) AS INT) AS OfficeCategory
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey
"""

#: The key as the text above has it, and as Spark works it out: the same number, which beyond the largest BIGINT (orders from 14 million on)
#: goes on from the smallest, where a checked product would end the job.
KEY_TEXT = "((((l.l_orderkey*100000+l.l_partkey)*10000+l.l_suppkey)*10+l.l_linenumber)*64+CAST(floor(l.l_quantity) AS BIGINT))"
KEY_WRAPPED = "(shiftleft(((l.l_orderkey*100000+l.l_partkey)*10000+l.l_suppkey)*10+l.l_linenumber, 6)+CAST(floor(l.l_quantity) AS BIGINT))"

# Columns by kind, in natural order.
NUMERIC = [
    "YearListed", "MonthListed", "ConstructionYear", "RenovationYear",
    "GroundFloorArea", "UpperFloorArea", "BasementArea",
    "FinishedBasementArea1", "FinishedBasementArea2", "UnfinishedBasementArea",
    "OfficeSpace", "PlotSize", "TotalRooms", "ParkingSpots", "MeetingRooms", "Restrooms",
    "BuildingGrade", "BuildingCondition", "ExteriorQuality", "ExteriorCondition",
    "BasementQuality", "BasementCondition", "BasementExposure",
]
TEXT = [
    "Proximity1", "Proximity2", "ZoningClassification", "BuildingType", "BuildingStyle",
    "HeatingType", "RoofType", "ExteriorCovering1", "FoundationType", "ConferenceRoomQuality",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def listing(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The listing rows; the joins are equi-joins on keys and Catalyst prunes unused columns."""
    rows = spark.sql(
        BODY.replace(KEY_TEXT, KEY_WRAPPED),
        lineitem=spread(table(spark, sf_dir, "lineitem"), "l_orderkey"),
        orders=table(spark, sf_dir, "orders"),
        part=table(spark, sf_dir, "part"),
    )
    return rows.select(*columns) if columns else rows


def numeric_rows(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Key, label and numeric columns as doubles."""
    names = names or tuple(NUMERIC)
    rows = listing(spark, sf_dir)
    return rows.select(KEY, LABEL, *[F.col(c).cast("double").alias(c) for c in names])


def listing_cte() -> str:
    """The same rows as a common table expression for a second engine."""
    return "listing AS (" + BODY.format(lineitem="lineitem", orders="orders", part="part") + ")"
