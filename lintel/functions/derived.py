"""Derived building columns, as Column expressions over null-safe doubles.

The work is one projection in three layers, so a shared term (age, living area, quality) is
computed once per row and the whole catalogue stays inside one code-generated stage.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.functions.nullsafe import (
    bin_edges,
    clip,
    equal_width_edges,
    fill0,
    log1p0,
    product,
    safe_ratio,
    to_num,
)

# Input columns, in natural order.
INPUTS = [
    "YearListed", "MonthListed", "ConstructionYear", "RenovationYear",
    "GroundFloorArea", "UpperFloorArea", "BasementArea",
    "FinishedBasementArea1", "FinishedBasementArea2", "UnfinishedBasementArea",
    "OfficeSpace", "PlotSize", "TotalRooms", "ParkingSpots", "MeetingRooms", "Restrooms",
    "BuildingGrade", "BuildingCondition", "ExteriorQuality", "ExteriorCondition",
    "BasementQuality", "BasementCondition", "BasementExposure", "Proximity1", "Proximity2",
]

# Output columns, in natural order.
DERIVED = [
    "BuildingAge", "YearsSinceRenovation", "RenovationAge", "IsRenovated",
    "TotalLivingArea", "TotalBasementArea",
    "BasementFinishRatio", "OfficeSpaceRatio", "PlotCoverage", "RoomDensity", "ParkingPerArea",
    "HasParking", "BasementUtilization", "AmenityDensity", "RestroomPerRoom",
    "OverallQuality", "ExteriorScore", "BasementOverallScore", "ProximityScore",
    "SeasonListed", "ConstructionDecade", "PlotSize_binned", "BuildingAge_binned",
    "BuildingLifeStage", "RenovationEffectiveness", "SeasonalStrength",
    "QualityAreaProximity", "BasementEfficiency", "ValueDensity",
    "AgeQualityInteraction", "LogQualityArea",
    "RoomSizeAdequacy", "ParkingAdequacy", "RenovationNeed", "LandUtilization",
]

# Edges of the age bins and upper ages of the first four life stages.
AGE_EDGES = [0.0, 10.0, 25.0, 50.0, 100.0, 200.0]
LIFE_STAGE_UPPER = [5.0, 15.0, 30.0, 50.0]
PLOT_BINS = 5

_N = "__n_"
_SHARED = [
    "BuildingAge", "RenovationAge", "TotalLivingArea", "TotalBasementArea",
    "OverallQuality", "ProximityScore",
]


def n(name: str) -> Column:
    return F.col(_N + name)


def _not_negative(col: Column) -> Column:
    return F.when(col >= 0, col)


def building_age(listed: Column, built: Column) -> Column:
    return _not_negative(listed - built)


def total_basement(area: Column, parts: Iterable[Column]) -> Column:
    parts_sum = sum((fill0(p) for p in parts), F.lit(0.0))
    return F.coalesce(area, F.when(parts_sum > 0, parts_sum))


def life_stage(age: Column) -> Column:
    """Stages 1 to 5 by age; an unknown age is the middle stage."""
    stage = F.when(age.isNull(), 3.0)
    for i, upper in enumerate(LIFE_STAGE_UPPER, start=1):
        stage = stage.when(age <= upper, float(i))
    return stage.otherwise(5.0)


def season(month: Column) -> Column:
    return F.floor((month % 12) / 3).cast("double") + 1


def seasonal_strength(month: Column) -> Column:
    return F.abs(F.lit(6.0) - F.abs(month - 6)) / 6


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("double")


def fit_plot_edges(df: DataFrame, bins: int = PLOT_BINS) -> list[float] | None:
    """Edges of the equal-width plot-size bins, from the smallest and largest value."""
    size = to_num(df, "PlotSize")
    row = df.agg(F.min(size).alias("lo"), F.max(size).alias("hi")).first()
    if row.lo is None:
        return None
    return equal_width_edges(row.lo, row.hi, bins)


def _shared_terms() -> dict[str, Column]:
    return {
        "BuildingAge": building_age(n("YearListed"), n("ConstructionYear")),
        "RenovationAge": building_age(n("YearListed"), n("RenovationYear")),
        "TotalLivingArea": n("GroundFloorArea") + n("UpperFloorArea"),
        "TotalBasementArea": total_basement(
            n("BasementArea"),
            [n("FinishedBasementArea1"), n("FinishedBasementArea2"), n("UnfinishedBasementArea")],
        ),
        "OverallQuality": product(n("BuildingGrade"), n("BuildingCondition")),
        "ProximityScore": n("Proximity1") + n("Proximity2"),
    }


def _catalogue(plot_edges: list[float] | None, clipped: bool, plot_epsilon: float) -> dict[str, Column]:
    age, reno_age = F.col("BuildingAge"), F.col("RenovationAge")
    living, basement = F.col("TotalLivingArea"), F.col("TotalBasementArea")
    quality, proximity = F.col("OverallQuality"), F.col("ProximityScore")
    finished = fill0(n("FinishedBasementArea1")) + fill0(n("FinishedBasementArea2"))

    def bounded(col: Column, hi: float) -> Column:
        return clip(col, 0.0, hi) if clipped else col

    plot_log = log1p0(n("PlotSize") + plot_epsilon)
    plot_bin = bin_edges(n("PlotSize"), plot_edges) if plot_edges else F.lit(None).cast("double")
    renovation_gap = clip(age - reno_age - 20, 0.0, None)

    return {
        "YearsSinceRenovation": reno_age,
        "IsRenovated": (n("RenovationYear") > n("ConstructionYear")).cast("double"),
        "BasementFinishRatio": bounded(safe_ratio(finished, n("BasementArea")), 5),
        "OfficeSpaceRatio": bounded(safe_ratio(n("OfficeSpace"), living), 5),
        "PlotCoverage": bounded(safe_ratio(living, n("PlotSize")), 10),
        "RoomDensity": bounded(safe_ratio(n("TotalRooms"), living), 5),
        "ParkingPerArea": bounded(safe_ratio(n("ParkingSpots"), living), 5),
        "HasParking": F.when(n("ParkingSpots") > 0, 1.0).otherwise(0.0),
        "BasementUtilization": bounded(safe_ratio(finished, fill0(n("BasementArea")) + 1), 5),
        "AmenityDensity": bounded(
            safe_ratio(
                fill0(n("MeetingRooms")) + fill0(n("Restrooms")) + fill0(n("ParkingSpots")), living
            ),
            5,
        ),
        "RestroomPerRoom": bounded(safe_ratio(n("Restrooms"), n("TotalRooms")), 3),
        "ExteriorScore": product(n("ExteriorQuality"), n("ExteriorCondition")),
        "BasementOverallScore": product(
            n("BasementQuality"), n("BasementCondition"), n("BasementExposure")
        ),
        "SeasonListed": season(n("MonthListed")),
        "ConstructionDecade": decade(n("ConstructionYear")),
        "PlotSize_binned": plot_bin,
        "BuildingAge_binned": bin_edges(age, AGE_EDGES),
        "BuildingLifeStage": life_stage(age),
        "RenovationEffectiveness": F.exp(-reno_age / 20),
        "SeasonalStrength": seasonal_strength(n("MonthListed")),
        # a score of -1 would divide by zero: no value
        "QualityAreaProximity": F.when(
            fill0(proximity) != -1,
            n("BuildingGrade") * log1p0(living) * (1 / (1 + fill0(proximity))),
        ),
        "BasementEfficiency": safe_ratio(finished, n("BasementArea"))
        * n("BasementQuality")
        * n("BasementExposure"),
        "ValueDensity": F.when(plot_log != 0, quality * log1p0(living) / plot_log),
        "AgeQualityInteraction": clip(log1p0(quality) / (1 + age), 0, 10),
        "LogQualityArea": clip(log1p0(quality) * log1p0(living + 1), 0, 50),
        "RoomSizeAdequacy": safe_ratio(living, n("TotalRooms") + 1e-6),
        "ParkingAdequacy": safe_ratio(n("ParkingSpots"), n("TotalRooms") / 3 + 1e-6),
        "RenovationNeed": renovation_gap * (6 - n("BuildingCondition")),
        "LandUtilization": safe_ratio(living + basement, n("PlotSize") + 1e-6),
    }


def add_derived(
    df: DataFrame,
    names: list[str] | None = None,
    plot_edges: list[float] | None = None,
    clipped: bool = True,
    plot_epsilon: float = 1e-3,
) -> DataFrame:
    """Append derived columns. `clipped=False` and `plot_epsilon=0` give the older variants.

    Pass `plot_edges` from `fit_plot_edges` of the training table, so that bins mean the same
    in every batch; without them PlotSize_binned is null. Input columns that share a name with
    a derived column are replaced.
    """
    names = names or DERIVED
    keep = [c for c in df.columns if c not in set(names) | set(_SHARED)]
    own = [c for c in df.columns if c in _SHARED and c not in names]
    numeric = df.select(
        *keep, *[F.col(c).alias(f"__own_{c}") for c in own],
        *[to_num(df, c).alias(_N + c) for c in INPUTS],
    )
    shared = numeric.select("*", *[c.alias(k) for k, c in _shared_terms().items()])
    catalogue = _catalogue(plot_edges, clipped, plot_epsilon)
    return shared.select(
        *keep,
        *[F.col(f"__own_{c}").alias(c) for c in own],
        *[(F.col(k) if k in _SHARED else catalogue[k]).alias(k) for k in names],
    )


def ensure_derived(df: DataFrame) -> DataFrame:
    """Add TotalLivingArea, BuildingAge and OverallQuality where they are absent."""
    made = {
        "TotalLivingArea": to_num(df, "GroundFloorArea") + to_num(df, "UpperFloorArea"),
        "BuildingAge": building_age(to_num(df, "YearListed"), to_num(df, "ConstructionYear")),
        "OverallQuality": to_num(df, "BuildingGrade") * to_num(df, "BuildingCondition"),
    }
    return df.withColumns({k: c for k, c in made.items() if k not in df.columns})
