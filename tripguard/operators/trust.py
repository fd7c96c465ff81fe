"""Trust scores per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripguard.functions import rnd_sql, share_sql
from tripguard.operators.evolution import NO_CHANGE

# Weight of each component in the trust score.
WEIGHTS = {
    "completeness_score": 0.35,
    "volume_anomaly_score": 0.25,
    "validity_score": 0.25,
    "consistency_score": 0.15,
}
SCORE_AFTER_SCHEMA_CHANGE = 0.6

# Columns of the quality metrics carried into the scores.
CARRIED_COLUMNS = [
    "earliest_trip_date", "latest_trip_date", "avg_fare_amount", "avg_trip_distance_miles",
    "avg_passenger_count", "null_rate_passenger_count", "negative_fare_count",
    "zero_distance_trip_count", "null_rate_congestion_surcharge", "null_rate_airport_fee",
    "null_rate_pickup_longitude", "null_rate_pu_location_id",
]

# Lowest score of each band and label.
SCORE_BANDS = [(0.75, "good"), (0.5, "fair")]
LOWEST_BAND = "poor"
CONFIDENCE_LABELS = [
    (0.85, "High confidence"), (0.70, "Usable with review"), (0.55, "Use with caution"),
]
LOWEST_CONFIDENCE = "High risk"

# What a low component means, in the order ties are settled.
RISK_DRIVERS = [
    ("volume_anomaly_score", "Unusual volume"),
    ("completeness_score", "Missing values"),
    ("validity_score", "Invalid records"),
    ("consistency_score", "Schema change"),
]


_NEGATIVE = share_sql("negative_fare_count", "total_rows")
_ZERO = share_sql("zero_distance_trip_count", "total_rows")
# 1 less the share of negative fares, less twice that of zero distances (at
# most a half). May fall below 0.
VALIDITY = rnd_sql(f"1.0D - least(1.0D, {_NEGATIVE}) - least(0.5D, 2.0D * {_ZERO})", 4)
TRUST = rnd_sql(" + ".join(f"{name} * {weight}D" for name, weight in WEIGHTS.items()), 4)


def trust_scores(quality: DataFrame, evolution: DataFrame) -> DataFrame:
    """Quality metrics joined with the latest load of each month, and scored.

    ``evolution`` comes from ``latest_evolution``. Both sides have one row per
    month; Spark broadcasts by measured size.
    """
    consistency = evolution.selectExpr(
        "data_year",
        "data_month",
        f"if(is_schema_change, {SCORE_AFTER_SCHEMA_CHANGE}D, 1.0D) as consistency_score",
        "change_type",
        "columns_added",
        "columns_removed",
    )
    joined = quality.join(consistency, ["data_year", "data_month"], "left")
    scored = joined.selectExpr(
        "data_year",
        "data_month",
        "schema_version",
        "total_rows",
        "active_days",
        "days_in_month",
        "completeness_score",
        "volume_anomaly_score",
        f"coalesce({VALIDITY}, 1.0D) as validity_score",
        "coalesce(consistency_score, 1.0D) as consistency_score",
        f"coalesce(change_type, '{NO_CHANGE}') as change_type",
        "coalesce(columns_added, '') as columns_added",
        "coalesce(columns_removed, '') as columns_removed",
        *CARRIED_COLUMNS,
    )
    return scored.selectExpr("*", f"{TRUST} as trust_score")


def trust_for_year(scores: DataFrame, year: int | None = None) -> DataFrame:
    """Scores, or quality metrics, of one year or all, in month order."""
    if year is not None:
        scores = scores.filter(F.col("data_year") == year)
    return scores.orderBy("data_year", "data_month")


def _label(score: str, steps: list[tuple[float, str]], lowest: str) -> str:
    whens = " ".join(f"when {score} >= {least}D then '{label}'" for least, label in steps)
    return f"case {whens} else '{lowest}' end"


def score_band(score: str) -> Column:
    return F.expr(_label(score, SCORE_BANDS, LOWEST_BAND))


def confidence_label(score: str) -> Column:
    return F.expr(_label(score, CONFIDENCE_LABELS, LOWEST_CONFIDENCE))


def risk_driver() -> Column:
    """Label of the lowest component; a missing one counts as 1."""
    candidates = ", ".join(
        f"struct(coalesce({name}, 1.0D) as score, {i} as place, '{label}' as label)"
        for i, (name, label) in enumerate(RISK_DRIVERS)
    )
    return F.expr(f"array_min(array({candidates})).label")


def score_bands(scores: DataFrame) -> DataFrame:
    """Band of the trust score and of each component, per month."""
    names = ["trust_score", *WEIGHTS]
    return scores.select(
        "data_year",
        "data_month",
        *names,
        *[score_band(c).alias(c.replace("_score", "_band")) for c in names],
    )


def risk_drivers(scores: DataFrame) -> DataFrame:
    """What drags each month down most."""
    return scores.select("data_year", "data_month", "trust_score", risk_driver().alias("risk_driver"))
