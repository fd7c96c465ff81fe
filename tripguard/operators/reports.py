"""Report tables over monthly scores. Their input has one row per month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripguard.functions import rnd
from tripguard.operators.trust import confidence_label, risk_driver

# Names of months as reports show them.
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# Limits below which a month counts as low, and the year whose
# volumes say nothing about the seasons.
LOW_TRUST = 0.75
LOW_VOLUME = 0.70
SHOCK_YEAR = 2020

# What a year's summary averages.
YEAR_AVERAGES = [
    "trust_score", "completeness_score", "volume_anomaly_score", "validity_score",
    "consistency_score", "avg_fare_amount", "avg_trip_distance_miles",
    "avg_passenger_count", "fare_per_mile",
]


PERIOD = "concat(data_year, '-', lpad(data_month, 2, '0'))"
# Average fare over average distance, null without distance.
FARE_PER_MILE = "if(avg_trip_distance_miles > 0, avg_fare_amount / avg_trip_distance_miles, null)"

# What is told of the worst and the best month of a year.
MONTH_FIELDS = {
    "period": PERIOD,
    "trips": "coalesce(total_rows, 0)",
    "trust_score": "coalesce(trust_score, 0.0D)",
    "volume_anomaly_score": "coalesce(volume_anomaly_score, 0.0D)",
    "avg_fare_amount": "coalesce(avg_fare_amount, 0.0D)",
}


def with_fare_per_mile(scores: DataFrame) -> DataFrame:
    return scores.selectExpr("*", f"{FARE_PER_MILE} as fare_per_mile")


def _weighted(column: str) -> str:
    """Average weighted by trips; a missing value counts as 0 with its weight,
    and without trips the plain average is taken.

    Summed as decimals, so the order of the months cannot change the result.
    """
    weight = "cast(coalesce(total_rows, 0) as decimal(16,0))"
    weighted = f"sum(cast(coalesce({column}, 0.0D) as decimal(20,8)) * {weight})"
    total = f"nullif(cast(sum({weight}) as double), 0.0D)"
    return f"coalesce(cast({weighted} as double) / {total}, avg({column}), 0.0D) as {column}"


def year_summary(scores: DataFrame) -> DataFrame:
    """One row per year: weighted averages, low months, worst and best month.

    Ties go to the earlier month.
    """
    month = "struct(" + ", ".join(f"{v} as {k}" for k, v in MONTH_FIELDS.items()) + ") as m"
    aggregates = [
        "count(distinct data_month) as months",
        "sum(total_rows) as total_rows",
        *[_weighted(c) for c in YEAR_AVERAGES],
        f"count_if(trust_score < {LOW_TRUST}D) as low_trust_months",
        f"count_if(volume_anomaly_score < {LOW_VOLUME}D) as low_volume_months",
        f"min(if(trust_score is null, null, struct(trust_score, data_month, {month}))) as worst",
        f"max(if(trust_score is null, null, struct(trust_score, -data_month, {month}))) as best",
    ]
    grouped = with_fare_per_mile(scores).groupBy("data_year").agg(*[F.expr(a) for a in aggregates])
    return grouped.select(
        "data_year",
        "months",
        "total_rows",
        *YEAR_AVERAGES,
        confidence_label("trust_score").alias("confidence"),
        "low_trust_months",
        "low_volume_months",
        *[
            F.col(f"{end}.m.{name}").alias(f"{end}_{name}")
            for end in ("worst", "best")
            for name in MONTH_FIELDS
        ],
    )


def year_over_year(summary: DataFrame) -> DataFrame:
    """Each year against the loaded year before it; gaps are skipped.

    The window runs over years, a handful of rows.
    """
    order = "over (order by data_year)"
    trips = f"try_divide(cast(total_rows as double), lag(total_rows) {order})"
    changes = {
        "trips_change_pct": f"({trips} - 1.0D) * 100.0D",
        "trust_change_points": f"(trust_score - lag(trust_score) {order}) * 10.0D",
        "avg_fare_change": f"avg_fare_amount - lag(avg_fare_amount) {order}",
    }
    raw = summary.selectExpr(
        "data_year",
        f"lag(data_year) {order} as previous_year",
        *[f"{change} as {name}" for name, change in changes.items()],
    )
    return raw.select("data_year", "previous_year", *[rnd(c, 1).alias(c) for c in changes])


def seasonal_profile(scores: DataFrame, excluded_year: int = SHOCK_YEAR) -> DataFrame:
    """Average trips by month of the year, halves to even."""
    return (
        scores.filter(F.col("data_year") != excluded_year)
        .groupBy("data_month")
        .agg(
            F.bround(F.avg("total_rows"), 0).cast("bigint").alias("avg_trips"),
            F.count(F.lit(1)).alias("years_of_data"),
        )
    )


def peak_trough(scores: DataFrame) -> DataFrame:
    """Months with most and fewest trips, the earliest on ties."""
    place = "data_year * 12 + data_month"
    peak = F.expr(f"max(struct(total_rows, -({place}), {PERIOD} as period))")
    trough = F.expr(f"min(struct(total_rows, {place}, {PERIOD} as period))")
    return scores.agg(peak.alias("p"), trough.alias("t")).select(
        F.col("p.period").alias("peak_period"),
        F.col("p.total_rows").alias("peak_trips"),
        F.col("t.period").alias("trough_period"),
        F.col("t.total_rows").alias("trough_trips"),
    )


def fare_per_mile_year(scores: DataFrame, year: int | None = None) -> DataFrame:
    """Mean over months of fare per mile, months without distance left out."""
    rows = with_fare_per_mile(scores)
    if year is not None:
        rows = rows.filter(F.col("data_year") == year)
    return rows.groupBy("data_year").agg(rnd("avg(fare_per_mile)", 6).alias("fare_per_mile"))


def volume_by_era(quality: DataFrame) -> DataFrame:
    """Trips per month with the era of the month."""
    return quality.selectExpr(f"{PERIOD} as period", "schema_version", "total_rows")


def volume_trend(scores: DataFrame) -> DataFrame:
    return scores.select(
        F.col("data_year").alias("year"),
        F.col("data_month").alias("month"),
        F.col("total_rows").alias("total_trips"),
        "volume_anomaly_score",
        "trust_score",
    )


def shock_year(scores: DataFrame, year: int = SHOCK_YEAR) -> DataFrame:
    """The months of one year with fares, distances, passengers and scores."""
    return scores.filter(F.col("data_year") == year).select(
        F.col("data_month").alias("month"),
        F.col("total_rows").alias("total_trips"),
        F.col("avg_fare_amount").alias("avg_fare"),
        F.col("avg_trip_distance_miles").alias("avg_distance_miles"),
        F.col("avg_passenger_count").alias("avg_passengers"),
        "volume_anomaly_score",
        "trust_score",
    )


def fare_evolution(scores: DataFrame) -> DataFrame:
    return scores.select(
        F.col("data_year").alias("year"),
        F.col("data_month").alias("month"),
        F.col("avg_fare_amount").alias("avg_fare"),
        F.col("avg_trip_distance_miles").alias("avg_distance_miles"),
        F.col("avg_passenger_count").alias("avg_passengers"),
        F.col("total_rows").alias("total_trips"),
        F.expr(FARE_PER_MILE).alias("fare_per_mile"),
    )


def month_review(scores: DataFrame, year: int | None = None) -> DataFrame:
    """Months of a year (or all) with scaled scores and what drags them down."""
    if year is not None:
        scores = scores.filter(F.col("data_year") == year)
    names = F.array(*[F.lit(m) for m in MONTH_LABELS])
    return scores.select(
        "data_year",
        "data_month",
        F.get(names, F.col("data_month") - 1).alias("month_label"),
        F.col("total_rows").alias("trips"),
        rnd("trust_score * 10.0D", 1).alias("trust_out_of_10"),
        rnd("volume_anomaly_score * 100.0D", 0).alias("volume_pct"),
        rnd("avg_fare_amount", 2).alias("avg_fare"),
        risk_driver().alias("risk_driver"),
    )


def representative_month(scores: DataFrame) -> DataFrame:
    """The first month of each year."""
    fields = ["data_month", *[c for c in scores.columns if c not in ("data_year", "data_month")]]
    first = F.min(F.struct(*fields)).alias("first")
    return scores.groupBy("data_year").agg(first).select(
        "data_year", *[F.col(f"first.{c}").alias(c) for c in fields]
    )
