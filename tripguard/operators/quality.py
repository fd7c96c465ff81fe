"""Monthly quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripguard.functions import rnd_sql, share_sql

MONTH_KEYS = ["data_year", "data_month", "schema_version"]

# Columns whose null rate is reported, and under which name.
NULL_RATES = {
    "null_rate_passenger_count": "passenger_count",
    "null_rate_trip_distance": "trip_distance_miles",
    "null_rate_pickup_longitude": "pickup_longitude",
    "null_rate_pu_location_id": "pu_location_id",
    "null_rate_fare_amount": "fare_amount",
    "null_rate_total_amount": "total_amount",
    "null_rate_payment_type": "payment_type",
    "null_rate_congestion_surcharge": "congestion_surcharge",
    "null_rate_airport_fee": "airport_fee",
}
# The null rates completeness averages.
COMPLETENESS_TERMS = [
    "null_rate_passenger_count", "null_rate_trip_distance", "null_rate_fare_amount",
    "null_rate_total_amount", "null_rate_payment_type",
]


# Name of each further metric and the aggregate behind it.
STATISTICS = {
    "avg_trip_distance_miles": rnd_sql("avg(trip_distance_miles)", 2),
    "min_trip_distance_miles": rnd_sql("min(trip_distance_miles)", 2),
    "max_trip_distance_miles": rnd_sql("max(trip_distance_miles)", 2),
    "stddev_trip_distance": rnd_sql("stddev_samp(trip_distance_miles)", 2),
    "avg_fare_amount": rnd_sql("avg(fare_amount)", 2),
    "min_fare_amount": rnd_sql("min(fare_amount)", 2),
    "max_fare_amount": rnd_sql("max(fare_amount)", 2),
    "avg_passenger_count": rnd_sql("avg(cast(passenger_count as double))", 2),
    "active_days": "cast(coalesce(bit_count(bit_or(day_bit)), 0) as bigint)",
    "earliest_trip_date": "to_date(min(pickup_at))",
    "latest_trip_date": "to_date(max(pickup_at))",
    "negative_fare_count": "count_if(fare_amount < 0)",
    "negative_total_amount_count": "count_if(total_amount < 0)",
    "zero_distance_trip_count": "count_if(trip_distance_miles = 0)",
    "first_ingested_at": "min(ingested_at)",
    "last_ingested_at": "max(ingested_at)",
}
# A bit for the day of the month, if the trip lies in its file's month.
DAY_BIT = """
    if(year(pickup_at) = data_year and month(pickup_at) = data_month,
       shiftleft(1, dayofmonth(pickup_at) - 1), null) as day_bit
"""
DAYS_IN_MONTH = "cast(dayofmonth(last_day(make_date(data_year, data_month, 1))) as bigint)"


def monthly_counts(staged: DataFrame) -> DataFrame:
    """One row per month and era: counts, null rates, value statistics.

    A single aggregate with constant-size states, so each task sends one row
    per month it has seen, however large or uneven the months are. Active days
    are a bit set of days of the month rather than a distinct count.
    """
    aggregates = ["count(*) as total_rows"]
    for name, column in NULL_RATES.items():
        rate = share_sql(f"count_if({column} is null)", "count(*)")
        aggregates.append(f"{rnd_sql(rate, 4)} as {name}")
    aggregates += [f"{aggregate} as {name}" for name, aggregate in STATISTICS.items()]
    return (
        staged.selectExpr("*", DAY_BIT)
        .groupBy(*MONTH_KEYS)
        .agg(*[F.expr(aggregate) for aggregate in aggregates])
        .selectExpr("*", f"{DAYS_IN_MONTH} as days_in_month")
    )


COMPLETENESS = rnd_sql(f"1.0D - ({' + '.join(COMPLETENESS_TERMS)}) / 5.0D", 4)
ERA_AVERAGE = "avg(cast(total_rows as double)) over (partition by schema_version)"
VOLUME = rnd_sql(f"least(1.0D, {share_sql('total_rows', 'era_average')})", 4)


def score_months(monthly: DataFrame) -> DataFrame:
    """Completeness, and volume against the average month of the era.

    The window runs over months, some dozens per era, not over trips.
    """
    return monthly.selectExpr("*", f"{ERA_AVERAGE} as era_average").selectExpr(
        *monthly.columns,
        f"{COMPLETENESS} as completeness_score",
        f"{VOLUME} as volume_anomaly_score",
    )


def quality_metrics(staged: DataFrame) -> DataFrame:
    return score_months(monthly_counts(staged))
