"""Unified trips -> staged trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripguard.functions import int64_sql
from tripguard.schemas import UNIFIED_COLUMNS

# Columns that change name or become whole numbers, and what
# makes a row a trip.
STAGED_NAMES = {
    "tpep_pickup_datetime": "pickup_at",
    "tpep_dropoff_datetime": "dropoff_at",
    "trip_distance": "trip_distance_miles",
}
VALID_TRIP = """
    tpep_pickup_datetime is not null and tpep_dropoff_datetime is not null
    and tpep_dropoff_datetime > tpep_pickup_datetime
    and trip_distance >= 0 and total_amount >= 0
"""
WHOLE_NUMBERS = [
    "passenger_count", "pu_location_id", "do_location_id", "rate_code_id", "payment_type",
]


def coerce_number(text: Column) -> Column:
    """Text to double, bad text to null."""
    return text.try_cast("double")


def coerce_zone(text: Column) -> Column:
    """Text to int, bad text to null."""
    return text.try_cast("int")


def _staged(name: str) -> str:
    if name in WHOLE_NUMBERS:
        return f"{int64_sql(name)} as {name}"
    if name == "ingested_at":
        return "try_cast(ingested_at as timestamp) as ingested_at"
    return f"{name} as {STAGED_NAMES.get(name, name)}"


def stage(trips: DataFrame) -> DataFrame:
    """Rename, retype and drop rows that cannot be a trip.

    Only light cleaning: negative fares and zero distances stay, the quality
    metrics count them. Null distance or total fails its comparison and drops.
    """
    return trips.filter(VALID_TRIP).selectExpr(*[_staged(name) for name in UNIFIED_COLUMNS])


# What a sample shows of a trip.
SAMPLE_COLUMNS = [
    "vendor_id", "pickup_at", "dropoff_at", "passenger_count", "trip_distance_miles",
    "pu_location_id", "do_location_id", "pickup_longitude", "pickup_latitude",
    "fare_amount", "total_amount", "payment_type", "congestion_surcharge",
    "airport_fee", "schema_version",
]

_FIRST = ["pickup_at", "dropoff_at", "total_amount"]
SAMPLE_ORDER = [*_FIRST, *[c for c in SAMPLE_COLUMNS if c not in _FIRST]]


def sample_rows(staged: DataFrame, year: int, n: int = 500) -> DataFrame:
    """The first ``n`` rows of a year in time order.

    Ordered by every column, so the sample does not depend on file layout; a
    sort with a limit keeps n rows per task and never sorts the year.
    """
    return (
        staged.filter(F.col("data_year") == year)
        .select(*SAMPLE_COLUMNS)
        .orderBy(*SAMPLE_ORDER)
        .limit(n)
    )


def first_rows_by_year(staged: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of every year in time order, in one scan.

    A ranked limit: each task passes on the first rows of each year that it
    has, so a year of any size sends n rows a task. The few columns shown are
    all that is read and sorted.
    """
    order = Window.partitionBy("data_year").orderBy(*SAMPLE_ORDER)
    ranked = staged.select("data_year", *SAMPLE_COLUMNS).withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def loaded_years(trips: DataFrame) -> DataFrame:
    """Distinct years, ascending."""
    return trips.select("data_year").distinct().orderBy("data_year")
