"""What happens to data past its window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Windows in days, and the columns the first applies to.
RAW_DAYS = 365
FEATURE_DAYS = 730
AUDIT_DAYS = 2555
RAW_COLUMNS = [
    "pickup_at", "dropoff_at", "pickup_longitude", "pickup_latitude",
    "dropoff_longitude", "dropoff_latitude",
]


def _older(date: Column, as_of: str, days: int) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), date) > days


def past_raw_window(trips: DataFrame, as_of: str, days: int = RAW_DAYS) -> DataFrame:
    """Trips that still show a precise time past the window."""
    return trips.filter(_older(F.to_date("pickup_at"), as_of, days))


def suppress_raw(trips: DataFrame, as_of: str, days: int = RAW_DAYS) -> DataFrame:
    """Null precise times and places of trips older than the window."""
    expired = _older(F.to_date("pickup_at"), as_of, days)
    return trips.withColumns(
        {c: F.when(~F.coalesce(expired, F.lit(False)), F.col(c)) for c in RAW_COLUMNS if c in trips.columns}
    )


def expire_features(mart: DataFrame, as_of: str, days: int = FEATURE_DAYS) -> DataFrame:
    """Drop rows whose whole month is older than the window."""
    month_end = F.expr("last_day(make_date(data_year, data_month, 1))")
    return mart.filter(~_older(month_end, as_of, days))


def mark_archived(audit: DataFrame, as_of: str, days: int = AUDIT_DAYS) -> DataFrame:
    """Flag audit events that belong in the archive; none is deleted."""
    return audit.withColumn("is_archived", _older(F.to_date("timestamp"), as_of, days))
