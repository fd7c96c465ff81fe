"""Column lists, types, eras and table schemas.

The literal lists in this module are fixed values: they name the columns,
eras and field types of the monthly trip files and of the tables built from
them, and must stay as they are for results to agree.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Eras by last year of validity.
ERA_GPS, ERA_ZONE, ERA_ZONE_V2, ERA_ZONE_V3 = "gps", "zone", "zone_v2", "zone_v3"
ERA_LAST_YEAR = [(ERA_GPS, 2015), (ERA_ZONE, 2018), (ERA_ZONE_V2, 2021)]

GPS_COLUMNS = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
ZONE_COLUMNS = ["pu_location_id", "do_location_id"]

# File spellings (lower case, names resolve without case) and
# the unified name of each.
COLUMN_RENAMES = {
    "vendorid": "vendor_id",
    "pulocationid": "pu_location_id",
    "dolocationid": "do_location_id",
    "ratecodeid": "rate_code_id",
}

# Columns a file may lack; all other data columns are required.
OPTIONAL_COLUMNS = GPS_COLUMNS + [
    "improvement_surcharge", "congestion_surcharge", "airport_fee",
] + ZONE_COLUMNS

# The unified table, in order.
UNIFIED_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.StringType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("rate_code_id", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("payment_type", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("data_year", T.IntegerType()),
        T.StructField("data_month", T.IntegerType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("schema_version", T.StringType()),
    ]
)
UNIFIED_COLUMNS = UNIFIED_SCHEMA.fieldNames()
DATA_COLUMNS = UNIFIED_COLUMNS[:23]
PARTITION_COLUMNS = ["data_year", "data_month"]

# The load log, one row per load attempt.
LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("source_format", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("column_count", T.LongType()),
        T.StructField("columns_added", T.StringType()),
        T.StructField("columns_removed", T.StringType()),
        T.StructField("iceberg_snapshot_id", T.StringType()),
        T.StructField("iceberg_table", T.StringType()),
        T.StructField("transformation_steps", T.StringType()),
        T.StructField("pipeline_version", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# The audit log.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("actor", T.StringType()),
        T.StructField("trip_id", T.StringType()),
        T.StructField("gdpr_article", T.StringType()),
        T.StructField("ccpa_section", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("details_json", T.StringType()),
    ]
)

# Generated narratives.
NARRATIVE_SCHEMA = T.StructType(
    [
        T.StructField("pain_point", T.StringType()),
        T.StructField("data_year", T.LongType()),
        T.StructField("data_month", T.LongType()),
        T.StructField("narrative_json", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
    ]
)


def era_of_year(year: int) -> str:
    """Era of a file by its year."""
    for era, last_year in ERA_LAST_YEAR:
        if year <= last_year:
            return era
    return ERA_ZONE_V3


def era_sql(year: str) -> str:
    """``era_of_year`` as SQL text over a year expression."""
    steps = " ".join(f"when {year} <= {last} then '{era}'" for era, last in ERA_LAST_YEAR)
    return f"case {steps} when {year} is not null then '{ERA_ZONE_V3}' end"
