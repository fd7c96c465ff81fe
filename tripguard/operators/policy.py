"""Privacy policy: what each column is, and what is done with it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.functions import hour_bucket, keyed_pseudonym, parse_timestamp

POLICY_FIELDS = ["pii_type", "sensitivity", "handling", "rationale"]

# The policy by column name.
POLICY = {
    "vendor_id": ("operational_identifier", "low", "pseudonymize", "Vendor IDs identify service providers rather than riders, but should not be used as direct ML features without review."),
    "pickup_at": ("quasi_identifier", "high", "generalize", "Trip timestamps can be linked to known routines or public sightings."),
    "dropoff_at": ("quasi_identifier", "high", "generalize", "Trip timestamps can be linked to known routines or public sightings."),
    "pickup_longitude": ("location_trace", "high", "suppress", "Pre-2016 precise pickup coordinates are re-identification risk."),
    "pickup_latitude": ("location_trace", "high", "suppress", "Pre-2016 precise pickup coordinates are re-identification risk."),
    "dropoff_longitude": ("location_trace", "high", "suppress", "Pre-2016 precise dropoff coordinates are re-identification risk."),
    "dropoff_latitude": ("location_trace", "high", "suppress", "Pre-2016 precise dropoff coordinates are re-identification risk."),
    "pu_location_id": ("quasi_identifier", "medium", "generalize", "Zone-level pickup locations are less precise than GPS but still linkable with time."),
    "do_location_id": ("quasi_identifier", "medium", "generalize", "Zone-level dropoff locations are less precise than GPS but still linkable with time."),
    "payment_type": ("quasi_identifier", "medium", "generalize", "Payment behavior can increase uniqueness when combined with location and time."),
    "fare_amount": ("financial_attribute", "medium", "aggregate", "Fare amounts are not direct PII but can strengthen linkage attacks."),
    "tip_amount": ("financial_attribute", "medium", "aggregate", "Tip amounts can be distinctive in small equivalence classes."),
    "total_amount": ("financial_attribute", "medium", "aggregate", "Total amounts can be distinctive in small equivalence classes."),
}
# What holds for a column the policy does not name, the default
# salt, and the coordinates a row transform drops.
POLICY_DEFAULT = ("non_pii", "low", "retain", "Not listed as a direct identifier or quasi-identifier under this policy.")
DEFAULT_SALT = "demo-rotation-2026"
PRECISE_LOCATION = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]


def policy_frame(spark: SparkSession, policy: dict[str, tuple] = POLICY) -> DataFrame:
    """The policy as rows: as many as it names columns."""
    rows = [(name.lower(), *fields) for name, fields in policy.items()]
    return spark.createDataFrame(
        rows, "column_name string, " + ", ".join(f"{f} string" for f in POLICY_FIELDS)
    )


def columns_frame(spark: SparkSession, tables: dict[str, Iterable[str]]) -> DataFrame:
    """(table_name, column_name) rows of named tables."""
    rows = [(table, column) for table, columns in tables.items() for column in columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def pii_inventory(columns: DataFrame, policy: dict[str, tuple] = POLICY) -> DataFrame:
    """Classify (table_name, column_name) rows; names match without case.

    The policy is a literal of a few rows; Spark knows its size.
    """
    rules = policy_frame(columns.sparkSession, policy).withColumnRenamed("column_name", "_name")
    joined = columns.join(rules, F.lower("column_name") == F.col("_name"), "left")
    matched = F.col("_name").isNotNull()
    return joined.select(
        "table_name",
        "column_name",
        *[
            F.coalesce(field, F.lit(default)).alias(field)
            for field, default in zip(POLICY_FIELDS, POLICY_DEFAULT)
        ],
        matched.alias("is_policy_match"),
    )


def handling_counts(inventory: DataFrame) -> DataFrame:
    """Columns per handling and sensitivity."""
    return inventory.groupBy("handling", "sensitivity").agg(F.count(F.lit(1)).alias("columns"))


def _handled(name: str, handling: str, kind: str, salt: str) -> Column | None:
    column = F.col(name)
    if handling in ("suppress", "aggregate"):
        return None
    if handling == "pseudonymize":
        return keyed_pseudonym(column.cast("string"), salt).alias(name)
    if handling == "generalize" and kind.startswith("timestamp"):
        return hour_bucket(column).alias(name)
    return column  # zones and coded categories are the generalised form already


def apply_policy(
    rows: DataFrame, salt: str = DEFAULT_SALT, policy: dict[str, tuple] = POLICY
) -> DataFrame:
    """Row-level output the policy allows, built from the frame's schema.

    Suppressed columns go, and so do those allowed in aggregates only;
    identifiers become keyed pseudonyms, times their hour.
    """
    rules = {name.lower(): fields[2] for name, fields in policy.items()}
    selected = []
    for name, kind in rows.dtypes:
        column = _handled(name, rules.get(name.lower(), POLICY_DEFAULT[2]), kind, salt)
        if column is not None:
            selected.append(column)
    return rows.select(*selected)


def transform_trips(trips: DataFrame, salt: str = DEFAULT_SALT, bucket: str = "hour") -> DataFrame:
    """Drop coordinates, key the id, cut times to the hour.

    The id falls back to the source file. Text times are parsed; a row without
    a pickup keeps whatever pickup_hour it had.
    """
    have = trips.columns
    ids = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("trip_id", "source_file") if c in have]
    if not ids:
        raise ValueError("need trip_id or source_file")
    changed = {"trip_pseudonym": keyed_pseudonym(F.coalesce(*ids), salt)}
    for source, target in (("pickup_at", "pickup_hour"), ("dropoff_at", "dropoff_hour")):
        if source in have:
            kept = F.col(target).cast("string") if target in have else F.lit(None).cast("string")
            value = F.col(source)
            if dict(trips.dtypes)[source] == "string":
                value = parse_timestamp(value)
            changed[target] = F.coalesce(hour_bucket(value, bucket), kept)
    return trips.withColumns(changed).drop("trip_id", "pickup_at", "dropoff_at", *PRECISE_LOCATION)
