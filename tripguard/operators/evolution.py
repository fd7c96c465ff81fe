"""What changed between loads, read from the load log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripguard.operators.ordered import lag_in_order
from tripguard.schemas import DATA_COLUMNS, ERA_GPS, ERA_ZONE, ERA_ZONE_V2, ERA_ZONE_V3

LOAD_ORDER = ["ingested_at", "partition_key"]

# Fixed values: (era, era of the load before) and the name of that change.
CHANGE_TYPES = [
    (ERA_GPS, None, "initial_load"),
    (ERA_ZONE, ERA_GPS, "gps_to_zone_ids"),
    (ERA_ZONE_V2, ERA_ZONE, "added_congestion_surcharge"),
    (ERA_ZONE_V3, ERA_ZONE_V2, "added_airport_fee"),
]
NO_CHANGE = "no_change"


def present_columns(trips: DataFrame, candidates: list[str] = DATA_COLUMNS) -> DataFrame:
    """Per source file: row count and the candidate columns with any value.

    Counts only, so a file of any size sends one row per task.
    """
    keys = ["source_file", "data_year", "data_month", "schema_version"]
    names = ", ".join(f"if(count({c}) > 0, '{c}', null)" for c in candidates)
    return trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.expr(f"array_sort(array_compact(array({names})))").alias("columns"),
    )


def _csv_difference(a: Column, b: Column) -> Column:
    return F.array_join(F.array_sort(F.array_except(a, b)), ",")


def schema_diff(loads: DataFrame) -> DataFrame:
    """Columns added and removed against the load before, as sorted csv.

    ``loads`` has ingested_at, partition_key and an array ``columns``. The
    first load adds all its columns.
    """
    dated = loads.withColumn("_day", F.to_date("ingested_at"))
    lagged = lag_in_order(dated, ["columns"], LOAD_ORDER, "_day")
    nothing = F.array().cast("array<string>")
    previous = F.coalesce(F.col("prev_columns"), nothing)
    return lagged.withColumns(
        {
            "columns_added": _csv_difference(F.col("columns"), previous),
            "columns_removed": _csv_difference(previous, F.col("columns")),
        }
    ).drop("_day", "prev_columns")


def columns_after_last_load(lineage: DataFrame) -> DataFrame:
    """The columns in force: each name whose last mention in the log added it."""
    successes = lineage.filter(F.col("status") == "success")

    def mentions(column: str, present: bool) -> DataFrame:
        names = F.explode(F.filter(F.split(column, ","), lambda name: name != ""))
        return successes.select(*LOAD_ORDER, names.alias("column"), F.lit(present).alias("present"))

    last = F.max(F.struct(*LOAD_ORDER, "present")).alias("last")
    both = mentions("columns_added", True).unionByName(mentions("columns_removed", False))
    return both.groupBy("column").agg(last).filter("last.present").select("column")


def schema_evolution(lineage: DataFrame) -> DataFrame:
    """Successful loads with their change against the load before."""
    successes = lineage.filter(F.col("status") == "success").withColumn(
        "_day", F.to_date("ingested_at")
    )
    lagged = lag_in_order(successes, ["schema_version", "column_count"], LOAD_ORDER, "_day")
    change = F
    for era, before, name in CHANGE_TYPES:
        previous = F.col("prev_schema_version")
        matches = previous.isNull() if before is None else previous == before
        change = change.when((F.col("schema_version") == era) & matches, F.lit(name))
    return lagged.select(
        "partition_key",
        "schema_version",
        "prev_schema_version",
        "column_count",
        "prev_column_count",
        (F.col("column_count") - F.coalesce("prev_column_count", F.lit(0))).alias("columns_delta"),
        "columns_added",
        "columns_removed",
        "row_count",
        "ingested_at",
        "iceberg_snapshot_id",
        F.coalesce(
            (F.col("columns_added") != "") | (F.col("columns_removed") != ""), F.lit(False)
        ).alias("is_schema_change"),
        change.otherwise(F.lit(NO_CHANGE)).alias("change_type"),
    )


def latest_evolution(evolution: DataFrame) -> DataFrame:
    """The most recent load of each month, an aggregate rather than a ranking."""
    carried = ["is_schema_change", "change_type", "columns_added", "columns_removed"]
    last = F.max(F.struct("ingested_at", *carried)).alias("last")
    parts = F.split("partition_key", "-")
    return evolution.groupBy("partition_key").agg(last).select(
        "partition_key",
        *[F.col(f"last.{c}").alias(c) for c in carried],
        parts.getItem(0).try_cast("int").alias("data_year"),
        parts.getItem(1).try_cast("int").alias("data_month"),
    )


def lineage_history(lineage: DataFrame, table: str | None = None) -> DataFrame:
    """All load attempts, oldest first, of one table if named."""
    if table is not None:
        lineage = lineage.filter(F.col("iceberg_table") == table)
    return lineage.orderBy(*LOAD_ORDER, "run_id")


def lineage_changes(lineage: DataFrame) -> DataFrame:
    """Attempts that added or removed columns, oldest first."""
    changed = (F.col("columns_added") != "") | (F.col("columns_removed") != "")
    return lineage.filter(changed).select(
        "partition_key", "schema_version", "columns_added", "columns_removed", "ingested_at"
    ).orderBy(*LOAD_ORDER)


def verify_row_counts(counts: DataFrame, lineage: DataFrame) -> DataFrame:
    """Rows in the table against rows the last successful load reported."""
    last = (
        lineage.filter(F.col("status") == "success")
        .groupBy("partition_key")
        .agg(F.max(F.struct("ingested_at", "row_count")).alias("last"))
        .select(
            F.split("partition_key", "-").getItem(0).try_cast("int").alias("data_year"),
            F.split("partition_key", "-").getItem(1).try_cast("int").alias("data_month"),
            F.col("last.row_count").alias("lineage_row_count"),
        )
    )
    return counts.join(last, ["data_year", "data_month"], "full").select(
        "data_year",
        "data_month",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        "lineage_row_count",
        F.col("lineage_row_count")
        .eqNullSafe(F.coalesce("row_count", F.lit(0)))
        .alias("is_match"),
    )
