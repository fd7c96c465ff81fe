"""Load month files into the trip table and log every attempt."""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripguard.operators import evolution
from tripguard.schemas import LINEAGE_SCHEMA, UNIFIED_COLUMNS, UNIFIED_SCHEMA, era_of_year
from tripguard.sources import tables
from tripguard.sources.manifest import FILE_FORMAT, parse_name
from tripguard.sources.unify import file_schemas, read_months, unified_name

PIPELINE_VERSION = "1.0.0"
LOADS_SCHEMA = T.StructType(
    [
        T.StructField("partition_key", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Layout:
    """Where the tables lie."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def month_of(path: str) -> str:
    year, month = parse_name(path)
    return f"{year}-{month:02d}"


def _month_or_blank(path: str) -> str:
    try:
        return month_of(path)
    except ValueError:
        return ""


def _load_times(paths: list[str], run_ts: datetime) -> dict[str, datetime]:
    """Months of a run count as loaded one after the other, a millisecond apart."""
    ordered = sorted(paths, key=lambda p: (_month_or_blank(p), p))
    return {path: run_ts + timedelta(milliseconds=i) for i, path in enumerate(ordered)}


def _log_rows(loads: DataFrame, run_id: str, table: str, steps: list[str], status: str) -> DataFrame:
    ok = status == "success"
    return loads.select(
        F.lit(run_id).alias("run_id"),
        "source_url",
        F.lit(FILE_FORMAT).alias("source_format"),
        "schema_version",
        "partition_key",
        "row_count",
        F.size("columns").alias("column_count"),
        "columns_added",
        "columns_removed",
        F.lit(run_id if ok else "").alias("iceberg_snapshot_id"),
        F.lit(table).alias("iceberg_table"),
        F.lit(json.dumps(steps)).alias("transformation_steps"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        "ingested_at",
        F.lit(status).alias("status"),
        F.col("error_message") if not ok else F.lit("").alias("error_message"),
    )


def _diffed(spark: SparkSession, lineage: DataFrame, rows: list[tuple]) -> DataFrame:
    """The new loads with their change against the load before, the first of
    them against the last load in the log."""
    loads = spark.createDataFrame(rows, LOADS_SCHEMA)
    # Column names of one table, so a handful of strings.
    in_force = [r["column"] for r in evolution.columns_after_last_load(lineage).collect()]
    if in_force:
        earlier = min(row[5] for row in rows) - timedelta(days=1)
        before = spark.createDataFrame([("", "", "", 0, in_force, earlier)], LOADS_SCHEMA)
        loads = before.unionByName(loads)
    return evolution.schema_diff(loads).filter(F.col("partition_key") != "")


def _append_new(rows: DataFrame, lineage: DataFrame, path: str) -> None:
    """Log rows that the same run, repeated after a failure, has not logged yet."""
    key = ["run_id", "partition_key", "source_url", "status"]
    tables.append(rows.join(lineage.select(*key), key, "left_anti"), path, LINEAGE_SCHEMA)


def log_failures(
    spark: SparkSession,
    root: str,
    run_id: str,
    errors: dict[str, str],
    times: dict[str, datetime],
    steps: list[str],
) -> None:
    """A failed load per file, with the reason."""
    if not errors:
        return
    at = Layout(root)
    rows = []
    for path, error in errors.items():
        month = _month_or_blank(path)
        era = era_of_year(parse_name(path)[0]) if month else ""
        rows.append((month, path, era, 0, [], times[path], error))
    schema = T.StructType([*LOADS_SCHEMA.fields, T.StructField("error_message", T.StringType())])
    failed = spark.createDataFrame(rows, schema).withColumns(
        {"columns_added": F.lit(""), "columns_removed": F.lit("")}
    )
    lineage = tables.read(spark, at.lineage, LINEAGE_SCHEMA)
    _append_new(_log_rows(failed, run_id, at.trips, steps, "failed"), lineage, at.lineage)


def _file_rows(trips: DataFrame) -> dict[str, int]:
    """Rows by file name; nothing else is read, so footers answer it."""
    counts = trips.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).collect()
    return {row["source_file"]: row["n"] for row in counts}


def ingest(
    spark: SparkSession,
    paths: list[str],
    root: str,
    run_ts: datetime | None = None,
    run_id: str | None = None,
    diff_on: str = "raw",
    strict: bool = True,
) -> None:
    """Load the files in one job and replace the months they hold.

    One plan reads all files and each task writes what it read, so nothing is
    shuffled. A file without rows empties its month. Row counts come from the
    footers. A file that cannot be read or unified, or shares its month with
    another one, fails alone: it is logged with its reason, the others load,
    and ``strict`` raises in the end. A run repeated under its id logs nothing
    twice and is compared with the log before it. ``diff_on`` chooses between
    the columns of the files and the unified columns, which never differ, for
    the schema history.
    """
    if diff_on not in ("raw", "unified"):
        raise ValueError("diff_on is 'raw' or 'unified'")
    run_ts = run_ts or datetime.now(timezone.utc)
    run_id = run_id or f"run-{run_ts:%Y%m%dT%H%M%S%f}"
    at = Layout(root)
    paths = list(dict.fromkeys(paths))
    times = _load_times(paths, run_ts)
    steps: list[str] = []
    schemas, errors = file_schemas(spark, paths)
    shared = Counter(map(_month_or_blank, schemas))
    for path in [p for p in schemas if shared[_month_or_blank(p)] > 1]:
        errors[path] = "two files of the same month in one run"
        del schemas[path]
    log_failures(spark, root, run_id, errors, times, steps)
    if schemas:
        steps.append(f"read_{FILE_FORMAT}")
        try:
            counts = _load(spark, schemas, at, run_ts, steps)
        except Exception as error:
            log_failures(spark, root, run_id, dict.fromkeys(schemas, str(error)), times, steps)
            raise
        rows = []
        for path in sorted(schemas, key=times.get):
            names = {unified_name(c) for c in schemas[path].fieldNames()}
            columns = sorted(names if diff_on == "raw" else UNIFIED_COLUMNS)
            era = era_of_year(parse_name(path)[0])
            n = counts.get(path.rsplit("/", 1)[-1], 0)
            rows.append((month_of(path), path, era, n, columns, times[path]))
        lineage = tables.read(spark, at.lineage, LINEAGE_SCHEMA)
        before = lineage.filter(F.col("run_id") != run_id)
        done = _diffed(spark, before, rows)
        _append_new(_log_rows(done, run_id, at.trips, steps, "success"), lineage, at.lineage)
    if strict and errors:
        told = "; ".join(f"{path}: {why}" for path, why in sorted(errors.items()))
        raise ValueError(f"{len(errors)} of {len(paths)} files were not loaded: {told}")


def _load(
    spark: SparkSession, schemas: dict[str, T.StructType], at: Layout, run_ts: datetime, steps: list[str]
) -> dict[str, int]:
    """Write the files' months; rows by file name."""
    trips = read_months(spark, schemas, run_ts.isoformat())
    steps += ["normalize_schema", "add_pipeline_metadata"]
    counts = _file_rows(trips)
    emptied = [parse_name(p) for p in schemas if not counts.get(p.rsplit("/", 1)[-1])]
    tables.overwrite_months(trips, at.trips, emptied=emptied)
    steps.append("write_table")
    return counts


def read_trips(spark: SparkSession, root: str) -> DataFrame:
    """The unified table; year and month are its partitions."""
    return tables.read(spark, Layout(root).trips, UNIFIED_SCHEMA).select(*UNIFIED_COLUMNS)


def verify(spark: SparkSession, root: str) -> DataFrame:
    """Rows in the table against the load log, month by month."""
    return evolution.verify_row_counts(
        tables.partition_row_counts(read_trips(spark, root)),
        tables.read(spark, Layout(root).lineage, LINEAGE_SCHEMA),
    )
