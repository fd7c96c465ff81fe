"""Month files of all eras into one 28-column table, in one plan."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripguard.schemas import (
    COLUMN_RENAMES,
    DATA_COLUMNS,
    OPTIONAL_COLUMNS,
    UNIFIED_SCHEMA,
    era_sql,
)
from tripguard.sources.manifest import FILE_MONTH, FILE_YEAR, parse_name


def unified_name(column: str) -> str:
    """Unified name of a file's column; spelling differs in case only."""
    lowered = column.lower()
    return COLUMN_RENAMES.get(lowered, lowered)


def resolve_columns(columns: Iterable[str]) -> dict[str, str]:
    """Unified name -> spelling in the file, for the data columns it has."""
    found: dict[str, str] = {}
    for column in columns:
        name = unified_name(column)
        if name not in DATA_COLUMNS:
            continue
        if name in found:
            raise ValueError(f"columns {found[name]!r} and {column!r} both mean {name!r}")
        found[name] = column
    missing = [c for c in DATA_COLUMNS if c not in found and c not in OPTIONAL_COLUMNS]
    if missing:
        raise ValueError(f"required columns missing: {', '.join(missing)}")
    return found


def normalize(frame: DataFrame, ingested_at: str, timestamp_type: str = "timestamp") -> DataFrame:
    """One source frame, with a ``source_file`` column, as the unified table.

    Casts are coercing: a value that does not fit its type becomes null. Year,
    month and era come from the file name.
    """
    found = resolve_columns(frame.columns)
    selected = []
    for field in UNIFIED_SCHEMA.fields[: len(DATA_COLUMNS)]:
        target = field.dataType
        kind = timestamp_type if isinstance(target, T.TimestampType) else target.simpleString()
        source = f"`{found[field.name]}`" if field.name in found else "null"
        selected.append(f"try_cast({source} as {kind}) as {field.name}")
    selected += [f"{FILE_YEAR} as data_year", f"{FILE_MONTH} as data_month", "source_file"]
    return frame.selectExpr(*selected).select(
        "*",
        F.lit(ingested_at).alias("ingested_at"),
        F.expr(era_sql("data_year")).alias("schema_version"),
    )


def unify(
    frames: Iterable[DataFrame], ingested_at: str, timestamp_type: str = "timestamp"
) -> DataFrame:
    """Union of normalised frames; casting first means types cannot clash."""
    parts = [normalize(frame, ingested_at, timestamp_type) for frame in frames]
    return reduce(lambda a, b: a.unionByName(b), parts)


def file_schemas(
    spark: SparkSession, paths: list[str]
) -> tuple[dict[str, T.StructType], dict[str, str]]:
    """Schema of each month file that can be unified, and why the others cannot.

    From footers only: one short job per file, sixteen at a time. The files are
    months, so there are some hundreds of them however many rows they hold.
    """

    def look(path: str) -> T.StructType | str:
        try:
            parse_name(path)
            schema = spark.read.parquet(path).schema
            resolve_columns(schema.fieldNames())
        except Exception as error:  # a file of any kind of damage fails alone
            return str(error) or type(error).__name__
        return schema

    with ThreadPoolExecutor(16) as pool:
        found = dict(zip(paths, pool.map(look, paths)))
    bad = {path: seen for path, seen in found.items() if isinstance(seen, str)}
    return {path: seen for path, seen in found.items() if path not in bad}, bad


def read_months(
    spark: SparkSession,
    schemas: dict[str, T.StructType],
    ingested_at: str,
    timestamp_type: str = "timestamp",
) -> DataFrame:
    """Unified read of month files.

    Files of equal schema share one scan. Files whose physical types differ
    cannot (a Parquet scan has one type per column), so each distinct schema
    gets its own; there are a handful of them, not one per file.
    """
    groups = defaultdict(list)
    for path, schema in schemas.items():
        groups[schema.simpleString()].append(path)
    frames = [
        spark.read.schema(schemas[paths[0]])
        .parquet(*paths)
        .withColumn("source_file", F.col("_metadata.file_name"))
        for paths in groups.values()
    ]
    return unify(frames, ingested_at, timestamp_type)
