"""Tables by path: create, overwrite by month, append, read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripguard.functions import sorted_json
from tripguard.schemas import PARTITION_COLUMNS, UNIFIED_SCHEMA


# Below a monthly table; readers skip names that begin with an underscore.
SCHEMA_FOLDER = "_schema"
# Rows of a row group, and so of a Bloom filter, in tables that are looked through for few ids.
GROUP_ROWS = 100_000


def ensure_trip_table(spark: SparkSession, name: str, path: str) -> None:
    """Register the partitioned trip table at ``path`` unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in UNIFIED_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{path}'"
    )


def refresh_trip_table(spark: SparkSession, name: str) -> None:
    """Make months written to the path visible under the table's name."""
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def by_month(df: DataFrame) -> DataFrame:
    """Bring the rows of a month together before a partitioned write.

    For frames that come out of a shuffle, whose tasks would otherwise each
    open a file in every month. Rebalancing splits a large month over as many
    tasks as its size asks for and joins small ones.
    """
    return df.hint("rebalance", *PARTITION_COLUMNS)


def overwrite_months(
    df: DataFrame,
    path: str,
    shuffled: bool = False,
    emptied: Iterable[tuple[int, int]] = (),
    lookup: str | None = None,
    group_rows: int = GROUP_ROWS,
) -> None:
    """Replace the months ``df`` holds and remove those ``emptied``; all others stay.

    Straight from a scan nothing is shuffled: each task writes the months it
    read. ``emptied`` are (year, month) that are replaced by no rows at all; a
    dynamic overwrite leaves such months as they are, so their folders go
    afterwards. A rerun repeats both steps, after any failure.

    ``lookup`` names a column by which few rows will be looked for: it gets a
    Bloom filter per row group, which are of ``group_rows`` at most.
    """
    options = {"partitionOverwriteMode": "dynamic"}
    if lookup is not None:
        options |= {
            f"parquet.bloom.filter.enabled#{lookup}": "true",
            # Without a number each filter is of 1 MB.
            f"parquet.bloom.filter.expected.ndv#{lookup}": str(group_rows),
            # Some hundreds of values may be looked for at once.
            f"parquet.bloom.filter.fpp#{lookup}": "0.0001",
            "parquet.block.row.count.limit": str(group_rows),
        }
    rows = by_month(df) if shuffled else df
    rows.write.mode("overwrite").options(**options).partitionBy(*PARTITION_COLUMNS).parquet(path)
    remove_months(df.sparkSession, path, emptied)


def remove_months(spark: SparkSession, path: str, months: Iterable[tuple[int, int]]) -> None:
    """Delete the partition folders of these months, on any file system Spark knows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    year, month = PARTITION_COLUMNS
    for y, m in months:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{year}={y}/{month}={m}")
        folder.getFileSystem(conf).delete(folder, True)


def months_in(df: DataFrame) -> set[tuple[int, int]]:
    """The months of a frame: a row each, so some hundreds reach the driver."""
    return {tuple(row) for row in df.select(*PARTITION_COLUMNS).distinct().collect()}


def replace(df: DataFrame, path: str, monthly: bool = False) -> None:
    """Replace a whole derived table, partitioned by month if asked.

    Static whatever the session says: a month without rows must not stay.
    """
    if not monthly:
        df.write.mode("overwrite").parquet(path)
        return
    by_month(df).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *PARTITION_COLUMNS
    ).parquet(path)
    # A partitioned table without rows has no file that tells its columns.
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/{SCHEMA_FOLDER}")


def load(spark: SparkSession, path: str) -> DataFrame:
    """A monthly table written by ``replace``, which may be empty."""
    schema = spark.read.parquet(f"{path}/{SCHEMA_FOLDER}").schema
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Add rows to a log table, in the column order and types of ``schema``."""
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    df.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table. With a schema, columns older files lack come back null
    and a table that was never written comes back empty."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def add_columns(spark: SparkSession, name: str, fields: T.StructType) -> list[str]:
    """ALTER TABLE ... ADD COLUMNS for the fields the table does not have."""
    have = {c.name.lower() for c in spark.catalog.listColumns(name)}
    new = [f for f in fields.fields if f.name.lower() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, keys in name order."""
    df.select(sorted_json(*df.columns).alias("value")).write.mode("overwrite").text(path)


def partition_row_counts(trips: DataFrame) -> DataFrame:
    """Rows per month. On a table partitioned by month this reads footers only."""
    return trips.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))
