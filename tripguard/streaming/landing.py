"""Pick up month files as they land, with the ingest job as the only writer."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripguard.schemas import LINEAGE_SCHEMA
from tripguard.sources import tables
from tripguard.sources.ingest import ingest, log_failures, month_of

FILES_PER_BATCH = 64
LANDED_SCHEMA = T.StructType(
    [
        T.StructField("partition_key", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)


def _winners(
    found: list[Row], current: dict[str, tuple]
) -> tuple[dict[str, Row], dict[str, str]]:
    """Per month the file that counts, and why each other file does not.

    Of all files of a month, in this batch and before, the one modified last
    counts, of equal times the greater path; so the order in which files are
    found, and how they fall into batches, change nothing.
    """
    best: dict[str, Row] = {}
    late: dict[str, str] = {}
    for row in sorted(found, key=lambda r: (r["modificationTime"], r["path"])):
        try:
            month = month_of(row["path"])
        except ValueError as error:
            late[row["path"]] = str(error)
            continue
        if month in current and current[month] > (row["modificationTime"], row["path"]):
            late[row["path"]] = f"a newer file of the month is loaded: {current[month][1]}"
            continue
        if month in best:
            late[best[month]["path"]] = f"a newer file of the month has landed: {row['path']}"
        best[month] = row
    return best, late


def load_batch(root: str, after: Callable[[list[str]], None] | None = None):
    """``foreachBatch`` function that loads the files of a batch.

    The stream only finds the files (at most ``FILES_PER_BATCH`` names reach the
    driver). A batch run again after a failure replaces the same months under
    the same run id. Files that cannot be loaded, and files of a month that has
    a newer one, are logged as failed and do not stop the stream.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = batch.select("path", "modificationTime").distinct().collect()
        if not found:
            return
        landed_path, run_id = f"{root.rstrip('/')}/landed_files", f"batch-{batch_id}"
        run_ts = datetime.now(timezone.utc)
        landed = tables.read(spark, landed_path, LANDED_SCHEMA)
        # A row per month; the batch's own rows are those of a run before.
        newest = (
            landed.filter(F.col("run_id") != run_id)
            .groupBy("partition_key")
            .agg(F.max(F.struct("modified_at", "path")).alias("f"))
        )
        current = {r["partition_key"]: (r["f"]["modified_at"], r["f"]["path"]) for r in newest.collect()}
        best, late = _winners(found, current)
        log_failures(spark, root, run_id, late, dict.fromkeys(late, run_ts), [])
        if not best:
            return
        paths = sorted(row["path"] for row in best.values())
        ingest(spark, paths, root, run_ts=run_ts, run_id=run_id, strict=False)
        lineage = tables.read(spark, f"{root.rstrip('/')}/lineage", LINEAGE_SCHEMA)
        loaded = lineage.filter((F.col("run_id") == run_id) & (F.col("status") == "success"))
        done = {r["source_url"] for r in loaded.select("source_url").collect()}
        rows = [(m, r["path"], r["modificationTime"], run_id) for m, r in best.items() if r["path"] in done]
        fresh = spark.createDataFrame(rows, LANDED_SCHEMA).join(
            landed.filter(F.col("run_id") == run_id).select("path"), "path", "left_anti"
        )
        tables.append(fresh, landed_path, LANDED_SCHEMA)
        if after is not None and rows:
            after(sorted(m for m, *_ in rows))

    return load


def watch(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    after: Callable[[list[str]], None] | None = None,
) -> StreamingQuery:
    """Load what has landed since the last run, then stop.

    The files are listed as binary files with their content left unread.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .load(landing)
        .select("path", "modificationTime")
    )
    return (
        files.writeStream.foreachBatch(load_batch(root, after))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
