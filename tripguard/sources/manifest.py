"""Which month files there are, and what their names say."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.functions import period_label
from tripguard.schemas import era_sql

# How a month file is called.
FILE_PATTERN = r"(\d{4})-(\d{2})\.parquet$"
FILE_TEMPLATE = "yellow_tripdata_{key}.parquet"
FILE_FORMAT = "parquet"


# Year and month of a file as SQL text; its name ends in 'YYYY-MM.parquet'.
FILE_YEAR = "try_cast(substring(source_file, -15, 4) as int)"
FILE_MONTH = "try_cast(substring(source_file, -10, 2) as int)"


def parse_name(path: str) -> tuple[int, int]:
    """(year, month) of a path; a path that is no month file is an error."""
    found = re.search(FILE_PATTERN, path)
    if not found:
        raise ValueError(f"not a month file: {path}")
    return int(found.group(1)), int(found.group(2))


def manifest_of(files: DataFrame, path: str = "source_file") -> DataFrame:
    """One row per distinct file name in column ``path``."""
    names = files.select(F.col(path).alias("url")).distinct()
    parsed = names.withColumns(
        {
            "year": F.regexp_extract("url", FILE_PATTERN, 1).try_cast("int"),
            "month": F.regexp_extract("url", FILE_PATTERN, 2).try_cast("int"),
        }
    ).filter("year is not null and month is not null")
    return parsed.select(
        "year",
        "month",
        "url",
        period_label(F.col("year"), F.col("month")).alias("partition_key"),
        F.lit(FILE_FORMAT).alias("file_format"),
        F.expr(era_sql("year")).alias("schema_version"),
    )


def build_manifest(spark: SparkSession, targets: Iterable[str], base_url: str = "") -> DataFrame:
    """Manifest of the months named by 'YYYY-MM' strings, under ``base_url``."""
    urls = []
    for target in targets:
        year, month = map(int, target.split("-"))
        urls.append((base_url + FILE_TEMPLATE.format(key=f"{year}-{month:02d}"),))
    return manifest_of(spark.createDataFrame(urls, "source_file string"))
