"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripguard.llm.common import table

MIN_CHARS = 512
MAX_CHARS = 8192


def chunk_pattern(min_chars: int, max_chars: int) -> str:
    """A chunk ends at the first line or sentence end from ``min_chars`` on.

    Without one it ends at ``max_chars``; what is left at the end is a chunk.
    """
    return (
        rf"(?s).{{{min_chars},{max_chars}}}?(?:\n|[.!?] |\z)"
        rf"|.{{{max_chars}}}|.+\z"
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are cut where their content says so. Distinct chunks get verified
    identifiers: the 64-bit hash of the chunk, and an ordinal that tells chunks
    of one hash apart by SHA-256. Texts are equal when their ordered lists of
    identifiers are. Only hashes move; no text leaves the task that read it.

    The largest id of a group stays. Null text counts as empty, and empty texts
    are equal. Of repeated rows of one id and text, one is kept. Ids that are
    null never win over others; a group of null ids only keeps one row. Extra
    columns are ignored.
    """
    source = docs.select(
        F.col(id_col).alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("t")
    )
    pattern = F.lit(chunk_pattern(min_chars, max_chars))
    pieces = source.select(
        "d",
        F.sha2("t", 256).alias("s"),
        F.posexplode_outer(F.regexp_extract_all("t", pattern, F.lit(0))).alias("p", "c"),
    ).select(
        "d",
        "s",
        "p",
        F.when(F.col("c").isNotNull(), F.xxhash64("c")).alias("h"),
        F.unhex(F.sha2("c", 256)).alias("v"),
    )
    alike = Window.partitionBy("h").orderBy("v")
    clashes = (
        pieces.select("h", "v")
        .filter("h is not null")
        .distinct()
        .withColumn("o", F.row_number().over(alike) - 1)
        .filter("o > 0")
    )
    identified = pieces.join(clashes, ["h", "v"], "left").withColumn(
        "part", F.when(F.col("h").isNotNull(), F.struct("p", "h", F.coalesce("o", F.lit(0)).alias("o")))
    )
    lists = identified.groupBy("d", "s").agg(
        F.array_sort(F.collect_set("part")).alias("recipe"),
        F.count(F.when(F.coalesce("p", F.lit(0)) == 0, 1)).alias("copies"),
    )
    groups = lists.groupBy(F.col("recipe").alias("r")).agg(
        F.max("d").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    return (
        lists.join(groups, F.col("recipe") == F.col("r"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
        .select(
            F.col("d").alias(id_col),
            "keep_id",
            "group_size",
            ((F.col("copy") == 1) & F.col("d").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.col("s").alias("text_sha256"),
        )
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""
