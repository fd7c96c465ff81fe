"""Documents to packed training sequences, a stage at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm import decontaminate, lines, packing, quality, simhash
from tripguard.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores a half or more."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that another document's line, or an earlier one, stands for.

    A document with nothing but such lines stays, with an empty text; the next
    stage joins it to the other empty ones. ``n_chars`` follows the text.
    """
    kept = lines.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    changed = F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.drop_near_copies(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place."""
    return packing.pack(docs, packing.whitespace_tokens(F.col("text")))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("lines", distinct_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", clean_of_benchmarks),
    ("packing", packed_sequences),
]

# Scores, MinHash and packing are not SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
