"""Declarative data checks, all of one table in one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripguard.operators.consent import DRAWN_SOURCE, TABLE_SOURCE

# Values a column may take; null passes.
RISK_LEVELS = ["critical", "high", "moderate", "low"]
PII_TYPES = ["operational_identifier", "quasi_identifier", "location_trace", "financial_attribute"]
HANDLINGS = ["pseudonymize", "generalize", "suppress", "aggregate"]
CONSENT_SOURCES = [DRAWN_SOURCE, TABLE_SOURCE]


def not_null(column: str) -> tuple[str, str, Column]:
    return "not_null", column, F.col(column).isNull()


def accepted_values(column: str, values: list[str]) -> tuple[str, str, Column]:
    return "accepted_values", column, ~F.col(column).isin(values)


def holds(name: str, column: str, condition: Column) -> tuple[str, str, Column]:
    """Rows for which ``condition`` is false; null passes."""
    return name, column, ~condition


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, nulls aside."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def check_table(df: DataFrame, table: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """(table_name, check_name, column_name, failures) per check, one scan."""
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(column).alias("column_name"),
                F.col(f"c{i}").alias("failures"),
            )
            for i, (name, column, _) in enumerate(checks)
        ]
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(rows))


def check_keyed_table(
    df: DataFrame, table: str, key: str, checks: list[tuple[str, str, Column]]
) -> DataFrame:
    """As ``check_table``, and that ``key`` is unique, in one scan and one shuffle."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)]
    )
    again = F.count_if(F.col(key).isNotNull() & (F.col("n") > 1))
    told = [*[(name, column, F.sum(f"c{i}")) for i, (name, column, _) in enumerate(checks)], ("unique", key, again)]
    counted = per_key.agg(*[F.coalesce(n, F.lit(0)).alias(f"f{i}") for i, (_, _, n) in enumerate(told)])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), F.col(f"f{i}").alias("failures")
            )
            for i, (name, column, _) in enumerate(told)
        ]
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(rows))


def checks_report(
    inventory: DataFrame,
    consented: DataFrame,
    ml_mart: DataFrame,
    analytics_mart: DataFrame,
    quality: DataFrame,
    scores: DataFrame,
) -> DataFrame:
    """Every check of the pipeline with its number of failing rows.

    The inventory checks cover the columns the policy names. The risk and
    consent tables share their rows, so their checks share a scan.
    """
    trust = F.col("trust_score")
    parts = [
        check_table(
            inventory.filter("is_policy_match"),
            "pii_inventory",
            [
                not_null("column_name"),
                not_null("pii_type"),
                accepted_values("pii_type", PII_TYPES),
                accepted_values("handling", HANDLINGS),
            ],
        ),
        check_table(
            consented,
            "trip_risk",
            [
                not_null("trip_id"),
                not_null("k_anonymity"),
                accepted_values("risk_level", RISK_LEVELS),
                accepted_values("consent_source", CONSENT_SOURCES),
            ],
        ),
        check_keyed_table(
            ml_mart,
            "mart_ml_safe",
            "trip_pseudonym",
            [not_null("trip_pseudonym"), not_null("k_anonymity")],
        ),
        check_table(
            analytics_mart,
            "mart_analytics_safe",
            [
                not_null("trip_count"),
                not_null("minimum_trip_k"),
                holds("k_anonymous_cell", "trip_count", F.col("trip_count") >= 5),
            ],
        ),
        check_table(
            quality,
            "quality_metrics",
            [
                not_null(c)
                for c in ("total_rows", "completeness_score", "volume_anomaly_score", "data_year")
            ],
        ),
        check_table(
            scores, "trust_scores", [holds("score_range", "trust_score", (trust >= 0) & (trust <= 1))]
        ),
    ]
    report = reduce(lambda a, b: a.unionByName(b), parts)
    return report.withColumn("passed", F.col("failures") == 0)
