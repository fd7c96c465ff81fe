"""Narrative texts: the facts they are written from, and reading them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripguard.operators import reports
from tripguard.operators.staging import SAMPLE_COLUMNS, SAMPLE_ORDER, first_rows_by_year

# Fields of a narrative by pain point.
NARRATIVE_SHAPES = {
    "lineage": "source_system string, business_process string, ingestion_summary string, transformation_summary string, trust_implication string",
    "business_context": "dataset_summary string, good_for array<string>, not_good_for array<string>, key_entities array<string>, grain string",
    "trust_score": "trust_score double, trust_label string, headline string, score_breakdown struct<completeness: string, volume_anomaly: string, validity: string, consistency: string>, red_flags array<string>, safe_to_use_for string, not_safe_to_use_for string",
    "coverage_gaps": "headline string, gaps array<struct<gap: string, explanation: string, example_bad_question: string>>, assumption_traps array<string>",
    "schema_evolution": "headline string, changes array<struct<period: string, change_type: string, what_changed: string, business_impact: string, null_explanation: string>>, historical_null_warning string, recommended_action string",
    "volume_trends": "headline string, peak struct<period: string, trips: bigint, context: string>, decline_story string, covid_collapse struct<bottom_month: string, bottom_trips: bigint, pct_drop_from_peak: string, narrative: string>, recovery string, key_insight string",
    "covid_impact": "headline string, timeline array<struct<month: int, trips: bigint, story: string>>, fare_behavior string, distance_behavior string, bottom_line string",
    "fare_evolution": "headline string, fare_trend string, distance_trend string, fare_per_mile_story string, covid_fare_behavior string, competitive_context string",
    "seasonal_patterns": "headline string, peak_months struct<months: array<int>, explanation: string>, slow_months struct<months: array<int>, explanation: string>, seasonal_story string, business_implication string",
}
# Points told per year; the others span all data.
YEARLY_POINTS = ["business_context", "trust_score", "coverage_gaps"]
ROWS_SHOWN = 10

# Documents show nulls, and times to the microsecond.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": TIME_FORMAT,
    "timestampNTZFormat": TIME_FORMAT,
}


def select_narratives(
    narratives: DataFrame, pain_point: str | None = None, year: int | None = None
) -> DataFrame:
    """Narratives of a pain point and year, newest first."""
    if pain_point is not None:
        narratives = narratives.filter(F.col("pain_point") == pain_point)
    if year is not None:
        narratives = narratives.filter(F.col("data_year") == year)
    return narratives.orderBy(F.col("generated_at").desc())


def latest_narratives(narratives: DataFrame) -> DataFrame:
    """The newest text per pain point, and per year where the point is yearly.

    An aggregate: a point with any number of texts sends one row per task.
    """
    yearly = F.col("pain_point").isin(YEARLY_POINTS)
    year = F.when(yearly, F.col("data_year")).alias("data_year")
    last = F.max(F.struct("generated_at", "narrative_json")).alias("last")
    return narratives.groupBy("pain_point", year).agg(last).select(
        "pain_point", "data_year", "last.generated_at", "last.narrative_json"
    )


def parse_narratives(narratives: DataFrame, pain_point: str) -> DataFrame:
    """Texts of one pain point as typed columns; ``raw`` holds what is no JSON."""
    shape = NARRATIVE_SHAPES[pain_point]
    text = F.col("narrative_json")
    chosen = narratives.filter(F.col("pain_point") == pain_point)
    return chosen.withColumn("_parsed", F.from_json(text, shape)).select(
        *narratives.columns,
        "_parsed.*",
        F.when(F.try_parse_json(text).isNull(), text).alias("raw"),
    )


def parse_all(narratives: DataFrame) -> DataFrame:
    """A typed column per pain point, null but in its own texts, in one scan."""
    text = F.col("narrative_json")
    typed = [
        F.when(F.col("pain_point") == point, F.from_json(text, shape)).alias(point)
        for point, shape in NARRATIVE_SHAPES.items()
    ]
    return narratives.select(
        *narratives.columns, *typed, F.when(F.try_parse_json(text).isNull(), text).alias("raw")
    )


def narrative_headlines(narratives: DataFrame) -> DataFrame:
    """Of any pain point: headline and trust score if given, else the raw text."""
    text = F.col("narrative_json")
    parsed = narratives.withColumn("_json", F.try_parse_json(text))
    return parsed.select(
        *narratives.columns,
        F.try_variant_get("_json", "$.headline", "string").alias("headline"),
        F.try_variant_get("_json", "$.trust_score", "double").alias("trust_score"),
        F.when(F.col("_json").isNull(), text).alias("raw"),
    )


def _document(rows: DataFrame, by: list[Column], point: str, order: list[str], fields: list[str]) -> DataFrame:
    """One JSON array per group, rows in ``order``."""
    shown = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.struct(*fields).alias("row"))
    ordered = F.transform(F.array_sort(F.collect_list(shown)), lambda item: item["row"])
    return (
        rows.groupBy(*by)
        .agg(F.to_json(ordered, JSON_OPTIONS).alias("payload_json"))
        .select(
            F.lit(point).alias("pain_point"),
            F.col("data_year").cast("int").alias("data_year"),
            "payload_json",
        )
    )


def report_payloads(
    scores: DataFrame,
    evolution: DataFrame,
    lineage: DataFrame,
    staged: DataFrame,
    rows_shown: int = ROWS_SHOWN,
) -> DataFrame:
    """The facts behind each narrative, one JSON document per point and year.

    Every document holds months, loads of a year's months, or the first few
    sample rows of a year, so none grows with the trips. The load log is split
    by year of the month loaded. ``scores`` should be a table or checkpoint: it
    has a row per month, and seven documents read it.
    """
    whole = [F.lit(None).cast("int").alias("data_year")]
    yearly = [F.col("data_year")]
    trend = reports.volume_trend(scores)
    shock = reports.shock_year(scores).withColumn("data_year", F.lit(reports.SHOCK_YEAR))
    fares = reports.fare_evolution(scores)
    seasons = reports.seasonal_profile(scores)
    first = reports.representative_month(scores)
    load_year = F.split("partition_key", "-").getItem(0).try_cast("int")
    loads = lineage.withColumn("data_year", load_year)
    changes = evolution.withColumn("data_year", load_year)

    sample = first_rows_by_year(staged, rows_shown)
    shown = _document(sample, yearly, "business_context", SAMPLE_ORDER, SAMPLE_COLUMNS)
    points = F.explode(F.array(F.lit("business_context"), F.lit("coverage_gaps")))
    lineage_fields = [
        "partition_key", "schema_version", "source_format", "source_url", "row_count",
        "column_count", "columns_added", "columns_removed", "transformation_steps",
        "ingested_at", "status",
    ]
    documents = [
        _document(loads, yearly, "lineage", ["ingested_at", "partition_key"], lineage_fields),
        _document(changes, yearly, "schema_evolution", ["ingested_at", "partition_key"],
                  [c for c in evolution.columns]),
        _document(first, yearly, "trust_score", ["data_month"], first.columns),
        shown.select(points.alias("pain_point"), "data_year", "payload_json"),
        _document(trend, whole, "volume_trends", ["year", "month"], trend.columns),
        _document(shock, yearly, "covid_impact", ["month"], [c for c in shock.columns if c != "data_year"]),
        _document(fares, whole, "fare_evolution", ["year", "month"], fares.columns),
        _document(seasons, whole, "seasonal_patterns", ["data_month"], seasons.columns),
    ]
    return reduce(lambda a, b: a.unionByName(b), documents)
