"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.operators import (
    checks,
    consent,
    evolution,
    marts,
    narratives,
    policy,
    quality,
    reports,
    requests,
    retention,
    risk,
    staging,
    trust,
)
from tripguard.operators.identity import with_trip_id
from tripguard.plans import driver_tables as d
from tripguard.sources.manifest import manifest_of
from tripguard.sources.tables import partition_row_counts

Query = Callable[[SparkSession, str], DataFrame]

# What is read of the trips beside their ids: by the risk table, and by the marts.
RISK_SHOWN = ["data_year", "data_month", "schema_version", "pu_location_id", "do_location_id"]
MART_SHOWN = [
    *RISK_SHOWN, "vendor_id", "passenger_count", "trip_distance_miles", "payment_type",
    "fare_amount", "total_amount",
]


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_metrics(d.staged(spark, sf))


def _lineage(spark: SparkSession, sf: str) -> DataFrame:
    return d.lineage(d.unified(spark, sf))


def _evolution(spark: SparkSession, sf: str) -> DataFrame:
    return evolution.schema_evolution(_lineage(spark, sf))


def _trust(spark: SparkSession, sf: str) -> DataFrame:
    trips = d.unified(spark, sf)
    changes = evolution.schema_evolution(d.lineage(trips))
    metrics = quality.quality_metrics(d.staged_of(trips))
    return trust.trust_scores(metrics, evolution.latest_evolution(changes))


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    return risk.equivalence_classes(risk.with_time_parts(d.staged(spark, sf)))


def _risk(spark: SparkSession, sf: str, shown: list[str] = RISK_SHOWN) -> DataFrame:
    return _risk_of(d.staged_table(spark, sf, shown), shown)


def _risk_of(staged: DataFrame, shown: list[str]) -> DataFrame:
    # Classes are counted on the trips before they are identified: an id
    # changes no class, and the count then needs no shuffle of whole rows.
    # They are counted ahead, so the join knows how few they are before it
    # would move the trips a second time.
    classes = d.kept(risk.equivalence_classes(risk.with_time_parts(staged)))
    return risk.with_k(with_trip_id(staged, shown), classes=classes)


def _consented(spark: SparkSession, sf: str, shown: list[str] = MART_SHOWN) -> DataFrame:
    return consent.with_drawn_consent(_risk(spark, sf, shown))


def trip_identity(spark: SparkSession, sf: str) -> DataFrame:
    shown = [
        "source_file", "pickup_at", "dropoff_at", "total_amount", "fare_amount", "tip_amount",
        *policy.PRECISE_LOCATION,
    ]
    return d.identified(spark, sf, shown).select("trip_id", *shown, "duplicate_ordinal")


def _blank(narrow: DataFrame, trips: DataFrame) -> DataFrame:
    """``narrow`` with the other columns of ``trips``, which nothing will look at, as nulls."""
    return narrow.withColumns({c: F.lit(None).cast(t) for c, t in trips.dtypes if c not in narrow.columns})


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    record = ["data_year", "data_month", "fare_amount", "total_amount"]
    return requests.request_outcomes(d.requests(spark, sf), d.identified(spark, sf, record), record)


def _inventory(trips: DataFrame) -> DataFrame:
    candidates = [c for c in trips.columns if c not in ("source_file",)]
    files = evolution.present_columns(trips, candidates)
    columns = files.select(
        F.col("source_file").alias("table_name"), F.explode("columns").alias("column_name")
    )
    return policy.pii_inventory(columns)


def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and times out of text, some of it bad."""
    events = d.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    broken = F.col("event_type") == "error"
    number = F.when(broken, F.concat(F.lit("n/a "), k)).otherwise(k)
    moment = F.when(
        F.col("event_type") == "click", F.lit("someday")
    ).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return events.select(
        "event_id",
        staging.coerce_number(number).alias("number"),
        staging.coerce_zone(number).alias("zone"),
        moment.try_cast("timestamp_ntz").alias("moment"),
    )


def lineage_schema_diff(spark: SparkSession, sf: str) -> DataFrame:
    diff = evolution.schema_diff(d.loads(d.unified(spark, sf)).filter("status = 'success'"))
    return diff.select("partition_key", "ingested_at", "columns_added", "columns_removed")


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    trips = d.unified(spark, sf)
    return evolution.verify_row_counts(partition_row_counts(trips), d.lineage(trips))


def k_anonymity_param(spark: SparkSession, sf: str) -> DataFrame:
    """Other quasi-identifiers, another threshold, with the class as text."""
    keys = ["pu_location_id", "payment_type", "pickup_weekday"]
    trips = risk.with_time_parts(d.staged(spark, sf)).select("data_year", "data_month", *keys)
    return risk.with_k(trips, keys, k=3, label=True)


def generalisation_impact(spark: SparkSession, sf: str) -> DataFrame:
    """Zones to groups of three, weekdays to weekday or weekend."""
    coarser = {
        "pu_location_id": F.expr("pu_location_id div 3"),
        "do_location_id": F.expr("do_location_id div 3"),
        "pickup_day_of_week": F.expr("if(pickup_day_of_week in (1, 7), 1L, 0L)"),
    }
    zones = ["pu_location_id", "do_location_id"]
    trips = d.identified(spark, sf, zones).select("trip_id", *risk.QUASI_IDENTIFIERS)
    classes = d.kept(_classes(spark, sf))
    return risk.generalisation_impact(trips, coarser, classes).select(
        "trip_id", "k_before", "k_after", "risk_before", "risk_after"
    )


def class_diversity(spark: SparkSession, sf: str) -> DataFrame:
    return risk.class_diversity(risk.class_histograms(risk.with_time_parts(d.staged(spark, sf))))


FLAGS = ["trip_id", *consent.CONSENT_COLUMNS]


def consent_joined(spark: SparkSession, sf: str) -> DataFrame:
    return _consented(spark, sf, RISK_SHOWN).select(
        *risk.RISK_COLUMNS, *consent.CONSENT_COLUMNS, "consent_source"
    )


def consent_table_joined(spark: SparkSession, sf: str) -> DataFrame:
    """Flags from a ledger with records yet to come and consents that have expired."""
    joined = consent.with_consent_table(
        d.identified(spark, sf, []), d.consent_records(spark, sf), "2024-01-20"
    )
    return joined.select(
        *FLAGS, "consent_source", "consent_collection_source", "consent_audit_ref"
    )


def consent_in_force(spark: SparkSession, sf: str) -> DataFrame:
    """Users' trips, which are the events, with the consent of their time."""
    trips = d.table(spark, sf, "events").select("event_id", "user_id", "ts")
    return consent.consent_in_force(trips, d.consent_history(spark, sf), "user_id", "ts")


def release_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The mart as released after 2019, and as released with all months."""
    consented = _blank(_consented(spark, sf, RISK_SHOWN), d.staged(spark, sf))
    mart = marts.ml_safe(consented).select("trip_pseudonym", *marts.SHOWN, "data_year")
    both = F.array(F.lit(marts.FIRST), F.lit(marts.SECOND))
    numbers = F.when(F.col("data_year") < 2020, both).otherwise(F.array(F.lit(marts.SECOND)))
    return marts.candidates_left(mart.withColumn("release", F.explode(numbers)))


def privacy_transform(spark: SparkSession, sf: str) -> DataFrame:
    shown = [
        "source_file", "pickup_at", "dropoff_at", *policy.PRECISE_LOCATION,
        "pu_location_id", "do_location_id", "fare_amount",
    ]
    return policy.transform_trips(d.identified(spark, sf, shown).select("trip_id", *shown))


def suppress_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return risk.risk_table(risk.suppress_outliers(_risk(spark, sf)))


def policy_applied(spark: SparkSession, sf: str) -> DataFrame:
    return policy.apply_policy(d.staged(spark, sf))


def retention_applied(spark: SparkSession, sf: str) -> DataFrame:
    kept = retention.suppress_raw(d.identified(spark, sf), d.AS_OF)
    return kept.select("trip_id", *retention.RAW_COLUMNS)


def retention_features(spark: SparkSession, sf: str) -> DataFrame:
    return retention.expire_features(marts.ml_safe(_consented(spark, sf)), d.AS_OF)


def retention_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The audit log as seen seven years on, so that part of it is archived."""
    events = requests.audit_events(_outcomes(spark, sf))
    return retention.mark_archived(events, "2031-01-15").select(
        "event_id", "event_type", "timestamp", "is_archived"
    )


def erasure_filtered(spark: SparkSession, sf: str) -> DataFrame:
    shown = ["data_year", "data_month", "fare_amount"]
    kept = requests.exclude_erased(d.identified(spark, sf, shown), d.requests(spark, sf))
    return kept.select("trip_id", *shown)


def withdrawal_filtered(spark: SparkSession, sf: str) -> DataFrame:
    flags = consent.with_drawn_consent(d.identified(spark, sf, [])).select(*FLAGS)
    return requests.apply_withdrawals(flags, d.requests(spark, sf))


def dsr_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    found = _outcomes(spark, sf)
    return found.select(
        "seq", "trip_id", "kind", "category", "actor", "requested_at", "status",
        "record_found", "record_existed",
        F.col("record.data_year").alias("record_year"),
        F.col("record.fare_amount").alias("record_fare"),
    )


def checks_report(spark: SparkSession, sf: str) -> DataFrame:
    # Trips are unified once, for all sides; those with k and consent are
    # stored with the columns that are checked, for the three checks of them.
    trips = d.stored(d.unified(spark, sf))
    staged = d.staged_of(trips)
    checked = [*risk.RISK_COLUMNS, *consent.CONSENT_COLUMNS, "consent_source"]
    consented = consent.with_drawn_consent(_risk_of(staged, RISK_SHOWN))
    narrow = _blank(d.stored(consented.select(*checked)), staged)
    metrics = d.kept(quality.quality_metrics(staged))
    last = evolution.latest_evolution(evolution.schema_evolution(d.lineage(trips)))
    return checks.checks_report(
        _inventory(staged),
        narrow,
        marts.ml_safe(narrow),
        marts.analytics_safe(narrow),
        metrics,
        trust.trust_scores(metrics, last),
    )


def report_payloads(spark: SparkSession, sf: str) -> DataFrame:
    # A row per month; kept so that seven documents score once.
    trips = d.unified(spark, sf)
    staged = d.staged_of(trips)
    log = d.lineage(trips)
    changes = evolution.schema_evolution(log)
    last = evolution.latest_evolution(changes)
    scores = d.kept(trust.trust_scores(quality.quality_metrics(staged), last))
    return narratives.report_payloads(scores, changes, log, staged)


def narratives_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of all nine shapes by what is typical of each."""
    parsed = narratives.parse_all(d.narratives(spark, sf))
    headlines = [f"{p}.headline" for p in narratives.NARRATIVE_SHAPES if p not in ("lineage", "business_context")]
    numbers = [
        "trust_score.trust_score", "volume_trends.peak.trips", "get(covid_impact.timeline, 0).trips",
        "get(seasonal_patterns.peak_months.months, 0)",
    ]
    details = [
        "lineage.source_system", "get(business_context.good_for, 1)", "trust_score.score_breakdown.validity",
        "get(coverage_gaps.gaps, 0).gap", "get(schema_evolution.changes, 0).period",
        "volume_trends.covid_collapse.bottom_month", "get(covid_impact.timeline, 0).story",
        "fare_evolution.fare_trend", "seasonal_patterns.slow_months.explanation",
    ]
    return parsed.select(
        "pain_point",
        "generated_at",
        F.expr(f"coalesce({', '.join(headlines)})").alias("headline"),
        F.expr(f"coalesce({', '.join(f'cast({n} as double)' for n in numbers)})").alias("number"),
        F.expr(f"coalesce({', '.join(details)})").alias("detail"),
        "raw",
    )


def narratives_selected(spark: SparkSession, sf: str) -> DataFrame:
    chosen = narratives.select_narratives(d.narratives(spark, sf), "coverage_gaps", 2019)
    return chosen.select("pain_point", "data_year", "generated_at", "narrative_json")


def narratives_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return narratives.narrative_headlines(d.narratives(spark, sf)).select(
        "pain_point", "data_year", "generated_at", "headline", "trust_score", "raw"
    )


QUERIES: dict[str, Query] = {
    # ingest
    "file_manifest": lambda s, sf: manifest_of(d.unified(s, sf)),
    "unified_trips": d.unified,
    "coerce_types": coerce_types,
    "stg_trips": d.staged,
    "partition_row_counts": row_counts,
    "sample_rows": lambda s, sf: staging.sample_rows(d.staged(s, sf), 2019),
    "lineage_history": lambda s, sf: evolution.lineage_history(_lineage(s, sf), "trips.unified"),
    "lineage_changes": lambda s, sf: evolution.lineage_changes(_lineage(s, sf)),
    "schema_diff": lineage_schema_diff,
    "loaded_years": lambda s, sf: staging.loaded_years(d.unified(s, sf)),
    # quality and trust
    "quality_metrics": _quality,
    "quality_for_year": lambda s, sf: trust.trust_for_year(_quality(s, sf), 2019),
    "schema_evolution": _evolution,
    "latest_evolution": lambda s, sf: evolution.latest_evolution(_evolution(s, sf)),
    "trust_scores": _trust,
    "trust_for_year": lambda s, sf: trust.trust_for_year(_trust(s, sf), 2019),
    "score_bands": lambda s, sf: trust.score_bands(_trust(s, sf)),
    "risk_driver": lambda s, sf: trust.risk_drivers(_trust(s, sf)),
    # privacy
    "trip_identity": trip_identity,
    "equivalence_classes": _classes,
    "k_anonymity_param": k_anonymity_param,
    "reid_risk": lambda s, sf: risk.risk_table(_risk(s, sf)),
    "risk_summary": lambda s, sf: risk.risk_summary(_classes(s, sf)),
    "min_k_pivot": lambda s, sf: risk.min_k_pivot(_classes(s, sf)),
    "suppress_outliers": suppress_outliers,
    "generalisation_impact": generalisation_impact,
    "least_generalisation": lambda s, sf: risk.least_generalisation(d.kept(_classes(s, sf))),
    "class_diversity": class_diversity,
    "consent_flags": lambda s, sf: consent.with_drawn_consent(d.identified(s, sf, [])).select(
        *FLAGS, "consent_source"
    ),
    "consent_joined": consent_joined,
    "consent_table_joined": consent_table_joined,
    "consent_in_force": consent_in_force,
    "mart_ml_safe": lambda s, sf: marts.ml_safe(_consented(s, sf)),
    "mart_analytics_safe": lambda s, sf: marts.analytics_safe(_consented(s, sf)),
    "recoverable_cells": lambda s, sf: marts.recoverable_cells(marts.all_cells(_consented(s, sf, RISK_SHOWN))),
    "release_candidates": release_candidates,
    "privacy_transform": privacy_transform,
    "pii_inventory": lambda s, sf: _inventory(d.staged(s, sf)),
    "pii_handling_counts": lambda s, sf: policy.handling_counts(_inventory(d.staged(s, sf))),
    "policy_applied": policy_applied,
    "retention_applied": retention_applied,
    "retention_features": retention_features,
    "retention_audit": retention_audit,
    "erasure_filtered": erasure_filtered,
    "withdrawal_filtered": withdrawal_filtered,
    "dsr_outcomes": dsr_outcomes,
    "audit_events": lambda s, sf: requests.audit_events(_outcomes(s, sf)),
    # reports
    "year_summary": lambda s, sf: reports.year_summary(_trust(s, sf)),
    "year_over_year": lambda s, sf: reports.year_over_year(reports.year_summary(_trust(s, sf))),
    "seasonal_profile": lambda s, sf: reports.seasonal_profile(_trust(s, sf)),
    "peak_trough": lambda s, sf: reports.peak_trough(_trust(s, sf)),
    "fare_per_mile_year": lambda s, sf: reports.fare_per_mile_year(_trust(s, sf)),
    "volume_by_era": lambda s, sf: reports.volume_by_era(_quality(s, sf)),
    "volume_trend": lambda s, sf: reports.volume_trend(_trust(s, sf)),
    "shock_year": lambda s, sf: reports.shock_year(_trust(s, sf)),
    "fare_evolution": lambda s, sf: reports.fare_evolution(_trust(s, sf)),
    "month_review": lambda s, sf: reports.month_review(_trust(s, sf)),
    "representative_month": lambda s, sf: reports.representative_month(_trust(s, sf)),
    "report_payloads": report_payloads,
    "latest_narratives": lambda s, sf: narratives.latest_narratives(d.narratives(s, sf)),
    "narratives_parsed": narratives_parsed,
    "narratives_typed": narratives_typed,
    "narratives_selected": narratives_selected,
    # checks
    "checks_report": checks_report,
}
