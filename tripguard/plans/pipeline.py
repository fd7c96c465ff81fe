"""The models as one job over tables, month by month where that suffices.

Trip ids and class counts of a month depend on that month alone, so a run only
recomputes the months it is given. k-anonymity spans all months: it is summed
from the class counts and joined to the kept, already identified trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

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
    trust,
)
from tripguard.operators.identity import with_trip_id
from tripguard.operators.staging import stage
from tripguard.schemas import AUDIT_SCHEMA, LINEAGE_SCHEMA, NARRATIVE_SCHEMA
from tripguard.session import prepare
from tripguard.sources import tables
from tripguard.sources.ingest import Layout, read_trips

REQUEST_COLUMNS = "seq long, trip_id string, kind string, category string, actor string, requested_at timestamp"
IDENTIFIED = "identified_trips"
# What an access request is told of a trip.
RECORD_COLUMNS = ["data_year", "data_month", "fare_amount", "total_amount"]
_MONTH_FIELDS = [T.StructField("data_year", T.IntegerType()), T.StructField("data_month", T.IntegerType())]
MONTH_SCHEMA = T.StructType(_MONTH_FIELDS)
PICKUP_SCHEMA = T.StructType([T.StructField("pickup_at", T.TimestampType()), *_MONTH_FIELDS])
# What the tables made from consented trips need of a trip.
CONSENTED_COLUMNS = [
    "trip_id", "data_year", "data_month", "schema_version", *risk.QUASI_IDENTIFIERS, "vendor_id",
    "passenger_count", "trip_distance_miles", "payment_type", "fare_amount", "total_amount",
]


def _in_months(df: DataFrame, months: list[str] | None) -> DataFrame:
    if months is None:
        return df
    keys = [tuple(map(int, m.split("-"))) for m in months]
    chosen = " or ".join(f"(data_year = {y} and data_month = {m})" for y, m in keys) or "false"
    return df.filter(chosen)


def _months_of(spark: SparkSession, path: str) -> set[tuple[int, int]]:
    """Months that a derived table has folders for; none if it was never written."""
    return tables.months_in(tables.read(spark, path, MONTH_SCHEMA))


def update_months(
    spark: SparkSession, root: str, months: list[str] | None = None, as_of: str | None = None
) -> None:
    """Identify trips and count classes and quality, for the months given or all.

    Counts need no ids, so they come from the staged trips, by a scan of a few
    columns each. A month left without valid trips leaves all three tables.
    With ``as_of``, precise times and places past the raw window are not kept.
    """
    at = Layout(root)
    staged = stage(_in_months(read_trips(spark, root), months))
    present = tables.months_in(staged)
    given = None if months is None else {tuple(map(int, m.split("-"))) for m in months}
    identified = with_trip_id(staged)
    if as_of is not None:
        identified = retention.suppress_raw(identified, as_of)
    per_month = risk.with_time_parts(staged).groupBy("data_year", "data_month", *risk.QUASI_IDENTIFIERS)
    for rows, path in (
        (identified, at.identified_trips),
        (per_month.agg(F.count(F.lit(1)).alias("k_anonymity")), at.class_counts),
        (quality.monthly_counts(staged), at.monthly_counts),
    ):
        wanted = _months_of(spark, path) if given is None else given
        lookup = "trip_id" if rows is identified else None
        tables.overwrite_months(rows, path, shuffled=True, emptied=wanted - present, lookup=lookup)


def expired_months(spark: SparkSession, root: str, as_of: str) -> list[str]:
    """Months with precise times that are past the raw window by ``as_of``."""
    trips = tables.read(spark, Layout(root).identified_trips, PICKUP_SCHEMA)
    late = retention.past_raw_window(trips, as_of)
    return sorted(f"{y}-{m:02d}" for y, m in tables.months_in(late))


def score(spark: SparkSession, root: str, run_ts: str) -> None:
    """Quality, schema history and trust, from a row per month and load."""
    at = Layout(root)
    now = F.lit(run_ts).cast("timestamp")
    metrics = quality.score_months(spark.read.parquet(at.monthly_counts))
    tables.replace(metrics.withColumn("computed_at", now), at.quality_metrics)
    lineage = tables.read(spark, at.lineage, LINEAGE_SCHEMA)
    tables.replace(evolution.schema_evolution(lineage), at.schema_evolution)
    scores = trust.trust_scores(
        spark.read.parquet(at.quality_metrics),
        evolution.latest_evolution(spark.read.parquet(at.schema_evolution)),
    )
    tables.replace(scores.withColumn("scored_at", now), at.trust_scores)


def consented_trips(
    spark: SparkSession,
    root: str,
    asked: DataFrame | None = None,
    consents: DataFrame | None = None,
    consents_as_of: str | None = None,
    months: list[str] | None = None,
    sizes: str | None = None,
) -> DataFrame:
    """Identified trips with k, consent and privacy requests applied, of the months given or all.

    ``consents`` is a consent history, of which records in effect by
    ``consents_as_of`` count; without it the flags are drawn.
    """
    at = Layout(root)
    trips = _in_months(spark.read.parquet(at.identified_trips), months).select(*CONSENTED_COLUMNS)
    scored = risk.with_k(trips, classes=spark.read.parquet(sizes or at.class_sizes))
    if asked is not None:
        scored = requests.exclude_erased(scored, asked)
    if consents is None:
        flagged = consent.with_drawn_consent(scored)
    else:
        flagged = consent.with_consent_table(scored, consents, consents_as_of)
    return flagged if asked is None else requests.apply_withdrawals(flagged, asked)


def _class_sizes(spark: SparkSession, root: str, asked: DataFrame | None) -> DataFrame:
    """Class sizes over all months, without trips that were erased."""
    at = Layout(root)
    sizes = risk.merge_class_counts(spark.read.parquet(at.class_counts))
    if asked is None:
        return sizes
    erased = requests.first_erasures(asked).select("trip_id")
    gone = requests.trips_of(spark.read.parquet(at.identified_trips), erased)
    return risk.subtract_classes(sizes, risk.equivalence_classes(gone))


def months_to_redo(spark: SparkSession, root: str, months: list[str], sizes: str) -> list[str]:
    """``months``, and those with a trip of a class that the new sizes put at another risk level."""
    at = Layout(root)
    changed = risk.changed_classes(spark.read.parquet(at.class_sizes), spark.read.parquet(sizes))
    counts = spark.read.parquet(at.class_counts).select("data_year", "data_month", *risk.QUASI_IDENTIFIERS)
    touched = risk.join_classes(counts, changed, risk.QUASI_IDENTIFIERS, [])
    return sorted({*months, *(f"{y}-{m:02d}" for y, m in tables.months_in(touched))})


def _store(rows: DataFrame, path: str, months: list[str] | None) -> None:
    """Replace a monthly table, or only these months of it."""
    if months is None:
        tables.replace(rows, path, monthly=True)
        return
    gone = {tuple(map(int, m.split("-"))) for m in months} - tables.months_in(rows)
    tables.overwrite_months(rows, path, shuffled=True, emptied=gone)


def publish(
    spark: SparkSession,
    root: str,
    run_ts: str,
    salt: str,
    asked: DataFrame | None = None,
    consents: DataFrame | None = None,
    as_of: str | None = None,
    keyed: bool = True,
    months: list[str] | None = None,
) -> list[str] | None:
    """Consented trips, risk table, PII inventory and both marts.

    The class sizes are written first: their size on disk then decides whether
    the join with the trips broadcasts them. Trips are joined once, into the
    table of consented trips; risk table, marts and checks read that by month.
    ``salt`` is a secret of the publisher; ``keyed`` uses it as an HMAC key.

    ``months`` are all that has changed since the last time with the same salt.
    Only they, and the months with a trip of a class that has crossed a risk
    level or lost a record, are then written again; they are returned. In all
    others every row is where a whole run would put it, with the same flags and
    level; ``k_anonymity`` there is the size when it was written, which is at
    most the present one in ``class_sizes`` (``risk.with_current_k``). The new
    sizes replace the old ones last, so a run that fails is repeated in full.
    Requests, a consent ledger and retention reach any month: with one of them
    everything is written.
    """
    at = Layout(root)
    now = F.lit(run_ts).cast("timestamp")
    sizes = _class_sizes(spark, root, asked)
    whole = months is None or asked is not None or consents is not None or as_of is not None
    if whole:
        months, path = None, at.class_sizes
        tables.replace(sizes, path)
    else:
        path = at.class_sizes_next
        tables.replace(sizes, path)
        months = months_to_redo(spark, root, months, path)
    flagged = consented_trips(spark, root, asked, consents, run_ts, months, path)
    _store(flagged, at.consented_trips, months)
    consented = _in_months(tables.load(spark, at.consented_trips), months)
    _store(risk.risk_table(consented).withColumn("scored_at", now), at.reidentification_risk, months)
    inventory = policy.pii_inventory(
        policy.columns_frame(spark, {IDENTIFIED: stage(read_trips(spark, root)).columns})
    )
    tables.replace(inventory.withColumn("inventoried_at", now), at.pii_inventory)

    rows = marts.ml_safe(consented, salt, keyed)
    if as_of is not None:
        rows = retention.expire_features(rows, as_of)
    marts.assert_no_forbidden_columns(rows)
    _store(rows, at.mart_ml_safe, months)
    cells = marts.analytics_safe(consented)
    _store(cells.withColumn("aggregated_at", now), at.mart_analytics_safe, months)
    if not whole:
        tables.replace(spark.read.parquet(path), at.class_sizes)
    return months


def answer_requests(spark: SparkSession, root: str, asked: DataFrame, record: list[str]) -> DataFrame:
    """Outcomes of all requests; their audit events are appended once each."""
    at = Layout(root)
    wanted = asked.filter(F.col("kind") != requests.WITHDRAWAL)
    trips = requests.trips_of(spark.read.parquet(at.identified_trips), wanted)
    outcomes = requests.request_outcomes(asked, trips, record)
    known = tables.read(spark, at.audit_log, AUDIT_SCHEMA).select("event_id")
    new = requests.audit_events(outcomes).join(known, "event_id", "left_anti")
    tables.append(new, at.audit_log, AUDIT_SCHEMA)
    return outcomes


def archive_audit(spark: SparkSession, root: str, as_of: str) -> None:
    """Copy audit events past their window to the archive, each once; none is deleted."""
    at = Layout(root)
    events = tables.read(spark, at.audit_log, AUDIT_SCHEMA)
    old = retention.mark_archived(events, as_of).filter("is_archived")
    there = tables.read(spark, at.audit_archive, AUDIT_SCHEMA).select("event_id")
    tables.append(old.join(there, "event_id", "left_anti"), at.audit_archive, AUDIT_SCHEMA)


def current_audit(spark: SparkSession, root: str) -> DataFrame:
    """Audit events that are not in the archive."""
    at = Layout(root)
    there = tables.read(spark, at.audit_archive, AUDIT_SCHEMA).select("event_id")
    return tables.read(spark, at.audit_log, AUDIT_SCHEMA).join(there, "event_id", "left_anti")


def check(spark: SparkSession, root: str) -> DataFrame:
    """All data checks over the written tables."""
    at = Layout(root)
    read, mart = spark.read.parquet, tables.load(spark, at.mart_ml_safe)
    marts.assert_no_forbidden_columns(mart)
    return checks.checks_report(
        read(at.pii_inventory),
        tables.load(spark, at.consented_trips),
        mart,
        tables.load(spark, at.mart_analytics_safe),
        read(at.quality_metrics),
        read(at.trust_scores),
    )


def report(spark: SparkSession, root: str) -> None:
    """Year summaries and narrative payloads, from the score tables."""
    at = Layout(root)
    scores = spark.read.parquet(at.trust_scores).drop("scored_at")
    summary = reports.year_summary(scores)
    tables.replace(summary, at.year_summary)
    tables.replace(reports.year_over_year(spark.read.parquet(at.year_summary)), at.year_over_year)
    payloads = narratives.report_payloads(
        scores,
        spark.read.parquet(at.schema_evolution),
        tables.read(spark, at.lineage, LINEAGE_SCHEMA),
        spark.read.parquet(at.identified_trips),
    )
    tables.replace(payloads, at.report_payloads)


def append_narratives(spark: SparkSession, root: str, texts: DataFrame) -> None:
    tables.append(texts, Layout(root).narratives, NARRATIVE_SCHEMA)


def run(
    spark: SparkSession,
    root: str,
    run_ts: str,
    salt: str,
    months: list[str] | None = None,
    asked: DataFrame | None = None,
    consents: DataFrame | None = None,
    as_of: str | None = None,
    keyed: bool = True,
    incremental: bool = False,
) -> DataFrame:
    """Everything after ingest; returns the checks report.

    ``asked`` are privacy requests: they are answered and logged, and erasures
    and withdrawals reach everything published. ``as_of`` applies the three
    retention windows: months whose precise times have passed the raw window
    since the last run are done again, old features leave the mart, and old
    audit events go to the archive. ``incremental`` publishes only what
    ``months`` change (see ``publish``).
    """
    prepare(spark)
    if as_of is not None and months is not None:
        months = sorted({*months, *expired_months(spark, root, as_of)})
    update_months(spark, root, months, as_of)
    score(spark, root, run_ts)
    if asked is not None:
        tables.replace(answer_requests(spark, root, asked, RECORD_COLUMNS), Layout(root).request_outcomes)
    publish(spark, root, run_ts, salt, asked, consents, as_of, keyed, months if incremental else None)
    if as_of is not None:
        archive_audit(spark, root, as_of)
    report(spark, root)
    return check(spark, root)
