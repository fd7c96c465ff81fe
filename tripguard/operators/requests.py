"""Data subject requests in bulk, and the audit events they leave.

Requests are rows (seq, trip_id, kind, category, actor, requested_at) with kind
access, erasure or withdrawal. State is these rows, never driver memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCESS, ERASURE, WITHDRAWAL = "access", "erasure", "withdrawal"

# Audit vocabulary.
EVENT_TYPES = {
    ACCESS: "dsr_access_request", ERASURE: "dsr_erasure_request", WITHDRAWAL: "consent_withdrawal",
}
GDPR_ARTICLES = {
    ACCESS: "GDPR Article 15", ERASURE: "GDPR Article 17", WITHDRAWAL: "GDPR Article 7",
}
CCPA_SECTIONS = {ERASURE: "CCPA Section 1798.105"}
ERASURE_ACTION = "exclude_from_privacy_marts"

# Ids up to which a scan is told what it is looked through for.
LISTED_IDS = 200


def _by_kind(values: dict[str, str]) -> Column:
    chain = F
    for kind, value in values.items():
        chain = chain.when(F.col("kind") == kind, F.lit(value))
    return chain


def first_erasures(requests: DataFrame) -> DataFrame:
    """The erasure that counts, per trip."""
    return (
        requests.filter(F.col("kind") == ERASURE)
        .groupBy("trip_id")
        .agg(F.min("seq").alias("erased_at_seq"))
    )


def trips_of(trips: DataFrame, asked: DataFrame, listed: int = LISTED_IDS) -> DataFrame:
    """The rows of ``trips`` with a ``trip_id`` of ``asked``.

    Up to ``listed`` ids become a filter of the scan, and the Bloom filters of
    ``tables.overwrite_months`` skip row groups without any of them. More ids
    are joined. Both give the same rows.
    """
    ids = asked.filter(F.col("trip_id").isNotNull()).select("trip_id").distinct()
    few = [row[0] for row in ids.limit(listed + 1).collect()]
    if len(few) > listed:
        return trips.join(ids, "trip_id", "left_semi")
    return trips.filter(F.col("trip_id").isin(few))


def request_outcomes(requests: DataFrame, trips: DataFrame, record: list[str]) -> DataFrame:
    """Answer every request against ``trips`` (one row per trip_id).

    Access finds a trip unless an earlier request erased it; erasure reports
    whether the trip existed, earlier erasures aside; withdrawal always holds.
    Earlier erasures come from an aggregate and a join, not from a running
    window, so a subject with any number of requests is no single task's work.
    """
    wanted = requests.filter(F.col("kind") != WITHDRAWAL).select("trip_id").distinct()
    known = trips.join(wanted, "trip_id", "left_semi").select(
        "trip_id", F.struct("trip_id", *record).alias("_record")
    )
    joined = requests.join(first_erasures(requests), "trip_id", "left").join(
        known, "trip_id", "left"
    )
    exists = F.col("_record").isNotNull()
    erased = F.coalesce(F.col("erased_at_seq") < F.col("seq"), F.lit(False))
    access, erasure = F.col("kind") == ACCESS, F.col("kind") == ERASURE
    found = exists & ~erased
    return joined.select(
        "seq",
        "trip_id",
        "kind",
        "category",
        "actor",
        "requested_at",
        F.when(access & found, F.lit("found"))
        .when(access, F.lit("not_found"))
        .when(erasure, F.lit("marked_for_erasure"))
        .otherwise(F.lit("withdrawn"))
        .alias("status"),
        F.when(access, found).alias("record_found"),
        F.when(erasure, exists).alias("record_existed"),
        F.when(access & found, F.col("_record")).alias("record"),
    )


def audit_events(outcomes: DataFrame) -> DataFrame:
    """One audit event per outcome.

    Ids are derived from the request, so writing the events again after a
    failure yields the same ones.
    """
    options = {"ignoreNullFields": "false"}
    details = (
        F.when(F.col("kind") == ACCESS, F.to_json(F.struct("record_found"), options))
        .when(
            F.col("kind") == ERASURE,
            F.to_json(
                F.struct(F.lit(ERASURE_ACTION).alias("downstream_action"), "record_existed"), options
            ),
        )
        .otherwise(
            F.to_json(
                F.struct(
                    "category",
                    F.concat(F.lit("exclude_from_"), F.col("category")).alias("downstream_action"),
                ),
                options,
            )
        )
    )
    identity = F.concat_ws("|", F.col("seq").cast("string"), "kind", "trip_id")
    return outcomes.select(
        F.substring(F.sha2(identity, 256), 1, 32).alias("event_id"),
        _by_kind(EVENT_TYPES).alias("event_type"),
        "actor",
        "trip_id",
        _by_kind(GDPR_ARTICLES).alias("gdpr_article"),
        _by_kind(CCPA_SECTIONS).alias("ccpa_section"),
        F.col("requested_at").alias("timestamp"),
        details.alias("details_json"),
    )


def exclude_erased(trips: DataFrame, requests: DataFrame) -> DataFrame:
    """Trips without those marked for erasure."""
    return trips.join(first_erasures(requests).select("trip_id"), "trip_id", "left_anti")


def withdrawals(requests: DataFrame) -> DataFrame:
    """Withdrawn categories, each once per trip."""
    return (
        requests.filter(F.col("kind") == WITHDRAWAL)
        .select("trip_id", "category")
        .distinct()
    )


def apply_withdrawals(consented: DataFrame, requests: DataFrame) -> DataFrame:
    """Turn off the consent flags that were withdrawn."""
    prefix = "consent_"
    categories = [c[len(prefix):] for c, kind in consented.dtypes if c.startswith(prefix) and kind == "boolean"]
    gone = (
        requests.filter(F.col("kind") == WITHDRAWAL)
        .groupBy("trip_id")
        .agg(*[F.bool_or(F.col("category") == c).alias(f"_no_{c}") for c in categories])
    )
    withdrawn = {c: F.coalesce(f"_no_{c}", F.lit(False)) for c in categories}
    return (
        consented.join(gone, "trip_id", "left")
        .withColumns({prefix + c: F.col(prefix + c) & ~withdrawn[c] for c in categories})
        .select(*consented.columns)
    )
