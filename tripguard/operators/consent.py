"""Which trips may be used for what."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripguard.functions import drawn

# Consent categories and their opt-in rates.
OPT_IN_RATES = {"ml_training": 0.8, "analytics": 0.9, "operational": 1.0}
DRAWN_SOURCE = "synthetic_demo"
TABLE_SOURCE = "consent_table"
CONSENT_COLUMNS = [f"consent_{category}" for category in OPT_IN_RATES]
# What a ledger may say of a record beyond its status.
LEDGER_COLUMNS = {"expires_at": "timestamp", "collection_source": "string", "audit_ref": "string"}


def with_drawn_consent(trips: DataFrame) -> DataFrame:
    """Flags drawn from the trip id: a projection, no join."""
    flags = {
        f"consent_{category}": drawn(category, F.col("trip_id"), rate)
        for category, rate in OPT_IN_RATES.items()
    }
    return trips.withColumns(flags).withColumn("consent_source", F.lit(DRAWN_SOURCE))


def latest_consent(records: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per subject with a flag per category, from a consent history.

    ``records`` has trip_id, category, status (boolean), effective_at and, if
    the ledger keeps them, expires_at, collection_source and audit_ref. Of the
    records in effect at ``as_of`` the latest counts; with equal times a refusal
    wins, and a consent that has expired by then is a refusal. Without ``as_of``
    all records are in effect and none has expired. A record is one number,
    twice its time plus whether it refuses, so the latest is a plain maximum: a
    subject with any number of records collapses before the shuffle. The last
    record of any category tells where it was collected and its audit event.
    """
    records = records.withColumn("status", F.coalesce("status", F.lit(False)))
    for name in LEDGER_COLUMNS:
        if name not in records.columns:
            records = records.withColumn(name, F.lit(None).cast(LEDGER_COLUMNS[name]))
    holds = "status"
    if as_of is not None:
        now = f"timestamp '{as_of}'"
        records = records.filter(f"cast(effective_at as timestamp) <= {now}")
        holds = f"status and (expires_at is null or cast(expires_at as timestamp) > {now})"
    record = f"2 * unix_micros(cast(effective_at as timestamp)) + int(not ({holds}))"
    last = F.max(F.struct("effective_at", "audit_ref", "collection_source")).alias("_last")
    flags = records.groupBy("trip_id").agg(
        *[
            F.expr(f"pmod(max(if(category = '{c}', {record}, null)), 2) = 0 as consent_{c}")
            for c in OPT_IN_RATES
        ],
        last,
    )
    return flags.select(
        "trip_id",
        *CONSENT_COLUMNS,
        F.col("_last.collection_source").alias("consent_collection_source"),
        F.col("_last.audit_ref").alias("consent_audit_ref"),
    )


def with_consent_table(trips: DataFrame, records: DataFrame, as_of: str | None = None) -> DataFrame:
    """Flags from a consent history; without a record there is no consent,
    except for operations, which need none to be recorded. A record without a
    status counts as a refusal."""
    flags = latest_consent(records, as_of)
    default = {c: F.lit(c == "consent_operational") for c in CONSENT_COLUMNS}
    return trips.join(flags, "trip_id", "left").withColumns(
        {
            **{c: F.coalesce(c, default[c]) for c in CONSENT_COLUMNS},
            "consent_source": F.lit(TABLE_SOURCE),
        }
    )


def consent_in_force(
    trips: DataFrame, records: DataFrame, subject: str, at: str, bucket: str = "day"
) -> DataFrame:
    """Flags from a consent history as it stood at the time ``at`` of each trip.

    ``records`` has the subject, category, status, effective_at and maybe
    expires_at. Of a category's records in effect by then the latest counts;
    with equal times a refusal wins, and one that has expired by then refuses.
    Without a record, or a time, or a subject, there is no consent but to
    operations.

    A subject's history is cut into buckets of time. What a bucket begins with
    comes from one row per subject and bucket; inside it, records and trips are
    put in order. So a subject with any number of trips and records is spread
    over as many groups as its history has days.
    """
    rows = trips.withColumn("_row", F.struct(*trips.columns)).select(
        F.col(subject).alias("_s"), F.col(at).cast("timestamp").alias("_t"), "_row"
    )
    default = {c: F.lit(c == "operational") for c in OPT_IN_RATES}
    dated = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    if "expires_at" not in records.columns:
        records = records.withColumn("expires_at", F.lit(None).cast("timestamp"))
    told = records.select(
        F.col(subject).alias("_s"),
        F.col("effective_at").cast("timestamp").alias("_t"),
        "category",
        F.coalesce("status", F.lit(False)).alias("ok"),
        F.col("expires_at").cast("timestamp").alias("until"),
    ).filter(dated & F.col("category").isin(list(OPT_IN_RATES)))
    # Records of one moment are one: it refuses if any does, and ends with the first.
    told = told.groupBy("_s", "_t", "category").agg(F.min("ok").alias("ok"), F.min("until").alias("until"))
    state = F.struct("_t", "ok", "until")
    states = told.groupBy("_s", "_t").agg(*[F.max(F.when(F.col("category") == c, state)).alias(c) for c in OPT_IN_RATES])
    day = F.date_trunc(bucket, "_t").alias("_b")
    states = states.select("_s", day, "_t", *OPT_IN_RATES)
    nothing = [F.lit(None).cast(states.schema[c].dataType).alias(c) for c in OPT_IN_RATES]
    there = rows.filter(dated).select("_s", day, "_t", "_row")

    buckets = states.drop("_t").unionByName(there.select("_s", "_b", *nothing).distinct())
    ends = buckets.groupBy("_s", "_b").agg(*[F.max(c).alias(c) for c in OPT_IN_RATES])
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_s", "_b", *[F.max(c).over(before).alias(c) for c in OPT_IN_RATES])

    blank = F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")
    line = (
        carried.select("_s", "_b", F.col("_b").alias("_t"), F.lit(0).alias("_k"), *OPT_IN_RATES, blank)
        .unionByName(states.select("_s", "_b", "_t", F.lit(0).alias("_k"), *OPT_IN_RATES, blank))
        .unionByName(there.select("_s", "_b", "_t", F.lit(1).alias("_k"), *nothing, "_row"))
    )
    upto = Window.partitionBy("_s", "_b").orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, 0)
    known = line.select("_t", "_k", "_row", *[F.max(c).over(upto).alias(c) for c in OPT_IN_RATES]).filter("_k = 1")
    flags = {
        c: F.when(
            F.col(c).isNotNull(), F.col(f"{c}.ok") & (F.col(f"{c}.until").isNull() | (F.col(f"{c}.until") > F.col("_t")))
        ).otherwise(default[c])
        for c in OPT_IN_RATES
    }
    with_history = known.select("_row.*", *[flag.alias(f"consent_{c}") for c, flag in flags.items()])
    others = rows.filter(~dated).select("_row.*", *[default[c].alias(f"consent_{c}") for c in OPT_IN_RATES])
    return with_history.unionByName(others)
