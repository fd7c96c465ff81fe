"""Trips, load log, requests, consents and narratives derived from test tables.

The test tables hold no trips. Order lines, moved twenty years, stand in for
the first three eras; events, which lie in 2024, for the last. All of it is
derived by Spark and grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.operators import evolution
from tripguard.operators.identity import columns_for, with_trip_id
from tripguard.operators.staging import stage
from tripguard.session import ensure_checkpoint_dir, prepare
from tripguard.sources.unify import unify

INGESTED_AT = "2024-02-01 00:00:00"
AS_OF = "2024-06-01"


MONTH_FILE = (
    "concat('yellow_tripdata_', year({0}), '-', lpad(month({0}), 2, '0'), '.parquet')"
)


# Stated rather than inferred, which would take a job per read.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double,"
    " props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by a key, so that a table in one row group gets tasks; the
    join of large tables on it needs that exchange anyway."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def kept(df: DataFrame) -> DataFrame:
    """A small frame that several branches of a plan read, computed once.

    A checkpoint in the shared folder rather than a cache: it survives lost
    executors, and it goes when nothing refers to it any more.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Rows that several jobs read, as a Parquet table in the shared folder.

    Trips are a table when the jobs start, and cost a scan of a few columns
    each time; here every reading would join order lines and orders again.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/trips-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a file of the zone eras would spell them.

    Lines of every hundredth order occur twice, so some trips are full copies.
    """
    # Intervals are made below the join: its condition, in which valid trips
    # are told, would make them again for each mention of a time.
    lines = dealt(table(spark, sf_dir, "lineitem"), "l_orderkey").selectExpr(
        "*",
        "make_dt_interval(0, cast(l_partkey % 24 as int), l_linenumber) as ahead",
        "make_dt_interval(0, 0, cast(l_quantity as int) - 2) as ride",
    )
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate + make_ym_interval(20, 0) as moved")
    joined = lines.join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr(
        "*",
        "explode(if(l_orderkey % 100 = 0, array(0, 1), array(0))) as copy",
        "moved + ahead as p",
    )
    return joined.selectExpr("*", "year(p) as y").selectExpr(
        "l_suppkey % 2 + 1 as VendorID",
        "p as tpep_pickup_datetime",
        "p + ride as tpep_dropoff_datetime",
        "if(l_linenumber = 7, null, cast(l_linenumber as double)) as passenger_count",
        "l_discount * 100.0D as trip_distance",
        "if(y <= 2015, -73.9D - l_tax, null) as pickup_longitude",
        "if(y <= 2015, 40.7D + l_tax, null) as pickup_latitude",
        "if(y <= 2015, -73.9D - l_discount, null) as dropoff_longitude",
        "if(y <= 2015, 40.7D + l_discount, null) as dropoff_latitude",
        "if(y >= 2016, cast((l_partkey div 24) % 6 as double), null) as PULocationID",
        "if(y >= 2016, cast(l_suppkey % 6 as double), null) as DOLocationID",
        "1.0D as RatecodeID",
        "'N' as store_and_fwd_flag",
        "if(l_returnflag = 'A' and l_linestatus = 'O', null,"
        " cast(l_linenumber % 4 + 1 as double)) as payment_type",
        "l_extendedprice - 2000.0D as fare_amount",
        "0.5D as extra",
        "0.5D as mta_tax",
        "l_tax * 100.0D as tip_amount",
        "0.0D as tolls_amount",
        "if(y >= 2016, 0.3D, null) as improvement_surcharge",
        "l_extendedprice - 1000.0D as total_amount",
        "if(y >= 2019, 2.5D, null) as congestion_surcharge",
        f"{MONTH_FILE.format('p')} as source_file",
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file of the last era would spell them: other types, no GPS.

    They are dealt out first: a row group of a million events would be one task.
    """
    return dealt(table(spark, sf_dir, "events"), "event_id").selectExpr(
        "cast(user_id % 2 + 1 as string) as vendor_id",
        "ts as tpep_pickup_datetime",
        "ts + make_dt_interval(0, 0, cast(floor(value) as int)) as tpep_dropoff_datetime",
        "if(event_type = 'error', null, user_id % 5 + 1) as passenger_count",
        "if(event_type = 'signup', 0.0D, value / 10.0D) as trip_distance",
        "cast(user_id % 6 as int) as PULocationID",
        "cast(event_id % 6 as int) as DOLocationID",
        "1 as RatecodeID",
        "'N' as store_and_fwd_flag",
        "user_id % 4 + 1 as payment_type",
        "value - 5.0D as fare_amount",
        "0.5D as extra",
        "0.5D as mta_tax",
        "value / 20.0D as tip_amount",
        "0.0D as tolls_amount",
        "0.3D as improvement_surcharge",
        "value - 1.0D as total_amount",
        "2.5D as congestion_surcharge",
        "if(event_type = 'purchase', 1.25D, null) as Airport_fee",
        f"{MONTH_FILE.format('ts')} as source_file",
    )


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips as the unified table; times stay without zone, as in the files."""
    frames = [order_trips(spark, sf_dir), event_trips(spark, sf_dir)]
    return unify(frames, INGESTED_AT, timestamp_type="timestamp_ntz")


def staged_of(trips: DataFrame) -> DataFrame:
    return stage(trips).withColumn("ingested_at", F.expr("cast(ingested_at as timestamp_ntz)"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_of(unified(spark, sf_dir))


def staged_table(spark: SparkSession, sf_dir: str, shown: list[str] | None = None) -> DataFrame:
    """The staged trips as a table, with what ids need if ``shown`` is read of the trips."""
    trips = staged(spark, sf_dir)
    return stored(trips.select(*columns_for(trips.columns, shown)))


def identified(spark: SparkSession, sf_dir: str, shown: list[str] | None = None) -> DataFrame:
    """Trips with their ids, of which no more than ``shown`` is read if it is given."""
    return with_trip_id(staged_table(spark, sf_dir, shown), shown)


def loads(trips: DataFrame) -> DataFrame:
    """Load attempts of the trips' month files.

    Each file is loaded once, an hour per month of age apart. June files failed
    half an hour before; April files were loaded again 400 hours later, and
    that load reports one row less.
    """
    attempts = (
        "explode(filter(array("
        " named_struct('status', 'success', 'minutes', 0, 'less', 0),"
        " if(data_month = 6, named_struct('status', 'failed', 'minutes', -30, 'less', 0), null),"
        " if(data_month = 4, named_struct('status', 'success', 'minutes', 24000, 'less', 1), null)"
        "), a -> a is not null)) as a"
    )
    files = evolution.present_columns(trips).selectExpr("*", attempts)
    log = files.selectExpr(
        "concat(data_year, '-', lpad(data_month, 2, '0')) as partition_key",
        "source_file",
        "schema_version",
        "columns",
        "row_count - a.less as row_count",
        "a.status as status",
        "timestamp_ntz '2024-03-01 00:00:00'"
        " + make_dt_interval(0, data_year * 12 + data_month - 24181, a.minutes) as ingested_at",
    )
    # A row per load, read by several branches of the plans on top of it.
    return kept(log)


def lineage(trips: DataFrame) -> DataFrame:
    """The load log of ``loads``, as an ingest run would have written it."""
    attempts = loads(trips)
    done = evolution.schema_diff(attempts.filter("status = 'success'"))
    failed = attempts.filter("status = 'failed'").withColumns(
        {"columns_added": F.lit(""), "columns_removed": F.lit("")}
    )
    ok, stamp = "status = 'success'", "date_format(ingested_at, 'yyyyMMddHHmm')"
    return done.unionByName(failed).selectExpr(
        f"substring(sha2(concat(partition_key, '|', {stamp}), 256), 1, 32) as run_id",
        "concat('landing/', source_file) as source_url",
        "'parquet' as source_format",
        "schema_version",
        "partition_key",
        f"if({ok}, row_count, 0) as row_count",
        f"cast(if({ok}, size(columns), 0) as bigint) as column_count",
        "columns_added",
        "columns_removed",
        f"if({ok}, concat('batch-', {stamp}), '') as iceberg_snapshot_id",
        "'trips.unified' as iceberg_table",
        f"""if({ok}, '["read_parquet","normalize_schema"]', '[]') as transformation_steps""",
        "'1.0.0' as pipeline_version",
        "ingested_at",
        "status",
        f"if({ok}, '', 'required columns missing: extra') as error_message",
    )


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id -> trip_id: the trip of a user's first event."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.min(F.struct("event_id", "ts", "value")).alias("e"))
        .select(
            "user_id",
            F.sha2(
                F.concat_ws(
                    "|",
                    F.expr(MONTH_FILE.format("e.ts")),
                    F.expr("date_format(e.ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"),
                    F.expr(
                        "date_format(e.ts + make_dt_interval(0, 0, cast(floor(e.value) as int)),"
                        " 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
                    ),
                    F.expr("cast(cast(e.value - 1.0D as decimal(18,4)) as string)"),
                    F.lit("1"),
                ),
                256,
            ).alias("trip_id"),
        )
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as access, errors as erasure and clicks as withdrawal requests."""
    events = table(spark, sf_dir, "events")
    kinds = "case event_type when 'view' then 'access' when 'error' then 'erasure' when 'click' then 'withdrawal' end"
    asked = events.withColumn("kind", F.expr(kinds)).filter(F.col("kind").isNotNull())
    return asked.join(subjects(spark, sf_dir), "user_id").select(
        F.col("event_id").alias("seq"),
        "trip_id",
        "kind",
        F.expr(
            "if(kind = 'withdrawal', if(event_id % 2 = 0, 'ml_training', 'analytics'), null)"
        ).alias("category"),
        F.expr("concat('agent-', user_id % 10)").alias("actor"),
        F.col("ts").alias("requested_at"),
    )


def consent_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups and purchases as entries of a consent ledger."""
    events = table(spark, sf_dir, "events").filter("event_type in ('signup', 'purchase')")
    return events.join(subjects(spark, sf_dir), "user_id").select(
        "trip_id",
        F.expr("if(event_id % 2 = 0, 'ml_training', 'analytics')").alias("category"),
        (F.col("value") > 10.0).alias("status"),
        F.col("ts").alias("effective_at"),
        F.expr("if(event_id % 5 = 0, ts + make_dt_interval(5), null)").alias("expires_at"),
        F.expr("if(user_id % 3 = 0, 'desk', 'web')").alias("collection_source"),
        F.expr("concat('event-', event_id)").alias("audit_ref"),
    )


def consent_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of ``consent_records`` by user, for all trips of a user."""
    return table(spark, sf_dir, "events").filter("event_type in ('signup', 'purchase')").selectExpr(
        "user_id",
        "if(event_id % 2 = 0, 'ml_training', 'analytics') as category",
        "value > 10.0D as status",
        "ts as effective_at",
        "if(event_id % 5 = 0, ts + make_dt_interval(5), null) as expires_at",
    )


# A text per pain point; <u> stands for the user and <d> for the day.
NARRATIVE_TEXTS = {
    "lineage": '{"source_system": "depot <u>", "business_process": "rides", "ingestion_summary": "day <d>"}',
    "business_context": '{"dataset_summary": "trips of <u>", "good_for": ["plans", "maps <d>"], "grain": "trip"}',
    "trust_score": '{"trust_score": 0.<u>, "headline": "user <u>", "red_flags": ["late"],'
    ' "score_breakdown": {"validity": "day <d>"}}',
    "coverage_gaps": '{"headline": "user <u>", "gaps": [{"gap": "day <d>", "explanation": "closed"}]}',
    "schema_evolution": '{"headline": "user <u>", "changes": [{"period": "2019-<d>", "what_changed": "fees"}]}',
    "volume_trends": '{"headline": "user <u>", "peak": {"period": "2015-<d>", "trips": <u>},'
    ' "covid_collapse": {"bottom_month": "2020-<d>", "bottom_trips": 7}}',
    "covid_impact": '{"headline": "user <u>", "timeline": [{"month": 4, "trips": <u>, "story": "day <d>"}]}',
    "fare_evolution": '{"headline": "user <u>", "fare_trend": "up since day <d>"}',
    "seasonal_patterns": '{"headline": "user <u>", "peak_months": {"months": [<u>, 5], "explanation": "fair"},'
    ' "slow_months": {"months": [1], "explanation": "cold since <d>"}}',
}


def narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as narratives of all pain points in turn; every seventh is not JSON."""
    points = ", ".join(f"'{point}'" for point in NARRATIVE_TEXTS)
    texts = ", ".join(f"'{text}'" for text in NARRATIVE_TEXTS.values())
    turn = "cast(event_id % 9 as int) + 1"
    filled = (
        f"replace(replace(element_at(array({texts}), {turn}), '<u>', cast(user_id as string)),"
        " '<d>', cast(day(ts) as string))"
    )
    return table(spark, sf_dir, "events").select(
        F.expr(f"element_at(array({points}), {turn})").alias("pain_point"),
        F.expr("2015 + user_id % 8").alias("data_year"),
        F.lit(None).cast("bigint").alias("data_month"),
        F.expr(f"if(event_id % 7 = 0, concat('no json: ', props), {filled})").alias("narrative_json"),
        F.lit("writer-1").alias("model"),
        F.col("ts").alias("generated_at"),
        F.expr("100 + event_id % 50").alias("prompt_tokens"),
        F.expr("20 + event_id % 30").alias("completion_tokens"),
    )
