"""The same queries as ANSI SQL over the test tables, for comparison.

Written in the relational form (counting windows, joins on trip_id, rankings),
not in the form the Spark operators use, so that agreement means something.
"""

from __future__ import annotations

from tripguard.operators.policy import POLICY
from tripguard.plans.driver_tables import NARRATIVE_TEXTS

# Trips: one common table expression after another; each text ends open.
TRIPS = """
WITH li AS (
  SELECT *, o_orderdate + INTERVAL 20 YEAR
            + to_hours(CAST(l_partkey % 24 AS INT)) + to_minutes(l_linenumber) AS p
  FROM (SELECT * FROM lineitem
        UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 100 = 0)
  JOIN orders ON l_orderkey = o_orderkey),
trips_raw AS (
  SELECT CAST(l_suppkey % 2 + 1 AS VARCHAR) AS vendor_id,
    p AS tpep_pickup_datetime,
    p + to_minutes(CAST(l_quantity AS INT) - 2) AS tpep_dropoff_datetime,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
    l_discount * 100 AS trip_distance,
    CASE WHEN year(p) <= 2015 THEN CAST(-73.9 AS DOUBLE) - l_tax END AS pickup_longitude,
    CASE WHEN year(p) <= 2015 THEN CAST(40.7 AS DOUBLE) + l_tax END AS pickup_latitude,
    CASE WHEN year(p) <= 2015 THEN CAST(-73.9 AS DOUBLE) - l_discount END AS dropoff_longitude,
    CASE WHEN year(p) <= 2015 THEN CAST(40.7 AS DOUBLE) + l_discount END AS dropoff_latitude,
    CASE WHEN year(p) >= 2016 THEN CAST((l_partkey // 24) % 6 AS INT) END AS pu_location_id,
    CASE WHEN year(p) >= 2016 THEN CAST(l_suppkey % 6 AS INT) END AS do_location_id,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN NULL
         ELSE CAST(l_linenumber % 4 + 1 AS DOUBLE) END AS payment_type,
    l_extendedprice - 2000 AS fare_amount,
    l_tax * 100 AS tip_amount,
    CASE WHEN year(p) >= 2016 THEN CAST(0.3 AS DOUBLE) END AS improvement_surcharge,
    l_extendedprice - 1000 AS total_amount,
    CASE WHEN year(p) >= 2019 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS airport_fee,
    p AS starts
  FROM li
  UNION ALL BY NAME
  SELECT CAST(user_id % 2 + 1 AS VARCHAR) AS vendor_id,
    ts AS tpep_pickup_datetime,
    ts + to_minutes(CAST(floor(value) AS INT)) AS tpep_dropoff_datetime,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id % 5 + 1 AS DOUBLE) END AS passenger_count,
    CASE WHEN event_type = 'signup' THEN CAST(0 AS DOUBLE) ELSE value / 10 END AS trip_distance,
    CAST(user_id % 6 AS INT) AS pu_location_id, CAST(event_id % 6 AS INT) AS do_location_id,
    CAST(user_id % 4 + 1 AS DOUBLE) AS payment_type,
    value - 5 AS fare_amount, value / 20 AS tip_amount,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    value - 1 AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    CASE WHEN event_type = 'purchase' THEN CAST(1.25 AS DOUBLE) END AS airport_fee,
    ts AS starts
  FROM events),
trips AS (
  SELECT vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
    pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
    pu_location_id, do_location_id, CAST(1 AS DOUBLE) AS rate_code_id, 'N' AS store_and_fwd_flag,
    payment_type, fare_amount, CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
    tip_amount, CAST(0 AS DOUBLE) AS tolls_amount, improvement_surcharge, total_amount,
    congestion_surcharge, airport_fee,
    CAST(year(starts) AS INT) AS data_year, CAST(month(starts) AS INT) AS data_month,
    'yellow_tripdata_' || strftime(starts, '%Y-%m') || '.parquet' AS source_file,
    '2024-02-01 00:00:00' AS ingested_at,
    CASE WHEN year(starts) <= 2015 THEN 'gps' WHEN year(starts) <= 2018 THEN 'zone'
         WHEN year(starts) <= 2021 THEN 'zone_v2' ELSE 'zone_v3' END AS schema_version
  FROM trips_raw)"""

STAGED = TRIPS + """,
stg AS (
  SELECT vendor_id, tpep_pickup_datetime AS pickup_at, tpep_dropoff_datetime AS dropoff_at,
    CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance AS trip_distance_miles,
    pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
    CAST(pu_location_id AS BIGINT) AS pu_location_id, CAST(do_location_id AS BIGINT) AS do_location_id,
    CAST(rate_code_id AS BIGINT) AS rate_code_id, store_and_fwd_flag,
    CAST(payment_type AS BIGINT) AS payment_type, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee,
    data_year, data_month, source_file, CAST(ingested_at AS TIMESTAMP) AS ingested_at, schema_version
  FROM trips
  WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND tpep_dropoff_datetime > tpep_pickup_datetime AND trip_distance >= 0 AND total_amount >= 0)"""


def _r(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _rate(column: str) -> str:
    return _r(f"count(*) FILTER (WHERE {column} IS NULL) / CAST(count(*) AS DOUBLE)", 4)


_RATED = {
    "passenger_count": "null_rate_passenger_count", "trip_distance_miles": "null_rate_trip_distance",
    "pickup_longitude": "null_rate_pickup_longitude", "pu_location_id": "null_rate_pu_location_id",
    "fare_amount": "null_rate_fare_amount", "total_amount": "null_rate_total_amount",
    "payment_type": "null_rate_payment_type", "congestion_surcharge": "null_rate_congestion_surcharge",
    "airport_fee": "null_rate_airport_fee",
}
_REQUIRED = ["passenger_count", "trip_distance_miles", "fare_amount", "total_amount", "payment_type"]
_STATISTICS = [
    ("avg", "trip_distance_miles", "avg_trip_distance_miles"), ("min", "trip_distance_miles", "min_trip_distance_miles"),
    ("max", "trip_distance_miles", "max_trip_distance_miles"), ("stddev_samp", "trip_distance_miles", "stddev_trip_distance"),
    ("avg", "fare_amount", "avg_fare_amount"), ("min", "fare_amount", "min_fare_amount"),
    ("max", "fare_amount", "max_fare_amount"), ("avg", "passenger_count", "avg_passenger_count"),
]
_FIRST = "make_date(data_year, data_month, 1)"
_DAY = "CAST(pickup_at AS DATE)"
_ROWS = "CAST(count(*) AS DOUBLE)"

# One select over the grouped trips; windows run over its groups.
QUALITY = STAGED + f""",
quality AS (
  SELECT data_year, data_month, schema_version, count(*) AS total_rows,
    {", ".join(f"{_rate(c)} AS {name}" for c, name in _RATED.items())},
    {", ".join(f"{_r(f'{f}({c})', 2)} AS {name}" for f, c, name in _STATISTICS)},
    count(DISTINCT {_DAY}) FILTER (WHERE date_trunc('month', {_DAY}) = {_FIRST}) AS active_days,
    min({_DAY}) AS earliest_trip_date, max({_DAY}) AS latest_trip_date,
    count(*) FILTER (WHERE fare_amount < 0) AS negative_fare_count, count(*) FILTER (WHERE total_amount < 0) AS negative_total_amount_count,
    count(*) FILTER (WHERE trip_distance_miles = 0) AS zero_distance_trip_count,
    min(ingested_at) AS first_ingested_at, max(ingested_at) AS last_ingested_at,
    CAST(day(last_day({_FIRST})) AS BIGINT) AS days_in_month,
    {_r(f"1 - ({' + '.join(_rate(c) for c in _REQUIRED)}) / 5", 4)} AS completeness_score,
    {_r(f"least(1.0, {_ROWS} / avg({_ROWS}) OVER (PARTITION BY schema_version))", 4)} AS volume_anomaly_score
  FROM stg GROUP BY data_year, data_month, schema_version)"""

_COLUMNS = [
    "vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
    "dropoff_latitude", "pu_location_id", "do_location_id", "rate_code_id",
    "store_and_fwd_flag", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
]


def _present(columns: list[str]) -> str:
    tests = ", ".join(f"CASE WHEN count({c}) > 0 THEN '{c}' END" for c in columns)
    return f"list_sort(list_filter([{tests}], lambda x: x IS NOT NULL))"


_LOADS = f""",
files AS (
  SELECT source_file, data_year, data_month, schema_version, count(*) AS n,
    {_present(_COLUMNS)} AS columns
  FROM trips GROUP BY source_file, data_year, data_month, schema_version),
timed AS (
  SELECT *, strftime(make_date(data_year, data_month, 1), '%Y-%m') AS partition_key,
    TIMESTAMP '2024-03-01' + to_hours(data_year * 12 + data_month - 24181) AS base FROM files),
attempts AS (
  SELECT *, 'success' AS status, base AS ingested_at, n AS rows_loaded FROM timed
  UNION ALL SELECT *, 'failed', base - INTERVAL 30 MINUTE, n FROM timed WHERE data_month = 6
  UNION ALL SELECT *, 'success', base + INTERVAL 400 HOUR, n - 1 FROM timed WHERE data_month = 4),
before AS (
  SELECT *, coalesce(lag(columns) OVER (ORDER BY ingested_at, partition_key), []) AS prev
  FROM attempts WHERE status = 'success'),
diff AS (
  SELECT *,
    array_to_string(list_filter(columns, lambda x: NOT list_contains(prev, x)), ',') AS columns_added,
    array_to_string(list_filter(prev, lambda x: NOT list_contains(columns, x)), ',') AS columns_removed
  FROM before),
logged AS (
  SELECT partition_key, source_file, schema_version, status, ingested_at, rows_loaded,
    len(columns) AS cols, columns_added, columns_removed FROM diff
  UNION ALL
  SELECT partition_key, source_file, schema_version, status, ingested_at, 0, 0, '', ''
  FROM attempts WHERE status = 'failed'),
lineage AS (
  SELECT substr(sha256(partition_key || '|' || strftime(ingested_at, '%Y%m%d%H%M')), 1, 32) AS run_id,
    'landing/' || source_file AS source_url, 'parquet' AS source_format, schema_version,
    partition_key, CAST(rows_loaded AS BIGINT) AS row_count, CAST(cols AS BIGINT) AS column_count,
    columns_added, columns_removed,
    CASE WHEN status = 'success' THEN 'batch-' || strftime(ingested_at, '%Y%m%d%H%M') ELSE '' END
      AS iceberg_snapshot_id,
    'trips.unified' AS iceberg_table,
    CASE WHEN status = 'success' THEN '["read_parquet","normalize_schema"]' ELSE '[]' END
      AS transformation_steps,
    '1.0.0' AS pipeline_version, ingested_at, status,
    CASE WHEN status = 'success' THEN '' ELSE 'required columns missing: extra' END AS error_message
  FROM logged)"""

_EVOLUTION = """,
evolution AS (
  SELECT partition_key, schema_version, lag(schema_version) OVER loaded AS prev_schema_version,
    column_count, lag(column_count) OVER loaded AS prev_column_count,
    column_count - lag(column_count, 1, 0) OVER loaded AS columns_delta,
    columns_added, columns_removed, row_count, ingested_at, iceberg_snapshot_id,
    concat(columns_added, columns_removed) <> '' AS is_schema_change,
    CASE concat(lag(schema_version) OVER loaded, '>', schema_version)
      WHEN '>gps' THEN 'initial_load' WHEN 'gps>zone' THEN 'gps_to_zone_ids'
      WHEN 'zone>zone_v2' THEN 'added_congestion_surcharge'
      WHEN 'zone_v2>zone_v3' THEN 'added_airport_fee' ELSE 'no_change' END AS change_type
  FROM lineage WHERE status = 'success' WINDOW loaded AS (ORDER BY ingested_at, partition_key)),
latest AS (
  SELECT partition_key, arg_max(is_schema_change, ingested_at) AS is_schema_change,
    arg_max(change_type, ingested_at) AS change_type, arg_max(columns_added, ingested_at) AS columns_added,
    arg_max(columns_removed, ingested_at) AS columns_removed,
    CAST(partition_key[:4] AS INT) AS data_year, CAST(partition_key[6:] AS INT) AS data_month
  FROM evolution GROUP BY partition_key)"""

LINEAGE = TRIPS + _LOADS
EVOLUTION = LINEAGE + _EVOLUTION

_INVALID = (
    "least(1.0, CAST(negative_fare_count AS DOUBLE) / nullif(total_rows, 0))"
    " + least(0.5, CAST(zero_distance_trip_count AS DOUBLE) / nullif(total_rows, 0) * 2)"
)
_CARRIED = [
    "earliest_trip_date", "latest_trip_date", "avg_fare_amount", "avg_trip_distance_miles",
    "avg_passenger_count", "null_rate_passenger_count", "negative_fare_count",
    "zero_distance_trip_count", "null_rate_congestion_surcharge", "null_rate_airport_fee",
    "null_rate_pickup_longitude", "null_rate_pu_location_id",
]
_WEIGHED = {
    "completeness_score": 0.35, "volume_anomaly_score": 0.25, "validity_score": 0.25, "consistency_score": 0.15,
}
SCORES = QUALITY + _LOADS + _EVOLUTION + f""",
trust AS (
  SELECT *, {_r(" + ".join(f"{c} * CAST({w} AS DOUBLE)" for c, w in _WEIGHED.items()), 4)} AS trust_score
  FROM (
    SELECT data_year, data_month, q.schema_version, total_rows, active_days, days_in_month,
      completeness_score, volume_anomaly_score,
      coalesce({_r(f"1.0 - ({_INVALID})", 4)}, CAST(1 AS DOUBLE)) AS validity_score,
      CAST(if(is_schema_change, 0.6, 1.0) AS DOUBLE) AS consistency_score,
      coalesce(change_type, 'no_change') AS change_type, coalesce(columns_added, '') AS columns_added,
      coalesce(columns_removed, '') AS columns_removed, {", ".join(_CARRIED)}
    FROM quality q LEFT JOIN latest USING (data_year, data_month)))"""

# What tells trips of one key apart: seven columns, then all others by name.
_ID_ORDER = [
    "vendor_id", "passenger_count", "trip_distance_miles", "fare_amount", "pu_location_id",
    "do_location_id", "payment_type", "airport_fee", "congestion_surcharge", "data_month", "data_year",
    "dropoff_latitude", "dropoff_longitude", "extra", "improvement_surcharge", "mta_tax",
    "pickup_latitude", "pickup_longitude", "rate_code_id", "schema_version", "store_and_fwd_flag",
    "tip_amount", "tolls_amount", "total_amount",
]
_ID_KEYS = "source_file, pickup_at, dropoff_at, CAST(CAST(total_amount AS DECIMAL(18,4)) AS VARCHAR)"
IDENTITY = STAGED + f""",
base AS (
  SELECT *, row_number() OVER (PARTITION BY {_ID_KEYS}
      ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _ID_ORDER)}) AS duplicate_ordinal,
    hour(pickup_at) AS pickup_hour, dayofweek(pickup_at) + 1 AS pickup_day_of_week
  FROM stg),
ident AS (
  SELECT *, sha256(source_file || '|' || strftime(pickup_at, '%Y-%m-%d %H:%M:%S.%f') || '|'
    || strftime(dropoff_at, '%Y-%m-%d %H:%M:%S.%f') || '|'
    || CAST(CAST(total_amount AS DECIMAL(18,4)) AS VARCHAR) || '|'
    || CAST(duplicate_ordinal AS VARCHAR)) AS trip_id
  FROM base)"""


def _level(k: str, threshold: int = 5) -> str:
    return (
        f"CASE WHEN {k} < 2 THEN 'critical' WHEN {k} < {threshold} THEN 'high'"
        f" WHEN {k} < {3 * threshold} THEN 'moderate' ELSE 'low' END"
    )


_CLASSES = """,
classes AS (
  SELECT pu_location_id, do_location_id, hour(pickup_at) AS pickup_hour,
    dayofweek(pickup_at) + 1 AS pickup_day_of_week, count(*) AS k_anonymity
  FROM stg GROUP BY ALL)"""
CLASSES = STAGED + _CLASSES
RISK = IDENTITY + _CLASSES + f""",
risk AS (
  SELECT t.trip_id, t.data_year, t.data_month, t.schema_version, t.pu_location_id, t.do_location_id,
    t.pickup_hour, t.pickup_day_of_week, e.k_anonymity,
    e.k_anonymity < 5 AS is_high_reidentification_risk, {_level('e.k_anonymity')} AS risk_level
  FROM ident t JOIN classes e
    ON t.pu_location_id IS NOT DISTINCT FROM e.pu_location_id
   AND t.do_location_id IS NOT DISTINCT FROM e.do_location_id
   AND t.pickup_hour = e.pickup_hour AND t.pickup_day_of_week = e.pickup_day_of_week)"""


def _draw(category: str) -> str:
    return f"CAST('0x' || substr(sha256('{category}:' || trip_id), 1, 8) AS BIGINT) / 4294967295.0::DOUBLE"


_FLAGS = f"""{_draw('ml_training')} <= 0.8::DOUBLE AS consent_ml_training,
    {_draw('analytics')} <= 0.9::DOUBLE AS consent_analytics,
    {_draw('operational')} <= 1.0::DOUBLE AS consent_operational,
    'synthetic_demo' AS consent_source"""
CONSENT = RISK + f""",
consent AS (SELECT trip_id, {_FLAGS} FROM risk),
consented AS (SELECT *, {_FLAGS} FROM risk)"""

# Trip columns are carried along instead of being joined again by trip id.
MARTS = CONSENT + f""",
wide AS (
  SELECT t.*, e.k_anonymity, {_level('e.k_anonymity')} AS risk_level, {_FLAGS}
  FROM ident t JOIN classes e
    ON t.pu_location_id IS NOT DISTINCT FROM e.pu_location_id
   AND t.do_location_id IS NOT DISTINCT FROM e.do_location_id
   AND t.pickup_hour = e.pickup_hour AND t.pickup_day_of_week = e.pickup_day_of_week
  WHERE e.k_anonymity >= 5),
ml AS (
  SELECT sha256(trip_id || ':privacy-demo-rotation-2026') AS trip_pseudonym, vendor_id,
    passenger_count, trip_distance_miles, pu_location_id AS pickup_zone_id,
    do_location_id AS dropoff_zone_id, pickup_hour, pickup_day_of_week, payment_type,
    fare_amount, total_amount, data_year, data_month, schema_version,
    k_anonymity, risk_level, consent_source
  FROM wide WHERE consent_ml_training),
analytics AS (
  SELECT data_year, data_month, pu_location_id AS pickup_zone_id,
    do_location_id AS dropoff_zone_id, pickup_hour, count(*) AS trip_count,
    {_r('avg(trip_distance_miles)', 2)} AS avg_trip_distance_miles,
    {_r('avg(fare_amount)', 2)} AS avg_fare_amount,
    {_r('avg(total_amount)', 2)} AS avg_total_amount,
    min(k_anonymity) AS minimum_trip_k
  FROM wide WHERE consent_analytics
  GROUP BY data_year, data_month, pu_location_id, do_location_id, pickup_hour
  HAVING count(*) >= 5)"""

_REQUESTS = """,
first_event AS (
  SELECT user_id, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
subjects AS (
  SELECT user_id, sha256('yellow_tripdata_' || strftime(ts, '%Y-%m') || '.parquet|'
    || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '|'
    || strftime(ts + to_minutes(CAST(floor(value) AS INT)), '%Y-%m-%d %H:%M:%S.%f') || '|'
    || CAST(CAST(value - 1 AS DECIMAL(18,4)) AS VARCHAR) || '|1') AS trip_id
  FROM first_event),
requests AS (
  SELECT event_id AS seq, trip_id,
    CASE event_type WHEN 'view' THEN 'access' WHEN 'error' THEN 'erasure' ELSE 'withdrawal' END AS kind,
    CASE WHEN event_type = 'click' THEN
      CASE WHEN event_id % 2 = 0 THEN 'ml_training' ELSE 'analytics' END END AS category,
    'agent-' || CAST(user_id % 10 AS VARCHAR) AS actor, ts AS requested_at
  FROM events JOIN subjects USING (user_id) WHERE event_type IN ('view', 'error', 'click'))"""

_OUTCOMES = """,
ordered AS (
  SELECT *, coalesce(max(CASE WHEN kind = 'erasure' THEN 1 ELSE 0 END) OVER (
    PARTITION BY trip_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
    AS erased FROM requests),
outcomes AS (
  SELECT o.seq, o.trip_id, o.kind, o.category, o.actor, o.requested_at,
    CASE WHEN kind = 'access' THEN
           CASE WHEN t.trip_id IS NOT NULL AND NOT erased THEN 'found' ELSE 'not_found' END
         WHEN kind = 'erasure' THEN 'marked_for_erasure' ELSE 'withdrawn' END AS status,
    CASE WHEN kind = 'access' THEN t.trip_id IS NOT NULL AND NOT erased END AS record_found,
    CASE WHEN kind = 'erasure' THEN t.trip_id IS NOT NULL END AS record_existed,
    CASE WHEN kind = 'access' AND NOT erased THEN t.data_year END AS record_year,
    CASE WHEN kind = 'access' AND NOT erased THEN t.fare_amount END AS record_fare
  FROM ordered o LEFT JOIN ident t ON o.trip_id = t.trip_id),
audit AS (
  SELECT substr(sha256(CAST(seq AS VARCHAR) || '|' || kind || '|' || trip_id), 1, 32) AS event_id,
    CASE kind WHEN 'access' THEN 'dsr_access_request' WHEN 'erasure' THEN 'dsr_erasure_request'
      ELSE 'consent_withdrawal' END AS event_type, actor, trip_id,
    CASE kind WHEN 'access' THEN 'GDPR Article 15' WHEN 'erasure' THEN 'GDPR Article 17'
      ELSE 'GDPR Article 7' END AS gdpr_article,
    CASE kind WHEN 'erasure' THEN 'CCPA Section 1798.105' END AS ccpa_section,
    requested_at AS timestamp,
    CASE kind WHEN 'access' THEN '{"record_found":' || CAST(record_found AS VARCHAR) || '}'
      WHEN 'erasure' THEN '{"downstream_action":"exclude_from_privacy_marts","record_existed":'
        || CAST(record_existed AS VARCHAR) || '}'
      ELSE '{"category":"' || category || '","downstream_action":"exclude_from_' || category || '"}'
    END AS details_json
  FROM outcomes)"""
REQUESTS = IDENTITY + _REQUESTS
OUTCOMES = REQUESTS + _OUTCOMES

_STAGED_COLUMNS = [
    {"tpep_pickup_datetime": "pickup_at", "tpep_dropoff_datetime": "dropoff_at",
     "trip_distance": "trip_distance_miles"}.get(c, c)
    for c in _COLUMNS
] + ["data_year", "data_month", "ingested_at", "schema_version"]

_POLICY_ROWS = ", ".join(
    "(" + ", ".join(f"'{v}'" for v in (name, *fields)) + ")" for name, fields in POLICY.items()
)
INVENTORY = f"""
seen AS (
  SELECT source_file AS table_name, unnest(columns) AS column_name
  FROM (SELECT source_file, {_present(_STAGED_COLUMNS)} AS columns FROM stg GROUP BY source_file)),
policy(name, pii_type, sensitivity, handling, rationale) AS (VALUES
  {_POLICY_ROWS}),
inventory AS (
  SELECT table_name, column_name, coalesce(pii_type, 'non_pii') AS pii_type,
    coalesce(sensitivity, 'low') AS sensitivity, coalesce(handling, 'retain') AS handling,
    coalesce(rationale, 'Not listed as a direct identifier or quasi-identifier under this policy.') AS rationale,
    name IS NOT NULL AS is_policy_match
  FROM seen LEFT JOIN policy ON lower(column_name) = name)"""


def _hmac(message: str, salt: str = "demo-rotation-2026") -> str:
    key = salt.encode().ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in key).hex()
    outer = bytes(b ^ 0x5C for b in key).hex()
    return (
        f"substr(sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message})))), 1, 24)"
    )


_DRIVER = """CASE least(volume_anomaly_score, completeness_score, validity_score, consistency_score)
    WHEN volume_anomaly_score THEN 'Unusual volume' WHEN completeness_score THEN 'Missing values'
    WHEN validity_score THEN 'Invalid records' ELSE 'Schema change' END"""
_PERIOD = "printf('%d-%02d', data_year, data_month)"
_PER_MILE = "CASE WHEN avg_trip_distance_miles > 0 THEN avg_fare_amount / avg_trip_distance_miles END"


def _weighted(column: str, name: str) -> str:
    return (
        f"CAST(sum(CAST(coalesce({column}, 0) AS DECIMAL(20,8)) * CAST(total_rows AS DECIMAL(16,0))) AS DOUBLE)"
        f" / CAST(sum(total_rows) AS DOUBLE) AS {name}"
    )


_AVERAGED = [
    "trust_score", "completeness_score", "volume_anomaly_score", "validity_score",
    "consistency_score", "avg_fare_amount", "avg_trip_distance_miles", "avg_passenger_count",
]


def _extreme(prefix: str, direction: str) -> str:
    fields = {"period": _PERIOD, "trips": "total_rows", "trust_score": "trust_score",
              "volume_anomaly_score": "volume_anomaly_score", "avg_fare_amount": "avg_fare_amount"}
    shown = ", ".join(f"{v} AS {prefix}_{k}" for k, v in fields.items())
    return (
        f"{prefix} AS (SELECT data_year, {shown} FROM trust QUALIFY row_number() OVER"
        f" (PARTITION BY data_year ORDER BY trust_score {direction}, data_month) = 1)"
    )


SUMMARY = SCORES + f""",
averages AS (
  SELECT data_year, count(DISTINCT data_month) AS months, CAST(sum(total_rows) AS BIGINT) AS total_rows,
    {', '.join(_weighted(c, c) for c in _AVERAGED)}, {_weighted(_PER_MILE, 'fare_per_mile')},
    count(*) FILTER (WHERE trust_score < 0.75) AS low_trust_months,
    count(*) FILTER (WHERE volume_anomaly_score < 0.7) AS low_volume_months
  FROM trust GROUP BY data_year),
{_extreme('worst', 'ASC')}, {_extreme('best', 'DESC')},
summary AS (
  SELECT *, CASE WHEN trust_score >= 0.85 THEN 'High confidence'
    WHEN trust_score >= 0.7 THEN 'Usable with review'
    WHEN trust_score >= 0.55 THEN 'Use with caution' ELSE 'High risk' END AS confidence
  FROM averages JOIN worst USING (data_year) JOIN best USING (data_year))"""


def _band(score: str) -> str:
    name = score.replace("_score", "_band")
    return f"CASE WHEN {score} >= 0.75 THEN 'good' WHEN {score} >= 0.5 THEN 'fair' ELSE 'poor' END AS {name}"


_BANDED = ["trust_score", "completeness_score", "volume_anomaly_score", "validity_score", "consistency_score"]

_POINTS = ", ".join(f"'{point}'" for point in NARRATIVE_TEXTS)
_TEXTS = ", ".join(f"'{text}'" for text in NARRATIVE_TEXTS.values())
NARRATIVES = f"""
WITH narratives AS (
  SELECT [{_POINTS}][1 + event_id % 9] AS pain_point, 2015 + user_id % 8 AS data_year, ts AS generated_at,
    CASE WHEN event_id % 7 = 0 THEN 'no json: ' || props
      ELSE replace(replace([{_TEXTS}][1 + event_id % 9], '<u>', CAST(user_id AS VARCHAR)),
        '<d>', CAST(day(ts) AS VARCHAR)) END AS narrative_json
  FROM events)"""
# Path of the number and of the text that a typed narrative is known by.
_TYPED = {
    "lineage": (None, "$.source_system"), "business_context": (None, "$.good_for[1]"),
    "trust_score": ("$.trust_score", "$.score_breakdown.validity"), "coverage_gaps": (None, "$.gaps[0].gap"),
    "schema_evolution": (None, "$.changes[0].period"),
    "volume_trends": ("$.peak.trips", "$.covid_collapse.bottom_month"),
    "covid_impact": ("$.timeline[0].trips", "$.timeline[0].story"), "fare_evolution": (None, "$.fare_trend"),
    "seasonal_patterns": ("$.peak_months.months[0]", "$.slow_months.explanation"),
}


def _typed(which: int) -> str:
    whens = [f"WHEN '{p}' THEN doc ->> '{paths[which]}'" for p, paths in _TYPED.items() if paths[which]]
    return f"CASE pain_point {' '.join(whens)} END"


_SAMPLE = """vendor_id, pickup_at, dropoff_at, passenger_count, trip_distance_miles, pu_location_id,
  do_location_id, pickup_longitude, pickup_latitude, fare_amount, total_amount, payment_type,
  congestion_surcharge, airport_fee, schema_version"""
_SAMPLE_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in [
        "pickup_at", "dropoff_at", "total_amount", "vendor_id", "passenger_count",
        "trip_distance_miles", "pu_location_id", "do_location_id", "pickup_longitude",
        "pickup_latitude", "fare_amount", "payment_type", "congestion_surcharge", "airport_fee",
        "schema_version",
    ]
)


def _check(table: str, source: str, name: str, column: str, bad: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{column}' AS column_name,"
        f" count(*) FILTER (WHERE {bad}) AS failures FROM {source}"
    )


def _null_check(table: str, source: str, column: str) -> str:
    return _check(table, source, "not_null", column, f"{column} IS NULL")


def _in_check(table: str, source: str, column: str, values: str) -> str:
    return _check(table, source, "accepted_values", column, f"{column} NOT IN ({values})")


_MATCHED = "(SELECT * FROM inventory WHERE is_policy_match)"
_CHECKS = "\nUNION ALL ".join(
    [
        _null_check("pii_inventory", _MATCHED, "column_name"),
        _null_check("pii_inventory", _MATCHED, "pii_type"),
        _in_check("pii_inventory", _MATCHED, "pii_type",
                  "'operational_identifier', 'quasi_identifier', 'location_trace', 'financial_attribute'"),
        _in_check("pii_inventory", _MATCHED, "handling", "'pseudonymize', 'generalize', 'suppress', 'aggregate'"),
        _null_check("trip_risk", "consented", "trip_id"),
        _null_check("trip_risk", "consented", "k_anonymity"),
        _in_check("trip_risk", "consented", "risk_level", "'critical', 'high', 'moderate', 'low'"),
        _in_check("trip_risk", "consented", "consent_source", "'synthetic_demo'"),
        _null_check("mart_ml_safe", "ml", "trip_pseudonym"),
        _null_check("mart_ml_safe", "ml", "k_anonymity"),
        _check("mart_ml_safe", "(SELECT trip_pseudonym, count(*) AS n FROM ml GROUP BY 1)", "unique",
               "trip_pseudonym", "n > 1"),
        _null_check("mart_analytics_safe", "analytics", "trip_count"),
        _null_check("mart_analytics_safe", "analytics", "minimum_trip_k"),
        _check("mart_analytics_safe", "analytics", "k_anonymous_cell", "trip_count", "trip_count < 5"),
        *[_null_check("quality_metrics", "quality", c)
          for c in ("total_rows", "completeness_score", "volume_anomaly_score", "data_year")],
        _check("trust_scores", "trust", "score_range", "trust_score", "trust_score < 0 OR trust_score > 1"),
    ]
)

_RAW = ["pickup_at", "dropoff_at", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
_AGE = "date_diff('day', CAST(pickup_at AS DATE), DATE '2024-06-01')"
_RISK_COLUMNS = """trip_id, data_year, data_month, schema_version, pu_location_id, do_location_id,
  pickup_hour, pickup_day_of_week, k_anonymity, is_high_reidentification_risk, risk_level"""
_HOUR = "'%Y-%m-%dT%H:00:00'"


_TIMES = ("ingested_at", "pickup_at", "dropoff_at")
_DATES = ("earliest_trip_date", "latest_trip_date")


def _document(point: str, year: str, source: str, fields: list[str], order: str) -> str:
    """Rows of ``source`` as one JSON array per year (or for all data)."""

    def shown(name: str) -> str:
        if name in _TIMES:
            return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"
        return f"CAST({name} AS VARCHAR)" if name in _DATES else name

    packed = ", ".join(f"{name} := {shown(name)}" for name in fields)
    return (
        f"SELECT '{point}' AS pain_point, CAST({year} AS INT) AS data_year,"
        f" CAST(to_json(list(struct_pack({packed}) ORDER BY {order})) AS VARCHAR) AS payload_json"
        f" FROM ({source}) GROUP BY ALL"
    )


_LOAD_YEAR = "CAST(split_part(partition_key, '-', 1) AS INT)"
_LINEAGE_FIELDS = [
    "partition_key", "schema_version", "source_format", "source_url", "row_count", "column_count",
    "columns_added", "columns_removed", "transformation_steps", "ingested_at", "status",
]
_EVOLUTION_FIELDS = [
    "partition_key", "schema_version", "prev_schema_version", "column_count", "prev_column_count",
    "columns_delta", "columns_added", "columns_removed", "row_count", "ingested_at",
    "iceberg_snapshot_id", "is_schema_change", "change_type",
]
_TRUST_FIELDS = [
    "data_year", "data_month", "schema_version", "total_rows", "active_days", "days_in_month",
    "completeness_score", "volume_anomaly_score", "validity_score", "consistency_score",
    "change_type", "columns_added", "columns_removed", *_DATES, "avg_fare_amount",
    "avg_trip_distance_miles", "avg_passenger_count", "null_rate_passenger_count",
    "negative_fare_count", "zero_distance_trip_count", "null_rate_congestion_surcharge",
    "null_rate_airport_fee", "null_rate_pickup_longitude", "null_rate_pu_location_id", "trust_score",
]
_SAMPLE_FIELDS = [
    "vendor_id", "pickup_at", "dropoff_at", "passenger_count", "trip_distance_miles",
    "pu_location_id", "do_location_id", "pickup_longitude", "pickup_latitude", "fare_amount",
    "total_amount", "payment_type", "congestion_surcharge", "airport_fee", "schema_version",
]
_SAMPLED = (
    "SELECT *, row_number() OVER (PARTITION BY data_year ORDER BY {0}) AS place FROM stg"
    " QUALIFY place <= 10"
)


def _after(prefix: str, text: str) -> str:
    """Continue ``prefix`` with the further expressions of ``text``."""
    return prefix + ",\n" + text.lstrip()


ORACLES: dict[str, str] = {
    "file_manifest": TRIPS + """
SELECT DISTINCT data_year AS year, data_month AS month, source_file AS url,
  printf('%d-%02d', data_year, data_month) AS partition_key, 'parquet' AS file_format, schema_version
FROM trips""",
    "unified_trips": TRIPS + "\nSELECT * FROM trips",
    "coerce_types": """
WITH raw AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a ' ELSE '' END || (props ->> '$.k') AS k,
    CASE WHEN event_type = 'click' THEN 'someday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS m
  FROM events)
SELECT event_id, TRY_CAST(k AS DOUBLE) AS number, TRY_CAST(k AS INT) AS zone,
  TRY_CAST(m AS TIMESTAMP) AS moment FROM raw""",
    "stg_trips": STAGED + "\nSELECT * FROM stg",
    "partition_row_counts": LINEAGE + """,
counts AS (SELECT data_year, data_month, count(*) AS row_count FROM trips GROUP BY ALL),
last_load AS (
  SELECT CAST(split_part(partition_key, '-', 1) AS INT) AS data_year,
    CAST(split_part(partition_key, '-', 2) AS INT) AS data_month, row_count AS lineage_row_count
  FROM lineage WHERE status = 'success'
  QUALIFY row_number() OVER (PARTITION BY partition_key ORDER BY ingested_at DESC) = 1)
SELECT data_year, data_month, coalesce(row_count, 0) AS row_count, lineage_row_count,
  coalesce(row_count, 0) IS NOT DISTINCT FROM lineage_row_count AS is_match
FROM counts FULL JOIN last_load USING (data_year, data_month)""",
    "sample_rows": STAGED + f"""
SELECT {_SAMPLE} FROM stg WHERE data_year = 2019 ORDER BY {_SAMPLE_ORDER} LIMIT 500""",
    "lineage_history": LINEAGE + """
SELECT * FROM lineage WHERE iceberg_table = 'trips.unified' ORDER BY ingested_at, partition_key""",
    "lineage_changes": LINEAGE + """
SELECT partition_key, schema_version, columns_added, columns_removed, ingested_at FROM lineage
WHERE columns_added <> '' OR columns_removed <> '' ORDER BY ingested_at""",
    "schema_diff": LINEAGE + """
SELECT partition_key, ingested_at, columns_added, columns_removed FROM diff""",
    "loaded_years": TRIPS + "\nSELECT DISTINCT data_year FROM trips ORDER BY data_year",
    "quality_metrics": QUALITY + "\nSELECT * FROM quality ORDER BY data_year, data_month",
    "schema_evolution": EVOLUTION + "\nSELECT * FROM evolution ORDER BY ingested_at",
    "latest_evolution": EVOLUTION + "\nSELECT * FROM latest",
    "trust_scores": SCORES + "\nSELECT * FROM trust ORDER BY data_year, data_month",
    "trust_for_year": SCORES + "\nSELECT * FROM trust WHERE data_year = 2019 ORDER BY data_month",
    "score_bands": SCORES + f"""
SELECT data_year, data_month, {', '.join(_BANDED)}, {', '.join(_band(c) for c in _BANDED)} FROM trust""",
    "risk_driver": SCORES + f"""
SELECT data_year, data_month, trust_score, {_DRIVER} AS risk_driver FROM trust""",
    "trip_identity": IDENTITY + """
SELECT trip_id, source_file, pickup_at, dropoff_at, total_amount, fare_amount, tip_amount,
  pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, duplicate_ordinal
FROM ident""",
    "equivalence_classes": CLASSES + "\nSELECT * FROM classes",
    "k_anonymity_param": STAGED + f""",
parts AS (SELECT data_year, data_month, pu_location_id, payment_type,
    CAST(isodow(pickup_at) - 1 AS BIGINT) AS pickup_weekday FROM stg),
counted AS (SELECT *, count(*) OVER (PARTITION BY pu_location_id, payment_type, pickup_weekday) AS k_anonymity
  FROM parts)
SELECT *, k_anonymity < 3 AS is_high_reidentification_risk, {_level('k_anonymity', 3)} AS risk_level,
  coalesce(CAST(pu_location_id AS VARCHAR), 'None') || '|' || coalesce(CAST(payment_type AS VARCHAR), 'None')
    || '|' || CAST(pickup_weekday AS VARCHAR) AS equivalence_class
FROM counted""",
    "reid_risk": RISK + "\nSELECT * FROM risk",
    "risk_summary": RISK + f"""
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_high_reidentification_risk) AS high_risk_records,
  {_r("count(*) FILTER (WHERE is_high_reidentification_risk) / CAST(count(*) AS DOUBLE)", 4)} AS high_risk_rate,
  min(k_anonymity) AS minimum_k, max(k_anonymity) AS maximum_k FROM risk""",
    # Every node of the lattice; the query prunes those above one that will do.
    "least_generalisation": CLASSES + """,
levels AS (SELECT z, h, d FROM range(3) a(z), range(3) b(h), range(3) c(d)),
nodes AS (
  SELECT z, h, d, sum(k_anonymity) AS k FROM (
    SELECT z, h, d, k_anonymity,
      CASE z WHEN 0 THEN pu_location_id WHEN 1 THEN pu_location_id // 3 END AS p,
      CASE z WHEN 0 THEN do_location_id WHEN 1 THEN do_location_id // 3 END AS o,
      CASE h WHEN 0 THEN pickup_hour WHEN 1 THEN pickup_hour // 6 END AS t,
      CASE d WHEN 0 THEN pickup_day_of_week WHEN 1 THEN CAST(pickup_day_of_week IN (1, 7) AS INT) END AS w
    FROM classes, levels)
  GROUP BY z, h, d, p, o, t, w),
measured AS (
  SELECT z, h, d, CAST(sum(k) AS BIGINT) AS total_records, count(*) AS classes,
    CAST(coalesce(sum(k) FILTER (WHERE k < 5), 0) AS BIGINT) AS high_risk_records, CAST(min(k) AS BIGINT) AS minimum_k
  FROM nodes GROUP BY z, h, d),
good AS (SELECT * FROM measured WHERE 100 * high_risk_records <= total_records)
SELECT CAST(z AS INT) AS zone_level, CAST(h AS INT) AS hour_level, CAST(d AS INT) AS weekday_level,
  total_records, classes, high_risk_records, minimum_k
FROM good g WHERE NOT EXISTS (
  SELECT 1 FROM good f WHERE f.z <= g.z AND f.h <= g.h AND f.d <= g.d AND f.z + f.h + f.d < g.z + g.h + g.d)""",
    "class_diversity": STAGED + f""",
valued AS (
  SELECT pu_location_id, do_location_id, hour(pickup_at) AS pickup_hour, dayofweek(pickup_at) + 1 AS pickup_day_of_week,
    coalesce(CAST(payment_type AS VARCHAR), '-') || '|' || CASE WHEN fare_amount IS NULL THEN '-'
      ELSE CAST(len(list_filter([0, 10, 20, 50, 100, 1000, 10000], lambda e: fare_amount >= e)) AS VARCHAR) END AS v
  FROM stg),
whole AS (SELECT v, count(*) / CAST((SELECT count(*) FROM stg) AS DOUBLE) AS q FROM valued GROUP BY v),
hist AS (SELECT pu_location_id, do_location_id, pickup_hour, pickup_day_of_week, v, count(*) AS c FROM valued GROUP BY ALL),
sized AS (SELECT *, sum(c) OVER (PARTITION BY pu_location_id, do_location_id, pickup_hour, pickup_day_of_week) AS n FROM hist)
SELECT pu_location_id, do_location_id, pickup_hour, pickup_day_of_week, CAST(sum(c) AS BIGINT) AS k_anonymity,
  count(*) AS distinct_values, CAST(max(c) AS BIGINT) AS largest_value,
  {_r("exp(-sum(c / CAST(n AS DOUBLE) * ln(c / CAST(n AS DOUBLE))))", 6)} AS entropy_l,
  {_r("(sum(abs(c / CAST(n AS DOUBLE) - q)) + 1.0::DOUBLE - sum(q)) / 2", 6)} AS distance
FROM sized JOIN whole USING (v) GROUP BY pu_location_id, do_location_id, pickup_hour, pickup_day_of_week""",
    "min_k_pivot": RISK + "\nSELECT pu_location_id, " + ", ".join(
        f"coalesce(min(k_anonymity) FILTER (WHERE pickup_hour = {h}), 0) AS hour_{h:02d}" for h in range(24)
    ) + " FROM risk WHERE pu_location_id IS NOT NULL GROUP BY pu_location_id",
    "suppress_outliers": RISK + "\nSELECT * FROM risk WHERE k_anonymity >= 5",
    "generalisation_impact": IDENTITY + f""",
both_k AS (
  SELECT trip_id,
    count(*) OVER (PARTITION BY pu_location_id, do_location_id, pickup_hour, pickup_day_of_week) AS k_before,
    count(*) OVER (PARTITION BY pu_location_id // 3, do_location_id // 3, pickup_hour,
      pickup_day_of_week IN (1, 7)) AS k_after
  FROM ident)
SELECT *, {_level('k_before')} AS risk_before, {_level('k_after')} AS risk_after FROM both_k""",
    "consent_flags": CONSENT + "\nSELECT * FROM consent",
    "consent_in_force": """
WITH rec AS (
  SELECT user_id, CASE WHEN event_id % 2 = 0 THEN 'ml_training' ELSE 'analytics' END AS category, ts AS since,
    value > 10.0::DOUBLE AS ok, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 5 DAY END AS until
  FROM events WHERE event_type IN ('signup', 'purchase')),
seen AS (
  SELECT e.event_id, r.*, e.ts, max(since) OVER (PARTITION BY e.event_id, category) AS newest
  FROM events e JOIN rec r ON r.user_id = e.user_id AND r.since <= e.ts),
told AS (
  SELECT event_id, category, bool_and(ok AND (until IS NULL OR until > ts)) AS ok
  FROM seen WHERE since = newest GROUP BY event_id, category)
SELECT e.event_id, e.user_id, e.ts,
  coalesce((SELECT ok FROM told t WHERE t.event_id = e.event_id AND category = 'ml_training'), false) AS consent_ml_training,
  coalesce((SELECT ok FROM told t WHERE t.event_id = e.event_id AND category = 'analytics'), false) AS consent_analytics,
  true AS consent_operational
FROM events e""",
    "consent_joined": CONSENT + "\nSELECT * FROM consented",
    "consent_table_joined": REQUESTS + """,
records AS (
  SELECT trip_id, CASE WHEN event_id % 2 = 0 THEN 'ml_training' ELSE 'analytics' END AS category,
    value > 10 AND (event_id % 5 <> 0 OR ts + INTERVAL 5 DAY > TIMESTAMP '2024-01-20') AS status,
    ts AS effective_at, CASE WHEN user_id % 3 = 0 THEN 'desk' ELSE 'web' END AS origin,
    'event-' || CAST(event_id AS VARCHAR) AS audit_ref
  FROM events JOIN subjects USING (user_id)
  WHERE event_type IN ('signup', 'purchase') AND ts <= TIMESTAMP '2024-01-20'),
last_record AS (
  SELECT trip_id, origin, audit_ref FROM records
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY effective_at DESC, audit_ref DESC) = 1),
current_status AS (
  SELECT trip_id, category, status FROM records
  QUALIFY row_number() OVER (PARTITION BY trip_id, category ORDER BY effective_at DESC, status) = 1)
SELECT i.trip_id, coalesce(m.status, false) AS consent_ml_training,
  coalesce(a.status, false) AS consent_analytics, true AS consent_operational,
  'consent_table' AS consent_source, r.origin AS consent_collection_source,
  r.audit_ref AS consent_audit_ref
FROM ident i LEFT JOIN last_record r USING (trip_id)
LEFT JOIN current_status m ON m.trip_id = i.trip_id AND m.category = 'ml_training'
LEFT JOIN current_status a ON a.trip_id = i.trip_id AND a.category = 'analytics'""",
    "mart_ml_safe": MARTS + "\nSELECT * FROM ml",
    "mart_analytics_safe": MARTS + "\nSELECT * FROM analytics",
    "release_candidates": MARTS + """,
sized AS (
  SELECT pickup_zone_id, dropoff_zone_id, pickup_hour, pickup_day_of_week,
    count(*) FILTER (WHERE data_year < 2020) AS old, count(*) FILTER (WHERE data_year >= 2020) AS new
  FROM ml GROUP BY ALL),
pairs AS (
  SELECT *, true AS in_first, old AS k_first, old AS k_left FROM sized WHERE old > 0
  UNION ALL SELECT *, false, NULL, new FROM sized WHERE new > 0)
SELECT in_first, true AS in_second,
  CASE WHEN in_first THEN pickup_zone_id END AS first_pickup_zone_id,
  CASE WHEN in_first THEN dropoff_zone_id END AS first_dropoff_zone_id,
  CASE WHEN in_first THEN pickup_hour END AS first_pickup_hour,
  CASE WHEN in_first THEN pickup_day_of_week END AS first_pickup_day_of_week,
  pickup_zone_id AS second_pickup_zone_id, dropoff_zone_id AS second_dropoff_zone_id,
  pickup_hour AS second_pickup_hour, pickup_day_of_week AS second_pickup_day_of_week,
  k_first, old + new AS k_second, k_left,
  k_left < 5 AND old + new >= 5 AND (k_first IS NULL OR k_first >= 5) AS is_exposed
FROM pairs""",
    "privacy_transform": IDENTITY + f"""
SELECT source_file, pu_location_id, do_location_id, fare_amount, {_hmac('trip_id')} AS trip_pseudonym,
  strftime(pickup_at, {_HOUR}) AS pickup_hour, strftime(dropoff_at, {_HOUR}) AS dropoff_hour
FROM ident""",
    "pii_inventory": _after(STAGED, INVENTORY) + "\nSELECT * FROM inventory",
    "pii_handling_counts": _after(STAGED, INVENTORY) + """
SELECT handling, sensitivity, count(*) AS columns FROM inventory GROUP BY handling, sensitivity""",
    "policy_applied": STAGED + f"""
SELECT {_hmac('vendor_id')} AS vendor_id, strftime(pickup_at, {_HOUR}) AS pickup_at,
  strftime(dropoff_at, {_HOUR}) AS dropoff_at, passenger_count, trip_distance_miles, pu_location_id,
  do_location_id, rate_code_id, store_and_fwd_flag, payment_type, extra, mta_tax, tolls_amount,
  improvement_surcharge, congestion_surcharge, airport_fee, data_year, data_month, source_file,
  ingested_at, schema_version FROM stg""",
    "retention_applied": IDENTITY + "\nSELECT trip_id, " + ", ".join(
        f"CASE WHEN {_AGE} <= 365 THEN {c} END AS {c}" for c in _RAW
    ) + " FROM ident",
    "recoverable_cells": MARTS + """,
cells AS (
  SELECT data_year, data_month, pu_location_id AS pickup_zone_id, do_location_id AS dropoff_zone_id, pickup_hour,
    count(*) AS trip_count
  FROM wide WHERE consent_analytics GROUP BY ALL),
lines AS (
  SELECT *, 'pickup_zone' AS kind, CAST(pickup_zone_id AS VARCHAR) AS key FROM cells
  UNION ALL SELECT *, 'dropoff_zone', CAST(dropoff_zone_id AS VARCHAR) FROM cells
  UNION ALL SELECT *, 'hour', CAST(pickup_hour AS VARCHAR) FROM cells),
small AS (
  SELECT *, count(*) OVER (PARTITION BY data_year, data_month, kind, key) AS n FROM lines WHERE trip_count < 5)
SELECT data_year, data_month, kind, key, pickup_zone_id, dropoff_zone_id, pickup_hour, trip_count FROM small WHERE n = 1""",
    "retention_features": MARTS + """
SELECT * FROM ml
WHERE date_diff('day', last_day(make_date(data_year, data_month, 1)), DATE '2024-06-01') <= 730""",
    "retention_audit": OUTCOMES + """
SELECT event_id, event_type, timestamp,
  date_diff('day', CAST(timestamp AS DATE), DATE '2031-01-15') > 2555 AS is_archived FROM audit""",
    "erasure_filtered": REQUESTS + """
SELECT trip_id, data_year, data_month, fare_amount FROM ident
WHERE NOT EXISTS (SELECT 1 FROM requests r WHERE r.kind = 'erasure' AND r.trip_id = ident.trip_id)""",
    "withdrawal_filtered": CONSENT + _REQUESTS + """,
gone AS (SELECT DISTINCT trip_id, category FROM requests WHERE kind = 'withdrawal')
SELECT trip_id,
  consent_ml_training AND (trip_id, 'ml_training') NOT IN (SELECT (trip_id, category) FROM gone)
    AS consent_ml_training,
  consent_analytics AND (trip_id, 'analytics') NOT IN (SELECT (trip_id, category) FROM gone)
    AS consent_analytics,
  consent_operational FROM consent""",
    "dsr_outcomes": OUTCOMES + "\nSELECT * FROM outcomes",
    "audit_events": OUTCOMES + "\nSELECT * FROM audit",
    "year_summary": SUMMARY + "\nSELECT * FROM summary",
    "year_over_year": SUMMARY + f"""
SELECT data_year, lag(data_year) OVER w AS previous_year,
  {_r('(total_rows / CAST(lag(total_rows) OVER w AS DOUBLE) - 1) * 100', 1)} AS trips_change_pct,
  {_r('(trust_score - lag(trust_score) OVER w) * 10', 1)} AS trust_change_points,
  {_r('avg_fare_amount - lag(avg_fare_amount) OVER w', 1)} AS avg_fare_change
FROM summary WINDOW w AS (ORDER BY data_year)""",
    "seasonal_profile": SCORES + """
SELECT data_month, CAST(round_even(avg(total_rows), 0) AS BIGINT) AS avg_trips, count(*) AS years_of_data
FROM trust WHERE data_year <> 2020 GROUP BY data_month""",
    "peak_trough": SCORES + f"""
SELECT * FROM
  (SELECT {_PERIOD} AS peak_period, total_rows AS peak_trips FROM trust
   ORDER BY total_rows DESC, data_year, data_month LIMIT 1),
  (SELECT {_PERIOD} AS trough_period, total_rows AS trough_trips FROM trust
   ORDER BY total_rows, data_year, data_month LIMIT 1)""",
    "fare_per_mile_year": SCORES + f"""
SELECT data_year, {_r(f'avg({_PER_MILE})', 6)} AS fare_per_mile FROM trust GROUP BY data_year""",
    "volume_by_era": QUALITY + f"\nSELECT {_PERIOD} AS period, schema_version, total_rows FROM quality",
    "volume_trend": SCORES + """
SELECT data_year AS year, data_month AS month, total_rows AS total_trips, volume_anomaly_score, trust_score
FROM trust""",
    "shock_year": SCORES + """
SELECT data_month AS month, total_rows AS total_trips, avg_fare_amount AS avg_fare,
  avg_trip_distance_miles AS avg_distance_miles, avg_passenger_count AS avg_passengers,
  volume_anomaly_score, trust_score FROM trust WHERE data_year = 2020""",
    "fare_evolution": SCORES + f"""
SELECT data_year AS year, data_month AS month, avg_fare_amount AS avg_fare,
  avg_trip_distance_miles AS avg_distance_miles, avg_passenger_count AS avg_passengers,
  total_rows AS total_trips, {_PER_MILE} AS fare_per_mile FROM trust""",
    "month_review": SCORES + f"""
SELECT data_year, data_month,
  ['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec'][data_month] AS month_label,
  total_rows AS trips, {_r('trust_score * 10', 1)} AS trust_out_of_10,
  {_r('volume_anomaly_score * 100', 0)} AS volume_pct, {_r('avg_fare_amount', 2)} AS avg_fare,
  {_DRIVER} AS risk_driver FROM trust""",
    "representative_month": SCORES + """
SELECT * FROM trust QUALIFY row_number() OVER (PARTITION BY data_year ORDER BY data_month) = 1""",
    "report_payloads": SCORES + "\n" + "\nUNION ALL ".join(
        [
            _document("lineage", _LOAD_YEAR, "SELECT * FROM lineage", _LINEAGE_FIELDS,
                      "ingested_at, partition_key"),
            _document("schema_evolution", _LOAD_YEAR, "SELECT * FROM evolution", _EVOLUTION_FIELDS,
                      "ingested_at, partition_key"),
            _document("trust_score", "data_year", "SELECT * FROM trust QUALIFY row_number() OVER"
                      " (PARTITION BY data_year ORDER BY data_month) = 1", _TRUST_FIELDS, "data_month"),
            _document("business_context", "data_year", _SAMPLED.format(_SAMPLE_ORDER), _SAMPLE_FIELDS, "place"),
            _document("coverage_gaps", "data_year", _SAMPLED.format(_SAMPLE_ORDER), _SAMPLE_FIELDS, "place"),
            _document("volume_trends", "NULL", "SELECT data_year AS year, data_month AS month,"
                      " total_rows AS total_trips, volume_anomaly_score, trust_score FROM trust",
                      ["year", "month", "total_trips", "volume_anomaly_score", "trust_score"], "year, month"),
            _document("covid_impact", "2020", "SELECT data_month AS month, total_rows AS total_trips,"
                      " avg_fare_amount AS avg_fare, avg_trip_distance_miles AS avg_distance_miles,"
                      " avg_passenger_count AS avg_passengers, volume_anomaly_score, trust_score"
                      " FROM trust WHERE data_year = 2020",
                      ["month", "total_trips", "avg_fare", "avg_distance_miles", "avg_passengers",
                       "volume_anomaly_score", "trust_score"], "month"),
            _document("fare_evolution", "NULL", "SELECT data_year AS year, data_month AS month,"
                      " avg_fare_amount AS avg_fare, avg_trip_distance_miles AS avg_distance_miles,"
                      " avg_passenger_count AS avg_passengers, total_rows AS total_trips,"
                      f" {_PER_MILE} AS fare_per_mile FROM trust",
                      ["year", "month", "avg_fare", "avg_distance_miles", "avg_passengers",
                       "total_trips", "fare_per_mile"], "year, month"),
            _document("seasonal_patterns", "NULL", "SELECT data_month,"
                      " CAST(round_even(avg(total_rows), 0) AS BIGINT) AS avg_trips,"
                      " count(*) AS years_of_data FROM trust WHERE data_year <> 2020 GROUP BY data_month",
                      ["data_month", "avg_trips", "years_of_data"], "data_month"),
        ]
    ),
    "latest_narratives": NARRATIVES + """
SELECT pain_point,
  CASE WHEN pain_point IN ('business_context', 'trust_score', 'coverage_gaps') THEN data_year END AS data_year,
  generated_at, narrative_json FROM narratives
QUALIFY row_number() OVER (PARTITION BY pain_point,
  CASE WHEN pain_point IN ('business_context', 'trust_score', 'coverage_gaps') THEN data_year END
  ORDER BY generated_at DESC, narrative_json DESC) = 1""",
    "narratives_parsed": NARRATIVES + """
SELECT pain_point, data_year, generated_at,
  CASE WHEN json_valid(narrative_json) THEN narrative_json ->> '$.headline' END AS headline,
  CASE WHEN json_valid(narrative_json) THEN CAST(narrative_json ->> '$.trust_score' AS DOUBLE) END AS trust_score,
  CASE WHEN NOT json_valid(narrative_json) THEN narrative_json END AS raw
FROM narratives""",
    "narratives_typed": NARRATIVES + f""",
j AS (SELECT *, CASE WHEN json_valid(narrative_json) THEN narrative_json END AS doc FROM narratives)
SELECT pain_point, generated_at, doc ->> '$.headline' AS headline, CAST({_typed(0)} AS DOUBLE) AS number,
  {_typed(1)} AS detail, CASE WHEN doc IS NULL THEN narrative_json END AS raw FROM j""",
    "narratives_selected": NARRATIVES + """
SELECT pain_point, data_year, generated_at, narrative_json FROM narratives
WHERE pain_point = 'coverage_gaps' AND data_year = 2019 ORDER BY generated_at DESC""",
    "quality_for_year": QUALITY + "\nSELECT * FROM quality WHERE data_year = 2019 ORDER BY data_month",
    "checks_report": _after(
        MARTS + QUALITY[len(STAGED):] + _LOADS + _EVOLUTION + SCORES[len(QUALITY + _LOADS + _EVOLUTION):],
        INVENTORY,
    ) + f"\nSELECT *, failures = 0 AS passed FROM ({_CHECKS})",
}
