from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripguard.operators import consent, identity, marts, policy, requests, retention, risk

# Five trips between two zones within an hour of a Wednesday, and one apart.
SAMPLE = [(f"together-{i}", f"2021-06-16 17:{7 * i:02d}:00", 44, 90) for i in range(5)]
SAMPLE.append(("alone", "2021-06-16 04:31:00", 7, 12))


@pytest.fixture(scope="module")
def sample(spark):
    rows = spark.createDataFrame(SAMPLE, "trip_id string, at string, pu_location_id long, do_location_id long")
    return risk.with_time_parts(rows.withColumn("pickup_at", F.col("at").cast("timestamp")))


def by_id(df, *columns):
    return {r["trip_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_sample_trips(sample):
    got = by_id(risk.with_k(sample), "k_anonymity", "risk_level", "is_high_reidentification_risk")
    assert got["together-0"] == (5, "moderate", False)
    assert got["alone"] == (1, "critical", True)


def test_weekday_conventions(sample):
    row = sample.first()
    assert (row["pickup_hour"], row["pickup_weekday"], row["pickup_day_of_week"]) == (17, 2, 4)


def test_threshold_of_two(spark):
    rows = [("p", 30, None, 6, 3), ("q", 30, None, 6, 3), ("r", 30, 31, 6, 3)]
    names = "trip_id string, " + ", ".join(f"{c} long" for c in risk.QUASI_IDENTIFIERS)
    scored = risk.with_k(spark.createDataFrame(rows, names), k=2, label=True)
    got = by_id(scored, "k_anonymity", "is_high_reidentification_risk", "equivalence_class")
    pair = (2, False, "30|None|6|3")
    assert got == {"p": pair, "q": pair, "r": (1, True, "30|31|6|3")}


def test_summary(sample, spark):
    classes = risk.equivalence_classes(sample)
    assert tuple(risk.risk_summary(classes).first()) == (6, 1, 0.1667, 1, 5)
    assert tuple(risk.risk_summary(classes.limit(0)).first()) == (0, 0, 0.0, None, None)


def test_min_k_pivot(sample):
    rows = {r["pu_location_id"]: r for r in risk.min_k_pivot(risk.equivalence_classes(sample)).collect()}
    assert rows[44]["hour_17"] == 5 and rows[7]["hour_04"] == 1
    assert rows[44]["hour_04"] == 0


def test_generalisation_merges_classes(spark):
    rows = [("target", 161, 230, 22, 4), ("near_1", 161, 230, 22, 5), ("near_2", 162, 230, 22, 4)]
    names = "trip_id string, " + ", ".join(f"{c} long" for c in risk.QUASI_IDENTIFIERS)
    coarser = {c: F.lit(0) for c in ("pu_location_id", "do_location_id", "pickup_day_of_week")}
    impact = risk.generalisation_impact(spark.createDataFrame(rows, names), coarser, k=3)
    assert by_id(impact, "k_before", "k_after")["target"] == (1, 3)


def test_k_equals_counting_window_on_random_rows(spark):
    random.seed(11)
    rows = [
        (str(i), *[random.choice([None, 0, 1, 2, -1]) for _ in range(2)], random.randrange(3), random.randrange(2))
        for i in range(2000)
    ]
    names = "trip_id string, " + ", ".join(f"{c} long" for c in risk.QUASI_IDENTIFIERS)
    trips = spark.createDataFrame(rows, names)
    window = trips.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy(*risk.QUASI_IDENTIFIERS)))
    assert by_id(risk.with_k(trips), "k_anonymity") == by_id(window, "k")
    assert risk.equivalence_classes(trips).agg(F.sum("k_anonymity")).first()[0] == 2000


def test_class_counts_of_months_add_up(sample):
    parts = [sample.filter("trip_id < 'together-2'"), sample.filter("trip_id >= 'together-2'")]
    counts = risk.equivalence_classes(parts[0]).unionByName(risk.equivalence_classes(parts[1]))
    merged = risk.merge_class_counts(counts)
    assert sorted(map(repr, merged.collect())) == sorted(
        map(repr, risk.equivalence_classes(sample).select(*merged.columns).collect())
    )


def test_suppression(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 2), ("c", None)], "trip_id string, k_anonymity long")
    assert [r["trip_id"] for r in risk.suppress_outliers(rows).collect()] == ["a"]


def staged_copies(spark, copies):
    return spark.range(copies).selectExpr(
        "'f-2020-04.parquet' as source_file", "timestamp '2020-04-01 08:00:00' as pickup_at",
        "timestamp '2020-04-01 08:10:00' as dropoff_at", "12.5D as total_amount", "'1' as vendor_id",
        "id % 3 as passenger_count", "1.0D as trip_distance_miles", "10.0D as fare_amount",
        "1L as pu_location_id", "2L as do_location_id", "1L as payment_type",
    )


def test_ids_of_copies_are_distinct_and_stable(spark):
    trips = staged_copies(spark, 3000)
    plain = {r["trip_id"] for r in identity.with_trip_id(trips).collect()}
    hot = identity.with_trip_id(trips.repartition(5), hot_rows=100)
    assert len(plain) == 3000 and plain == {r["trip_id"] for r in hot.collect()}


@pytest.mark.parametrize("hot_rows", [10**6, 2])
def test_trips_keep_their_ids_when_loaded_again(spark, hot_rows):
    """Trips alike in the key and the order columns differ in tips and places."""
    trips = staged_copies(spark, 6).drop("passenger_count").selectExpr(
        "*", "1L as passenger_count", "cast(row_number() over (order by uuid()) as double) as tip_amount",
        "current_timestamp() as ingested_at",
    )
    tips = lambda df: {r["trip_id"]: r["tip_amount"] for r in identity.with_trip_id(df, hot_rows=hot_rows).collect()}
    first = tips(trips.orderBy("tip_amount"))
    assert len(first) == 6
    again = trips.withColumn("ingested_at", F.expr("current_timestamp() - make_dt_interval(0, int(tip_amount))"))
    assert first == tips(again.orderBy(F.desc("tip_amount")).repartition(3))


@pytest.mark.parametrize("hot_rows", [10**6, 2])
@pytest.mark.parametrize(
    "shown", [[], ["data_year"], ["pu_location_id", "do_location_id"], ["fare_amount", "total_amount"], ["tip_amount"]]
)
def test_ids_are_the_same_if_few_columns_are_moved(spark, shown, hot_rows):
    """Trips alike in the key but for decimals that its text does not tell, and in some of the order."""
    trips = staged_copies(spark, 60).crossJoin(spark.sql("select explode(sequence(0, 2)) as i")).selectExpr(
        "source_file", "pickup_at", "dropoff_at", "12.5D + (passenger_count * i % 2) / 1e9D as total_amount",
        "vendor_id", "passenger_count % 2 as passenger_count", "trip_distance_miles",
        "double(i % 2) as fare_amount", "pu_location_id", "passenger_count + i as do_location_id", "payment_type",
        "double(-passenger_count * i) as airport_fee", "double(passenger_count) as tip_amount", "2020 as data_year",
    )
    seen = lambda df: sorted(map(repr, df.select("trip_id", *shown).collect()))
    few = identity.with_trip_id(trips, shown, hot_rows=hot_rows)
    assert seen(few) == seen(identity.with_trip_id(trips))
    assert len(few.columns) < len(identity.with_trip_id(trips).columns) or shown == ["tip_amount"]


def test_drawn_consent(spark):
    flags = consent.with_drawn_consent(spark.sql("select 'trip-1' as trip_id")).first()
    assert flags["consent_ml_training"] and flags["consent_operational"]
    many = consent.with_drawn_consent(spark.range(20000).selectExpr("cast(id as string) as trip_id"))
    shares = many.selectExpr("avg(int(consent_ml_training)) as ml", "avg(int(consent_analytics)) as an").first()
    assert abs(shares["ml"] - 0.8) < 0.02 and abs(shares["an"] - 0.9) < 0.02


def test_consent_table_takes_the_latest_status(spark):
    records = spark.sql(
        "select * from values ('a','ml_training',true,timestamp '2024-01-01'),"
        "('a','ml_training',false,timestamp '2024-02-01'),('a','analytics',true,timestamp '2024-01-01'),"
        "('b','ml_training',true,timestamp '2024-01-01') t(trip_id, category, status, effective_at)"
    )
    trips = spark.sql("select explode(array('a','b','c')) as trip_id")
    columns = ("consent_ml_training", "consent_analytics", "consent_operational")
    assert by_id(consent.with_consent_table(trips, records), *columns) == {
        "a": (False, True, True), "b": (True, False, True), "c": (False, False, True),
    }
    early = consent.with_consent_table(trips, records, as_of="2024-01-15")
    assert by_id(early, *columns)["a"] == (True, True, True)


def test_transform_drops_raw_place_and_time(spark):
    trips = spark.sql(
        "select 'trip-1' as trip_id, '2020-04-01T10:15:30' as pickup_at, -73.98D as pickup_longitude,"
        " 40.75D as pickup_latitude, 161 as pu_location_id"
    )
    out = policy.transform_trips(trips)
    assert sorted(out.columns) == ["pickup_hour", "pu_location_id", "trip_pseudonym"]
    row = out.first()
    assert row["pickup_hour"].endswith("10:00:00")
    assert row["trip_pseudonym"] == "d1612ba6af05e29d8d8b482e"
    with pytest.raises(ValueError):
        policy.transform_trips(trips, bucket="day")


def test_transform_falls_back_to_the_file(spark):
    rows = spark.sql("select cast(null as string) as trip_id, 'f' as source_file")
    direct = spark.sql("select 'f' as trip_id")
    assert policy.transform_trips(rows).first()["trip_pseudonym"] == policy.transform_trips(direct).first()["trip_pseudonym"]


def test_inventory(spark):
    columns = policy.columns_frame(spark, {"stg": ["Pickup_At", "pickup_longitude", "schema_version"]})
    rows = {r["column_name"]: r for r in policy.pii_inventory(columns).collect()}
    assert rows["Pickup_At"]["pii_type"] == "quasi_identifier" and rows["Pickup_At"]["is_policy_match"]
    assert rows["pickup_longitude"]["handling"] == "suppress"
    assert rows["schema_version"]["pii_type"] == "non_pii" and not rows["schema_version"]["is_policy_match"]


REQUESTS = "seq long, trip_id string, kind string, category string, actor string, requested_at timestamp"


def asked(spark, *rows):
    return spark.createDataFrame(
        [(i, trip, kind, category, "demo") for i, (trip, kind, category) in enumerate(rows)],
        "seq long, trip_id string, kind string, category string, actor string",
    ).withColumn("requested_at", F.lit("2024-01-01").cast("timestamp"))


def test_requests_in_order(spark):
    trips = spark.sql("select 'trip-1' as trip_id, 12.5D as fare_amount")
    rows = asked(
        spark, ("trip-1", "access", None), ("trip-1", "withdrawal", "ml_training"), ("trip-1", "access", None),
        ("trip-1", "erasure", None), ("trip-1", "access", None), ("trip-1", "erasure", None),
        ("nobody", "erasure", None), ("nobody", "access", None),
    )
    got = requests.request_outcomes(rows, trips, ["fare_amount"]).orderBy("seq").collect()
    assert [r["status"] for r in got] == [
        "found", "withdrawn", "found", "marked_for_erasure", "not_found", "marked_for_erasure",
        "marked_for_erasure", "not_found",
    ]
    assert got[0]["record"]["fare_amount"] == 12.5 and got[4]["record"] is None
    assert [r["record_existed"] for r in got if r["kind"] == "erasure"] == [True, True, False]
    events = requests.audit_events(requests.request_outcomes(rows, trips, [])).collect()
    by_type = {r["event_type"]: r for r in events}
    assert by_type["dsr_access_request"]["gdpr_article"] == "GDPR Article 15"
    assert by_type["dsr_erasure_request"]["ccpa_section"] == "CCPA Section 1798.105"
    assert by_type["consent_withdrawal"]["details_json"] == (
        '{"category":"ml_training","downstream_action":"exclude_from_ml_training"}'
    )
    assert len({r["event_id"] for r in events}) == 8


def test_one_subject_with_most_requests(spark):
    trips = spark.sql("select explode(array('hot','cold')) as trip_id")
    many = [("hot", "erasure" if i == 400 else "access", None) for i in range(1000)] + [("cold", "access", None)]
    got = requests.request_outcomes(asked(spark, *many), trips, [])
    counts = {(r["trip_id"], r["status"]): r["count"] for r in got.groupBy("trip_id", "status").count().collect()}
    assert counts == {
        ("hot", "found"): 400, ("hot", "marked_for_erasure"): 1, ("hot", "not_found"): 599, ("cold", "found"): 1,
    }


def test_erasure_and_withdrawal_reach_the_rows(spark):
    trips = spark.sql("select explode(array('a','b','c')) as trip_id").selectExpr(
        "*", "true as consent_ml_training", "true as consent_analytics"
    )
    rows = asked(spark, ("a", "erasure", None), ("b", "withdrawal", "analytics"), ("b", "withdrawal", "analytics"))
    assert sorted(by_id(requests.exclude_erased(trips, rows), "trip_id")) == ["b", "c"]
    assert by_id(requests.apply_withdrawals(trips, rows), "consent_ml_training", "consent_analytics") == {
        "a": (True, True), "b": (True, False), "c": (True, True),
    }
    assert requests.withdrawals(rows).count() == 1


def test_retention(spark):
    trips = spark.sql(
        "select timestamp '2023-01-01' as pickup_at, -73.9D as pickup_longitude, 1 as fare union all"
        " select timestamp '2024-01-01', -73.9D, 2"
    )
    rows = retention.suppress_raw(trips, "2024-06-01").orderBy("fare").collect()
    assert rows[0]["pickup_at"] is None and rows[0]["pickup_longitude"] is None
    assert rows[1]["pickup_longitude"] == -73.9
    months = spark.sql("select explode(sequence(1, 12)) as data_month, 2022 as data_year")
    assert sorted(r["data_month"] for r in retention.expire_features(months, "2024-06-29").collect()) == list(range(6, 13))
    audit = spark.sql("select timestamp '2017-01-01' as timestamp union all select timestamp '2024-01-01'")
    assert sorted(r["is_archived"] for r in retention.mark_archived(audit, "2024-06-01").collect()) == [False, True]


def test_marts_refuse_raw_columns(spark):
    with pytest.raises(ValueError, match="trip_id"):
        marts.assert_no_forbidden_columns(spark.sql("select 'x' as trip_id"))


def test_a_class_with_a_third_of_all_rows_is_split(spark):
    """Too many classes to broadcast: the adaptive plan splits the hot one."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    trips = spark.range(0, 60000, numPartitions=8).selectExpr(
        "cast(id as string) as trip_id", "if(id % 3 = 0, null, id % 500) as pu_location_id",
        "if(id % 3 = 0, null, id % 7) as do_location_id", "if(id % 3 = 0, 8, id % 24) as pickup_hour",
        "if(id % 3 = 0, 1, id % 7) as pickup_day_of_week",
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        scored = risk.with_k(trips)
        assert scored.count() == 60000
        assert scored.agg(F.max("k_anonymity")).first()[0] == 20000
        plan = scored.select("trip_id", "k_anonymity")
        plan.collect()
        assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


CLASS = "pu_location_id int, do_location_id int, pickup_hour long, pickup_day_of_week long"


def test_changed_classes_are_those_that_cross_a_level_or_shrink(spark):
    pairs = [(0, 1), (1, 1), (1, 2), (2, 4), (4, 5), (5, 14), (14, 15), (15, 99), (99, 98), (3, 0), (None, 6)]
    old = [(i if i else None, 1, 8, 1, before) for i, (before, _) in enumerate(pairs) if before]
    new = [(i if i else None, 1, 8, 1, after) for i, (_, after) in enumerate(pairs) if after]
    frames = [spark.createDataFrame(x, f"{CLASS}, k_anonymity long") for x in (old, new)]
    found = {r["pu_location_id"] for r in risk.changed_classes(*frames).collect()}
    assert found == {2, 4, 6, 8, 9, 10}


def test_least_generalisation_prunes_above_what_will_do(spark):
    from itertools import product

    def search(rows, **options):
        classes = spark.createDataFrame(rows, f"{CLASS}, k_anonymity long")
        return sorted(tuple(r) for r in risk.least_generalisation(classes, **options).collect())

    large = [(z, z, h, 2, 9) for z in (1, 2, 30) for h in (1, 9)]
    assert search(large) == [(0, 0, 0, 54, 6, 0, 9)]
    # One trip alone: zones of three, or all hours, or neither but one class.
    assert search([*large, (0, 0, 1, 2, 1)]) == [(1, 0, 0, 55, 4, 0, 9)]
    assert search([*large, (0, 0, 1, 2, 1)], most_at_risk=0.5) == [(0, 0, 0, 55, 7, 1, 1)]
    assert search([(None, None, 1, 1, 1), (None, 4, 2, 7, 3)]) == []
    assert search([]) == []
    rows = [(z, z + 1, h, w, 1 + (z * h + w) % 5) for z, h, w in product(range(4), range(0, 24, 5), range(1, 8, 2))]
    nodes = {tuple(r[:3]) for r in search(rows, most_at_risk=0.1)}
    assert nodes and not any(a != b and all(x <= y for x, y in zip(a, b)) for a, b in product(nodes, nodes))


def test_class_diversity(spark):
    import math

    trips = [(1, 1, 8, 1, 1, 5.0)] * 3 + [(1, 1, 8, 1, 2, 5.0)] + [(2, 2, 8, 1, None, None)] * 4
    frame = spark.createDataFrame(trips, f"{CLASS}, payment_type long, fare_amount double")
    found = {r["pu_location_id"]: r for r in risk.class_diversity(risk.class_histograms(frame)).collect()}
    one, two = found[1], found[2]
    assert (one["k_anonymity"], one["distinct_values"], one["largest_value"]) == (4, 2, 3)
    assert one["entropy_l"] == round(math.exp(-(0.75 * math.log(0.75) + 0.25 * math.log(0.25))), 6)
    assert one["distance"] == two["distance"] == 0.5 and two["entropy_l"] == 1.0
    assert risk.class_diversity(risk.class_histograms(frame.limit(0))).count() == 0


def test_first_rows_of_each_year_equal_the_years_samples(spark):
    from tripguard.plans import driver_tables
    from tripguard.operators import staging

    staged = driver_tables.kept(driver_tables.staged(spark, "/root/testdata/sf0.001"))
    first = staging.first_rows_by_year(staged, 7)
    years = [r["data_year"] for r in staging.loaded_years(staged).collect()]
    assert len(years) == 8 and first.count() == 7 * len(years)
    for year in years[:3]:
        want = sorted(map(repr, staging.sample_rows(staged, year, 7).collect()))
        assert sorted(map(repr, first.filter(f"data_year = {year}").select(*staging.SAMPLE_COLUMNS).collect())) == want
    plan = staging.first_rows_by_year(driver_tables.staged(spark, "/root/testdata/sf0.001"), 7)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("bucket", ["day", "hour", "year"])
def test_consent_in_force_equals_a_look_through_each_history(spark, bucket):
    """A third of all rows are of one subject; times tie, records expire, some rows have no subject or time."""
    from datetime import datetime, timedelta

    rng = random.Random(4)
    who = lambda: rng.choice([0, 0, 0, rng.randrange(1, 9), rng.randrange(1, 9), None])
    when = lambda: datetime(2024, 1, 1) + timedelta(hours=rng.randrange(0, 24 * 40, 6))
    categories = ["ml_training", "analytics", "operational", "other"]
    records = []
    for _ in range(250):
        start = when()
        until = start + timedelta(hours=rng.randrange(200)) if rng.random() < 0.4 else None
        records.append((who(), rng.choice(categories), rng.choice([True, True, False, None]), start, until))
    trips = [(i, who(), when() if i % 11 else None) for i in range(300)]
    ledger = spark.createDataFrame(records, "rider long, category string, status boolean, effective_at timestamp, expires_at timestamp")
    frame = spark.createDataFrame(trips, "i long, rider long, t timestamp")
    found = consent.consent_in_force(frame, ledger, "rider", "t", bucket)
    want = []
    for i, rider, t in trips:
        flags = []
        for c in categories[:3]:
            known = [r for r in records if rider is not None and t and r[0] == rider and r[1] == c and r[3] <= t]
            newest = max((r[3] for r in known), default=None)
            last = [r for r in known if r[3] == newest]
            flags.append(all(r[2] and (r[4] is None or r[4] > t) for r in last) if last else c == "operational")
        want.append((i, rider, t, *flags))
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, want))
    assert found.columns == ["i", "rider", "t", *consent.CONSENT_COLUMNS]
    assert sum(f[3] for f in want) > 30
    assert consent.consent_in_force(frame.limit(0), ledger, "rider", "t").count() == 0
    assert consent.consent_in_force(frame, ledger.limit(0), "rider", "t").filter("consent_analytics").count() == 0


def test_no_hidden_cell_can_be_subtracted_from_a_total(spark):
    rng = random.Random(6)
    rows = []
    for month in (1, 2, 3):
        for zone in [None, *range(4)]:
            for other in range(4):
                for hour in rng.sample(range(24), 3 if month < 3 else 1):
                    rows.append((2024, month, zone, other, hour, rng.choice([1, 3, 4, 5, 8, 30, 60, 90])))
    rows.append((2025, 1, 1, 1, 1, 2))
    schema = "data_year int, data_month int, pickup_zone_id int, dropoff_zone_id int, pickup_hour long, trip_count long"
    cells = spark.createDataFrame(rows, schema).withColumn("hidden", F.when(F.col("trip_count") < 5, "primary"))
    assert marts.recoverable_cells(cells).count() > 5
    kept = marts.protect_cells(cells)
    found = {tuple(r)[:5]: r for r in kept.collect()}
    assert len(found) == len(rows) and all((r["hidden"] == "primary") == (r["trip_count"] < 5) for r in found.values())
    totals = {tuple(r)[:4]: r["trip_count"] for r in marts.line_totals(kept).collect()}
    places = {"pickup_zone": 2, "dropoff_zone": 3, "hour": 4}
    known = {c: r["trip_count"] for c, r in found.items() if r["hidden"] is None}
    assert 0 < len(known) < sum(r[5] >= 5 for r in rows)
    before = dict(known)
    while True:  # what anyone can do with the published cells and totals
        solved = {}
        for (year, month, kind, key), total in totals.items():
            line = [c for c in found if c[:2] == (year, month) and (None if c[places[kind]] is None else str(c[places[kind]])) == key]
            open_ = [c for c in line if c not in known]
            if total is not None and len(open_) == 1:
                solved[open_[0]] = total - sum(known[c] for c in line if c in known)
        if not solved:
            break
        known |= solved
    assert known == before
    for year, month, kind in {k[:3] for k in totals}:
        line = [t for k, t in totals.items() if k[:3] == (year, month, kind)]
        assert line.count(None) != 1 or len(line) == 1
    assert totals[2025, 1, "hour", "1"] is None and any(t is not None for t in totals.values())
    assert marts.protect_cells(cells.limit(0)).count() == 0
