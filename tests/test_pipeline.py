"""The whole job over files, twice, with requests in between."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tripguard.operators import evolution, marts
from tripguard.plans import driver_tables as d
from tripguard.plans import pipeline
from tripguard.plans.queries import QUERIES
from tripguard.sources import tables
from tripguard.sources.ingest import ingest

SF = "/root/testdata/sf0.001"
SALT = marts.PSEUDONYM_SUFFIX


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Month files written from the derived trips, loaded and modelled."""
    folder = tmp_path_factory.mktemp("landing")
    trips = d.unified(spark, SF).drop("ingested_at", "schema_version", "data_year", "data_month")
    # One folder per month, then one path per month file.
    trips.repartition("source_file").withColumn("f", F.col("source_file")).write.partitionBy("f").parquet(f"{folder}/by_file")
    paths = []
    for part in sorted(folder.glob("by_file/f=*")):
        (file,) = part.glob("*.parquet")
        target = folder / part.name[2:]
        target.write_bytes(file.read_bytes())
        paths.append(str(target))
    root = str(tmp_path_factory.mktemp("lake"))
    ingest(spark, paths, root, datetime(2024, 2, 1, tzinfo=timezone.utc), "run-1")
    report = pipeline.run(spark, root, "2024-06-01 00:00:00", SALT, keyed=False).collect()
    return root, paths, report


def rows(df, drop=()):
    kept = sorted(c for c in df.columns if c not in drop)
    return sorted(map(repr, (tuple(r) for r in df.select(*kept).collect())))


def test_checks_pass(lake):
    report = lake[2]
    assert len(report) == 19
    assert [r for r in report if not r["passed"]] == []


@pytest.mark.parametrize("name", ["mart_ml_safe", "mart_analytics_safe"])
def test_marts_equal_the_queries(spark, lake, name):
    written = spark.read.parquet(f"{lake[0]}/{name}")
    direct = QUERIES[name](spark, SF)
    if name == "mart_ml_safe":
        assert written.select("trip_pseudonym").distinct().count() == written.count()
    assert rows(written.select(*direct.columns)) == rows(direct)


def test_quality_equals_the_query(spark, lake):
    written = spark.read.parquet(f"{lake[0]}/quality_metrics")
    direct = QUERIES["quality_metrics"](spark, SF)
    skip = ("first_ingested_at", "last_ingested_at", "computed_at")
    assert rows(written, skip) == rows(direct, skip)


def test_rerun_changes_nothing(spark, lake):
    root, paths, _ = lake
    before = {t: rows(spark.read.parquet(f"{root}/{t}")) for t in ("mart_ml_safe", "class_counts", "quality_metrics")}
    ingest(spark, paths[:2], root, datetime(2024, 2, 1, tzinfo=timezone.utc), "run-2")
    months = [p[-15:-8] for p in paths[:2]]
    pipeline.update_months(spark, root, months)
    pipeline.score(spark, root, "2024-06-01 00:00:00")
    pipeline.publish(spark, root, "2024-06-01 00:00:00", SALT, keyed=False)
    assert before == {t: rows(spark.read.parquet(f"{root}/{t}")) for t in before}


def test_requests_reach_the_mart(spark, lake):
    root = lake[0]
    consented = pipeline.consented_trips(spark, root)
    (erased,) = consented.filter("consent_ml_training and k_anonymity >= 5").select("trip_id").take(1)
    asked = spark.createDataFrame(
        [(1, erased["trip_id"], "access", None, "t"), (2, erased["trip_id"], "erasure", None, "t")],
        "seq long, trip_id string, kind string, category string, actor string",
    ).withColumn("requested_at", F.lit("2024-01-01").cast("timestamp"))
    left = pipeline.consented_trips(spark, root, asked)
    assert consented.count() - left.count() == 1
    for _ in range(2):
        outcomes = pipeline.answer_requests(spark, root, asked, ["fare_amount"])
    assert {r["status"] for r in outcomes.collect()} == {"found", "marked_for_erasure"}
    assert spark.read.parquet(f"{root}/audit_log").count() == 2


def test_a_new_month_rewrites_only_what_it_changes(spark, lake):
    """One month of 81 comes last; the tables are then those of a whole run."""
    root, paths, _ = lake
    last = max(p[-15:-8] for p in paths)
    at = lambda t: spark.read.parquet(f"{root}/{t}")
    late = tuple(map(int, last.split("-")))
    sizes, months = f"{root}/class_sizes", len(paths)
    try:
        # As if the last month had never been there.
        counts = at("class_counts").filter(~((F.col("data_year") == late[0]) & (F.col("data_month") == late[1])))
        earlier = pipeline.risk.merge_class_counts(spark.createDataFrame(counts.collect(), counts.schema))
        tables.replace(earlier, sizes)
        trips = [f"{root}/{t}" for t in ("consented_trips", "reidentification_risk", "mart_ml_safe", "mart_analytics_safe")]
        for path in trips:
            tables.remove_months(spark, path, [late])
        before = {p: set(at(p[len(root) + 1 :]).inputFiles()) for p in trips}
        done = pipeline.publish(spark, root, "2024-06-01 00:00:00", SALT, keyed=False, months=[last])
        assert last in done and len(done) < months
        kept = {f for f in before[trips[0]] if f in set(at("consented_trips").inputFiles())}
        assert {tuple(int(x.split("=")[1]) for x in f.split("/")[-3:-1]) for f in kept}.isdisjoint(
            {tuple(map(int, m.split("-"))) for m in done}
        ) and kept
        now = at("class_sizes")
        told = {t: rows(at(t), ("k_anonymity", "minimum_trip_k", "scored_at", "aggregated_at")) for t in map(lambda p: p.rsplit("/", 1)[1], trips)}
        exact = rows(pipeline.risk.with_current_k(at("reidentification_risk"), now), ("scored_at",))
        assert at("reidentification_risk").join(
            pipeline.risk.with_current_k(at("reidentification_risk"), now).select("trip_id", F.col("k_anonymity").alias("now")), "trip_id"
        ).filter("k_anonymity > now").isEmpty()
    finally:
        assert pipeline.publish(spark, root, "2024-06-01 00:00:00", SALT, keyed=False) is None
    assert exact == rows(at("reidentification_risk"), ("scored_at",))
    assert told == {t: rows(at(t), ("k_anonymity", "minimum_trip_k", "scored_at", "aggregated_at")) for t in told}


@pytest.fixture
def small_lake(spark, tmp_path):
    """Six trips in one class and one alone, of two months four years apart, and a month of none."""
    rows = [(f"2019-03-05 08:0{i}:00", 3, 4, float(i)) for i in range(6)] + [("2023-03-05 23:00:00", 8, 9, 9.0)]
    trips = spark.createDataFrame(rows, "at string, pu int, do int, tip double").selectExpr(
        "'1' as VendorID", "cast(at as timestamp) as tpep_pickup_datetime",
        "cast(at as timestamp) + interval 9 minutes as tpep_dropoff_datetime", "1 as passenger_count",
        "1.5D as trip_distance", "1 as RatecodeID", "'N' as store_and_fwd_flag", "1 as payment_type",
        "10.0D as fare_amount", "0.5D as extra", "0.5D as mta_tax", "tip as tip_amount", "0.0D as tolls_amount",
        "12.0D + tip as total_amount", "pu as PULocationID", "do as DOLocationID",
        "0.3D as improvement_surcharge", "2.5D as congestion_surcharge", "1.0D as airport_fee",
    )
    paths = []
    for year in (2019, 2023):
        path = tmp_path / f"landing-{year}"
        trips.filter(f"year(tpep_pickup_datetime) = {year}").coalesce(1).write.parquet(str(path))
        (file,) = path.glob("part-*.parquet")
        target = tmp_path / f"yellow_tripdata_{year}-03.parquet"
        target.write_bytes(file.read_bytes())
        paths.append(str(target))
    root = str(tmp_path / "lake")
    ingest(spark, paths, root, datetime(2024, 2, 1, tzinfo=timezone.utc), "run-1")
    pipeline.update_months(spark, root)
    pipeline.score(spark, root, "2024-06-01 00:00:00")
    return root


def all_agreed(spark, root, **changes):
    rows = spark.read.parquet(f"{root}/identified_trips").selectExpr(
        "trip_id", "explode(array('ml_training', 'analytics')) as category", "true as status",
        "timestamp '2024-01-01' as effective_at", "timestamp '2030-01-01' as expires_at",
        "'desk' as collection_source", "'a-1' as audit_ref",
    )
    rows = rows.withColumns(changes)
    # A ledger of its own: the runs replace the table that the ids come from.
    return spark.createDataFrame(rows.collect(), rows.schema)


def asked_for(spark, ids, kind="erasure"):
    rows = [(i, t, kind, None, "t") for i, t in enumerate(ids)]
    return spark.createDataFrame(
        rows, "seq long, trip_id string, kind string, category string, actor string"
    ).withColumn("requested_at", F.lit("2010-01-01").cast("timestamp"))


def ids_of(spark, root):
    return [r["trip_id"] for r in spark.read.parquet(f"{root}/identified_trips").orderBy("tip_amount").collect()]


def counts_of(spark, root):
    return [tables.load(spark, f"{root}/{t}").count() for t in ("reidentification_risk", "mart_ml_safe", "mart_analytics_safe")]


def test_erasure_counts_classes_anew(spark, small_lake):
    consents = all_agreed(spark, small_lake)
    pipeline.publish(spark, small_lake, "2024-06-01 00:00:00", "s", consents=consents)
    assert counts_of(spark, small_lake) == [7, 6, 1]
    asked = asked_for(spark, ids_of(spark, small_lake)[:2])
    pipeline.publish(spark, small_lake, "2024-06-01 00:00:00", "s", asked, consents)
    assert counts_of(spark, small_lake) == [5, 0, 0]
    levels = spark.read.parquet(f"{small_lake}/reidentification_risk").groupBy("k_anonymity", "risk_level").count()
    assert sorted(tuple(r) for r in levels.collect()) == [(1, "critical", 1), (4, "high", 4)]


def test_consents_to_come_and_expired_ones_do_not_count(spark, small_lake):
    for changes in (
        {"effective_at": F.lit("2025-01-01").cast("timestamp")},
        {"expires_at": F.lit("2024-02-01").cast("timestamp")},
    ):
        pipeline.publish(spark, small_lake, "2024-06-01 00:00:00", "s", consents=all_agreed(spark, small_lake, **changes))
        assert counts_of(spark, small_lake) == [7, 0, 0]
    told = spark.read.parquet(f"{small_lake}/consented_trips").first()
    assert (told["consent_source"], told["consent_collection_source"], told["consent_audit_ref"]) == ("consent_table", "desk", "a-1")


def test_run_applies_requests_and_windows(spark, small_lake):
    ids = ids_of(spark, small_lake)
    report = pipeline.run(
        spark, small_lake, "2024-06-01 00:00:00", "s", asked=asked_for(spark, ids[:1]),
        consents=all_agreed(spark, small_lake), as_of="2024-06-01",
    )
    assert report.filter("not passed").count() == 0
    trips = spark.read.parquet(f"{small_lake}/identified_trips")
    assert trips.filter("pickup_at is not null").count() == 0 and trips.filter("pickup_hour = 8").count() == 6
    assert counts_of(spark, small_lake) == [6, 0, 1]  # training features of 2019 have expired
    assert spark.read.parquet(f"{small_lake}/request_outcomes").first()["status"] == "marked_for_erasure"
    assert spark.read.parquet(f"{small_lake}/audit_archive").count() == 1
    assert pipeline.current_audit(spark, small_lake).count() == 0
    pipeline.archive_audit(spark, small_lake, "2024-06-01")
    assert spark.read.parquet(f"{small_lake}/audit_archive").count() == 1
    assert ids == ids_of(spark, small_lake)


def test_months_pass_the_raw_window_between_runs(spark, small_lake):
    pipeline.update_months(spark, small_lake, as_of="2019-06-01")
    assert pipeline.expired_months(spark, small_lake, "2019-06-01") == []
    assert pipeline.expired_months(spark, small_lake, "2023-06-01") == ["2019-03"]
    pipeline.run(spark, small_lake, "2023-06-01 00:00:00", "s", months=["2023-03"], as_of="2023-06-01")
    left = spark.read.parquet(f"{small_lake}/identified_trips").filter("pickup_at is not null")
    assert [tuple(r) for r in left.select("data_year").distinct().collect()] == [(2023,)]


def test_a_month_without_valid_trips_leaves_the_derived_tables(spark, small_lake, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "yellow_tripdata_2023-03.parquet")
    pq.write_table(pq.read_table(path).slice(0, 0), path)
    ingest(spark, [path], small_lake, datetime(2024, 2, 2, tzinfo=timezone.utc), "run-2")
    pipeline.update_months(spark, small_lake, ["2023-03"])
    for table in ("identified_trips", "class_counts", "monthly_counts"):
        assert spark.read.parquet(f"{small_lake}/{table}").filter("data_year = 2023").count() == 0
        assert spark.read.parquet(f"{small_lake}/{table}").count() > 0


def test_checks_see_the_stored_consents(spark, small_lake):
    pipeline.publish(spark, small_lake, "2024-06-01 00:00:00", "s", consents=all_agreed(spark, small_lake))
    assert pipeline.check(spark, small_lake).filter("not passed").count() == 0
    path = f"{small_lake}/consented_trips"
    spark.read.parquet(path).limit(1).withColumn("consent_source", F.lit("hearsay")).write.mode("append").partitionBy(
        "data_year", "data_month"
    ).parquet(path)
    bad = pipeline.check(spark, small_lake).filter("not passed").collect()
    assert [(r["column_name"], r["failures"]) for r in bad] == [("consent_source", 1)]


def test_class_sizes_cover_all_trips(spark, lake):
    root = lake[0]
    total = spark.read.parquet(f"{root}/class_sizes").agg(F.sum("k_anonymity")).first()[0]
    assert total == spark.read.parquet(f"{root}/identified_trips").count()


def test_reports_are_written(spark, lake):
    root = lake[0]
    assert spark.read.parquet(f"{root}/year_summary").count() == 8
    points = {r["pain_point"] for r in spark.read.parquet(f"{root}/report_payloads").collect()}
    assert len(points) == 9


def test_golden_load_log(spark):
    gps = "pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude"
    log = [
        ("2015-01", "gps", 18, "", "", "success", "2024-01-01 00:00"),
        ("2017-01", "zone", 17, "pu_location_id,do_location_id,improvement_surcharge", gps, "success", "2024-01-02 00:00"),
        ("2019-01", "zone_v2", 18, "congestion_surcharge", "", "success", "2024-01-03 00:00"),
        ("2022-01", "zone_v3", 19, "airport_fee", "", "failed", "2024-01-04 00:00"),
        ("2022-01", "zone_v3", 19, "airport_fee", "", "success", "2024-01-04 01:00"),
        ("2017-01", "zone", 17, "", "", "success", "2024-01-05 00:00"),
    ]
    names = ["partition_key", "schema_version", "column_count", "columns_added", "columns_removed", "status", "at"]
    lineage = spark.createDataFrame(log, names).selectExpr(
        "*", "cast(at as timestamp) as ingested_at", "1L as row_count", "'' as iceberg_snapshot_id"
    )
    history = evolution.schema_evolution(lineage)
    found = history.orderBy("ingested_at").collect()
    assert [r["change_type"] for r in found] == [
        "initial_load", "gps_to_zone_ids", "added_congestion_surcharge", "added_airport_fee", "no_change",
    ]
    assert [r["columns_delta"] for r in found] == [18, -1, 1, 1, -2]
    latest = {r["partition_key"]: r["is_schema_change"] for r in evolution.latest_evolution(history).collect()}
    assert latest == {"2015-01": False, "2017-01": False, "2019-01": True, "2022-01": True}


def test_narratives_are_appended_and_the_newest_is_read(spark, tmp_path):
    from tripguard.operators import narratives
    from tripguard.schemas import NARRATIVE_SCHEMA

    root = str(tmp_path)
    for day, text in ((1, '{"headline": "old"}'), (2, '{"headline": "new"}')):
        texts = spark.sql(
            f"select 'volume_trends' as pain_point, 2019L as data_year, '{text}' as narrative_json,"
            f" 'writer-1' as model, timestamp '2024-01-0{day}' as generated_at"
        )
        for field in NARRATIVE_SCHEMA.fields:
            if field.name not in texts.columns:
                texts = texts.withColumn(field.name, F.lit(None).cast(field.dataType))
        pipeline.append_narratives(spark, root, texts)
    stored = tables.read(spark, f"{root}/narratives", NARRATIVE_SCHEMA)
    assert stored.count() == 2
    (last,) = narratives.narrative_headlines(narratives.latest_narratives(stored)).collect()
    assert last["headline"] == "new"
