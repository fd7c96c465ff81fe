from __future__ import annotations

import json
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripguard.operators import evolution
from tripguard.schemas import LINEAGE_SCHEMA, UNIFIED_COLUMNS, UNIFIED_SCHEMA
from tripguard.sources import tables
from tripguard.sources.ingest import ingest, read_trips, verify
from tripguard.sources.manifest import build_manifest
from tripguard.sources.unify import normalize, resolve_columns
from tripguard.streaming.landing import watch

RUN = datetime(2024, 1, 1, tzinfo=timezone.utc)


def month_file(folder, key, rows=3, drop=(), **changes):
    """A month file as its era would have it."""
    year = int(key[:4])
    start = pd.Timestamp(f"{key}-01 08:00:00")
    data = {
        "VendorID": pa.array([1] * rows, pa.int64()),
        "tpep_pickup_datetime": [start + pd.Timedelta(minutes=i) for i in range(rows)],
        "tpep_dropoff_datetime": [start + pd.Timedelta(minutes=i + 10) for i in range(rows)],
        "passenger_count": pa.array([1] * rows, pa.int64()),
        "trip_distance": [1.5] * rows,
        "RatecodeID": pa.array([1] * rows, pa.int64()),
        "store_and_fwd_flag": ["N"] * rows,
        "payment_type": pa.array([1] * rows, pa.int64()),
        "fare_amount": [10.0] * rows,
        "extra": [0.5] * rows,
        "mta_tax": [0.5] * rows,
        "tip_amount": [1.0] * rows,
        "tolls_amount": [0.0] * rows,
        "total_amount": [12.0] * rows,
    }
    if year <= 2015:
        for name in ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"):
            data[name] = [-73.9] * rows
    else:
        data["PULocationID"] = pa.array([161] * rows, pa.int64())
        data["DOLocationID"] = pa.array([230] * rows, pa.int64())
        data["improvement_surcharge"] = [0.3] * rows
    if year >= 2019:
        data["congestion_surcharge"] = [2.5] * rows
    if year >= 2022:
        data["airport_fee"] = [1.25] * rows
    data.update(changes)
    for name in drop:
        data.pop(name)
    path = folder / f"yellow_tripdata_{key}.parquet"
    pq.write_table(pa.table(data), path)
    return str(path)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def log(spark, root):
    return tables.read(spark, f"{root}/lineage", LINEAGE_SCHEMA).orderBy("ingested_at").collect()


def test_manifest_of_targets(spark):
    rows = build_manifest(spark, ["2015-01", "2017-01", "2019-03", "2022-01"], "base/").collect()
    by_key = {r["partition_key"]: r for r in rows}
    assert {k: r["schema_version"] for k, r in by_key.items()} == {
        "2015-01": "gps", "2017-01": "zone", "2019-03": "zone_v2", "2022-01": "zone_v3",
    }
    assert by_key["2019-03"]["url"] == "base/yellow_tripdata_2019-03.parquet"
    assert {r["file_format"] for r in rows} == {"parquet"}


def test_four_eras_into_one_table(spark, landing, tmp_path):
    paths = [month_file(landing, k) for k in ("2015-01", "2017-01", "2019-01", "2022-01")]
    # Same era, other physical types: one scan could not read both.
    paths.append(month_file(
        landing, "2022-02", passenger_count=[1.0, None, 2.0], RatecodeID=["1", "bad", None],
        airport_fee=pa.array([None] * 3, pa.int32()), payment_type=pa.array([1, 2, 3], pa.int32()),
    ))
    root = str(tmp_path / "lake")
    ingest(spark, paths, root, RUN, "run-1")
    trips = read_trips(spark, root)
    assert trips.columns == UNIFIED_COLUMNS
    assert dict(trips.dtypes) == {f.name: f.dataType.simpleString() for f in UNIFIED_SCHEMA.fields}
    assert trips.count() == 15
    months = {(r["data_year"], r["data_month"], r["schema_version"]) for r in trips.collect()}
    assert (2022, 2, "zone_v3") in months and len(months) == 5
    late = trips.filter("data_year = 2022 and data_month = 2").orderBy("tpep_pickup_datetime").collect()
    assert [r["rate_code_id"] for r in late] == [1.0, None, None]
    assert [r["passenger_count"] for r in late] == [1.0, None, 2.0]
    assert late[0]["airport_fee"] is None and late[0]["pu_location_id"] == 161
    gps = trips.filter("data_year = 2015").first()
    assert gps["pickup_longitude"] == -73.9 and gps["pu_location_id"] is None

    rows = log(spark, root)
    assert [(r["partition_key"], r["row_count"], r["status"]) for r in rows] == [
        (k, 3, "success") for k in ("2015-01", "2017-01", "2019-01", "2022-01", "2022-02")
    ]
    assert rows[1]["columns_added"] == "do_location_id,improvement_surcharge,pu_location_id"
    assert rows[1]["columns_removed"] == (
        "dropoff_latitude,dropoff_longitude,pickup_latitude,pickup_longitude"
    )
    assert [r["columns_added"] for r in rows[2:]] == ["congestion_surcharge", "airport_fee", ""]
    assert [r["column_count"] for r in rows] == [18, 17, 18, 19, 19]
    assert json.loads(rows[0]["transformation_steps"])[0] == "read_parquet"
    changes = evolution.schema_evolution(tables.read(spark, f"{root}/lineage", LINEAGE_SCHEMA))
    assert [r["change_type"] for r in changes.orderBy("ingested_at").collect()] == [
        "initial_load", "gps_to_zone_ids", "added_congestion_surcharge", "added_airport_fee", "no_change",
    ]
    assert verify(spark, root).filter("not is_match").count() == 0


def test_second_run_replaces_its_months_only(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    both = [month_file(landing, "2019-01"), month_file(landing, "2019-02")]
    ingest(spark, both, root, RUN)
    ingest(spark, both, root, RUN)
    assert read_trips(spark, root).count() == 6
    ingest(spark, [month_file(landing, "2019-02", rows=5)], root, datetime(2024, 1, 2, tzinfo=timezone.utc))
    counts = {(r["data_month"], r["row_count"], r["is_match"]) for r in verify(spark, root).collect()}
    assert counts == {(1, 3, True), (2, 5, True)}
    assert log(spark, root)[-1]["columns_added"] == ""


def test_unified_columns_only_ever_change_once(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    for i, key in enumerate(("2015-01", "2017-01")):
        ingest(spark, [month_file(landing, key)], root, datetime(2024, 1, 1 + i, tzinfo=timezone.utc), diff_on="unified")
    rows = log(spark, root)
    assert len(rows[0]["columns_added"].split(",")) == 28
    assert rows[1]["columns_added"] == rows[1]["columns_removed"] == ""


def test_missing_required_column_is_logged_and_raised(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="extra"):
        ingest(spark, [month_file(landing, "2019-01", drop=["extra"])], root, RUN)
    (row,) = log(spark, root)
    assert row["status"] == "failed" and "extra" in row["error_message"] and row["row_count"] == 0
    assert evolution.schema_evolution(tables.read(spark, f"{root}/lineage", LINEAGE_SCHEMA)).count() == 0


def test_both_spellings_of_a_column_are_refused():
    with pytest.raises(ValueError, match="both mean"):
        resolve_columns(["VendorID", "vendor_id"])


def test_bad_values_become_null(spark):
    texts = {c: "string" for c in UNIFIED_COLUMNS[:23]}
    row = spark.range(1).selectExpr(
        *[f"'oops' as {c}" for c in texts], "'yellow_tripdata_2019-01.parquet' as source_file"
    )
    got = normalize(row, "2024-01-01").first()
    assert got["vendor_id"] == "oops" and got["store_and_fwd_flag"] == "oops"
    assert all(got[c] is None for c in texts if c not in ("vendor_id", "store_and_fwd_flag"))


def test_catalog_table_over_the_path(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    ingest(spark, [month_file(landing, "2019-01")], root, RUN)
    for _ in range(2):
        tables.ensure_trip_table(spark, "trips_by_name", f"{root}/trips")
    tables.refresh_trip_table(spark, "trips_by_name")
    assert spark.table("trips_by_name").count() == 3
    spark.sql("DROP TABLE trips_by_name")


def test_add_columns_once(spark, tmp_path):
    spark.sql(f"CREATE TABLE texts (pain_point string) USING parquet LOCATION '{tmp_path}/texts'")
    fields = spark.range(0).select(F.lit(1).cast("bigint").alias("data_month")).schema
    assert tables.add_columns(spark, "texts", fields) == ["data_month"]
    assert tables.add_columns(spark, "texts", fields) == []
    spark.sql("DROP TABLE texts")


def test_jsonl_has_sorted_keys(spark, tmp_path):
    tables.write_jsonl(spark.sql("select 'x' as b, cast(null as int) as a"), f"{tmp_path}/out")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"a":null,"b":"x"}']


def test_landing_folder_is_loaded_incrementally(spark, landing, tmp_path):
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    loaded = []
    month_file(landing, "2017-01")
    watch(spark, str(landing), root, state, loaded.append).awaitTermination(120)
    month_file(landing, "2019-01")
    watch(spark, str(landing), root, state, loaded.append).awaitTermination(120)
    assert loaded == [["2017-01"], ["2019-01"]]
    assert read_trips(spark, root).count() == 6


def empty_month(folder, key):
    path = month_file(folder, key)
    pq.write_table(pq.read_table(path).slice(0, 0), path)
    return path


def at(day):
    return datetime(2024, 1, day, tzinfo=timezone.utc)


def test_an_empty_reload_clears_the_month(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    paths = [month_file(landing, "2019-01"), month_file(landing, "2019-02", rows=4)]
    ingest(spark, paths, root, RUN)
    ingest(spark, [empty_month(landing, "2019-01")], root, at(2))
    months = read_trips(spark, root).groupBy("data_month").count().collect()
    assert [tuple(r) for r in months] == [(2, 4)]
    assert verify(spark, root).filter("not is_match").count() == 0
    assert log(spark, root)[-1]["row_count"] == 0


def test_one_bad_file_fails_alone(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    good = month_file(landing, "2019-02")
    bad = month_file(landing, "2019-03", drop=["extra"])
    torn = landing / "yellow_tripdata_2019-04.parquet"
    torn.write_bytes(b"PAR1 no footer")
    with pytest.raises(ValueError, match="2 of 3 files were not loaded"):
        ingest(spark, [good, bad, str(torn)], root, RUN, "run-1")
    rows = {r["partition_key"]: r for r in log(spark, root)}
    assert {k: r["status"] for k, r in rows.items()} == {"2019-02": "success", "2019-03": "failed", "2019-04": "failed"}
    assert "extra" in rows["2019-03"]["error_message"] and rows["2019-02"]["error_message"] == ""
    assert read_trips(spark, root).count() == 3
    assert verify(spark, root).filter("not is_match").count() == 0


def test_two_files_of_a_month_fail_and_others_load(spark, landing, tmp_path):
    root, other = str(tmp_path / "lake"), tmp_path / "other"
    other.mkdir()
    paths = [month_file(landing, "2019-01"), month_file(other, "2019-01"), month_file(landing, "2019-02")]
    ingest(spark, paths, root, RUN, strict=False)
    assert sorted((r["partition_key"], r["status"]) for r in log(spark, root)) == [
        ("2019-01", "failed"), ("2019-01", "failed"), ("2019-02", "success"),
    ]


def test_a_run_repeated_logs_nothing_twice(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    ingest(spark, [month_file(landing, "2017-01")], root, RUN, "run-0")
    paths = [month_file(landing, "2019-01"), month_file(landing, "2019-02", drop=["extra"])]
    for day in (2, 3):
        ingest(spark, paths, root, at(day), "run-1", strict=False)
    rows = log(spark, root)
    assert [(r["run_id"], r["partition_key"], r["status"]) for r in rows if r["run_id"] == "run-1"] == [
        ("run-1", "2019-01", "success"), ("run-1", "2019-02", "failed"),
    ]
    latest = evolution.latest_evolution(evolution.schema_evolution(tables.read(spark, f"{root}/lineage", LINEAGE_SCHEMA)))
    assert {r["partition_key"]: r["is_schema_change"] for r in latest.collect()}["2019-01"]
    assert verify(spark, root).filter("not is_match").count() == 0


def test_many_files_add_no_expression_per_row(spark, landing, tmp_path):
    from tripguard.sources.unify import file_schemas, read_months

    paths = [month_file(landing, f"{y}-{m:02d}") for y in (2019, 2020) for m in range(1, 13)]
    plans = []
    for some in (paths[:2], paths):
        schemas, bad = file_schemas(spark, some)
        assert not bad
        plans.append(read_months(spark, schemas, "2024-01-01")._jdf.queryExecution().optimizedPlan().toString())
    assert plans[0].count("\n") == plans[1].count("\n")
    root = str(tmp_path / "lake")
    ingest(spark, paths, root, RUN)
    assert {r["row_count"] for r in log(spark, root)} == {3}


def test_the_newest_file_of_a_month_counts_in_any_batch(spark, landing, tmp_path):
    import os
    import time

    from tripguard.streaming.landing import load_batch

    folders = [landing / n for n in ("a", "b", "c")]
    files = []
    for rows, folder in zip((3, 7, 5), folders):
        folder.mkdir()
        files.append(month_file(folder, "2019-01", rows=rows))
    now = time.time()
    for path, age in zip(files, (300, 100, 200)):
        os.utime(path, (now - age, now - age))
    found = lambda *paths: spark.read.format("binaryFile").load(list(paths)).select("path", "modificationTime")
    for name, batches in {"one": [files], "three": [files[1:2], files[:1], files[2:]]}.items():
        root = str(tmp_path / name)
        for i, batch in enumerate(batches):
            for _ in range(2):  # each batch runs again, as after a failure
                load_batch(root)(found(*batch), i)
        assert read_trips(spark, root).count() == 7
        rows = log(spark, root)
        assert sorted((r["status"], r["row_count"]) for r in rows) == [("failed", 0), ("failed", 0), ("success", 7)]
        assert all("newer file" in r["error_message"] for r in rows if r["status"] == "failed")
        assert verify(spark, root).filter("not is_match").count() == 0


def test_a_bad_file_does_not_stop_the_stream(spark, landing, tmp_path):
    root, state, loaded = str(tmp_path / "lake"), str(tmp_path / "state"), []
    month_file(landing, "2019-01", drop=["extra"])
    month_file(landing, "2019-02")
    (landing / "notes.parquet").write_bytes(b"no month")
    watch(spark, str(landing), root, state, loaded.append).awaitTermination(120)
    assert loaded == [["2019-02"]]
    assert sorted(r["status"] for r in log(spark, root)) == ["failed", "failed", "success"]
