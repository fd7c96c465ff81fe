"""Few ids in a large table, and two releases held against each other."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripguard.operators import marts, requests
from tripguard.sources import tables

FILES, ROWS = 200, 1000


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """200 files of random ids, over two months."""
    path = str(tmp_path_factory.mktemp("large"))
    rows = spark.range(0, FILES * ROWS, 1, FILES).selectExpr(
        "sha2(cast(id as string), 256) as trip_id",
        "id as n",
        f"2021 + cast(id div {FILES * ROWS} as int) as data_year",
        f"1 + cast(id div {FILES * ROWS // 2} as int) as data_month",
    )
    tables.overwrite_months(rows, path, lookup="trip_id", group_rows=50)
    return path


def test_bloom_filters_are_small(large):
    sizes = [f.stat().st_size for f in Path(large).rglob("*.parquet")]
    # An id is 64 characters.
    assert sum(sizes) < 2 * 64 * FILES * ROWS


def read_by_scans(df):
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def asked_for(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n long").select(
        F.when(F.col("n") >= 0, F.sha2(F.col("n").cast("string"), 256)).alias("trip_id")
    )


def test_a_hundred_ids_read_few_rows(spark, large):
    trips = spark.read.parquet(large)
    numbers = random.Random(3).sample(range(FILES * ROWS), 100)
    found = requests.trips_of(trips, asked_for(spark, numbers))
    assert sorted(r["n"] for r in found.collect()) == sorted(numbers)
    assert read_by_scans(found) < 0.05 * FILES * ROWS


def test_ids_that_are_nowhere_are_skipped_by_bloom_filters(spark, large):
    trips = spark.read.parquet(large)
    found = requests.trips_of(trips, asked_for(spark, range(FILES * ROWS, FILES * ROWS + 5)))
    assert found.collect() == []
    # Each lies within the range of every row group; what is read are false positives.
    assert read_by_scans(found) < 0.01 * FILES * ROWS


@pytest.mark.parametrize("numbers", [[], [-1], [5], [5, 5, -1, 7], list(range(40))])
def test_listed_and_joined_ids_give_the_same_rows(spark, large, numbers):
    trips = spark.read.parquet(large)
    asked = asked_for(spark, numbers)
    want = sorted({n for n in numbers if n >= 0})
    for listed in (1, 200):
        assert sorted(r["n"] for r in requests.trips_of(trips, asked, listed).collect()) == want


def released(spark, rows):
    names = "trip_pseudonym string, release int, " + ", ".join(f"{c} long" for c in marts.SHOWN)
    return spark.createDataFrame(rows, names)


def test_two_releases_leave_fewer_candidates(spark):
    place, other = (1, None, 8, 2), (9, None, 8, 2)
    old = [f"old-{i}" for i in range(6)]
    rows = [(x, 1, *place) for x in old] + [(x, 2, *place) for x in [*old, "new"]]
    # Shown at another place the second time, by one of five; and in the first release alone.
    rows += [(f"m{i}", 1, *other) for i in range(5)] + [("m0", 2, *place)]
    got = {
        (r["in_first"], r["in_second"], r["first_pickup_zone_id"], r["second_pickup_zone_id"]):
        (r["k_first"], r["k_second"], r["k_left"], r["is_exposed"])
        for r in marts.candidates_left(released(spark, rows)).collect()
    }
    assert got == {
        (True, True, 1, 1): (6, 8, 6, False),
        (False, True, None, 1): (None, 8, 1, True),
        (True, True, 9, 1): (5, 8, 1, True),
        (True, False, 9, None): (5, None, 4, True),
    }


def test_candidates_equal_a_count_of_pairs(spark):
    draw = random.Random(11)
    rows, seen = [], {}
    for n in range(400):
        for release in (1, 2):
            if draw.random() < 0.7:
                shown = (draw.choice([None, 1, 2]), draw.choice([None, 3]), draw.randrange(2), 1)
                rows.append((f"p{n}", release, *shown))
                seen[n, release] = shown
    # Repeated rows, and rows that nothing links.
    rows += rows[:50] + [(None, 1, 1, 3, 0, 1)] * 3
    ids = {n for n, _ in seen}
    pairs = Counter((seen.get((n, 1)), seen.get((n, 2))) for n in ids)
    sizes = [Counter(seen[n, release] for n in ids if (n, release) in seen) for release in (1, 2)]
    got = {}
    for r in marts.candidates_left(released(spark, rows)).collect():
        first = tuple(r[f"first_{c}"] for c in marts.SHOWN) if r["in_first"] else None
        second = tuple(r[f"second_{c}"] for c in marts.SHOWN) if r["in_second"] else None
        got[first, second] = r["k_first"], r["k_second"], r["k_left"]
    assert got == {(a, b): (sizes[0].get(a), sizes[1].get(b), n) for (a, b), n in pairs.items()}
    assert marts.candidates_left(released(spark, [])).collect() == []
