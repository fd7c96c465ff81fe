"""Hot-key ranking and bucketed lag against the plain window functions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripguard.operators import ordered
from tripguard.operators.ordered import lag_in_order, row_number_by
from tripguard.plans import driver_tables


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one key, many of them full copies, and nulls."""
    random.seed(7)
    data = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else random.choice([f"k{j}" for j in range(900)] + [None])
        data.append((key, random.choice([None, 1, 2, 3]), random.choice([None, "a", "b"]), i % 5))
    return spark.createDataFrame(data, "k string, a int, b string, other int").repartition(8)


def ranked(df):
    return sorted(map(repr, (tuple(r) for r in df.select("k", "a", "b", "n").collect())))


def plain(df):
    order = [F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()]
    return df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)))


def test_hot_keys_rank_as_the_window_does(spark, rows, monkeypatch):
    monkeypatch.setattr(ordered, "COPIES_PER_CHUNK", 7)
    used = []
    spread = ordered._row_number_spread
    monkeypatch.setattr(ordered, "_row_number_spread", lambda *a: used.append(1) or spread(*a))
    out = row_number_by(rows, ["k"], ["a", "b"], "n", hot_rows=500)
    assert ranked(out) == ranked(plain(rows))
    assert used
    assert sorted(map(repr, out.select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))


def test_all_rows_hot(spark, rows):
    out = row_number_by(rows, ["k"], ["a", "b"], "n", hot_rows=1)
    assert ranked(out) == ranked(plain(rows))


def test_nothing_hot(spark, rows):
    out = row_number_by(rows, ["k"], ["a", "b"], "n")
    assert ranked(out) == ranked(plain(rows))


def test_rows_keep_their_number_in_any_plan(spark, rows):
    """Ties in the order go by all other columns, so number and whole row belong together."""
    whole = lambda df: sorted(map(repr, (tuple(r) for r in df.select("k", "a", "b", "other", "n").collect())))
    want = whole(row_number_by(rows, ["k"], ["a"], "n"))
    for seed, hot in ((1, 10**6), (2, 500), (3, 1)):
        shuffled = rows.orderBy(F.rand(seed)).repartition(5)
        assert whole(row_number_by(shuffled, ["k"], ["a"], "n", hot_rows=hot)) == want


def test_rows_counted_by_some_of_the_keys(spark, rows, monkeypatch):
    """A key with few rows may then count as hot; a hot one is never missed."""
    used = []
    spread = ordered._row_number_spread
    monkeypatch.setattr(ordered, "_row_number_spread", lambda *a: used.append(a[0].count()) or spread(*a))
    out = row_number_by(rows, ["k", "a"], ["b"], "n", hot_rows=500, counted=("k",))
    keys = Window.partitionBy("k", "a").orderBy(F.col("b").asc_nulls_first())
    assert ranked(out) == ranked(rows.withColumn("n", F.row_number().over(keys)))
    assert used and used[0] >= rows.filter("k = 'hot'").count()


def test_lag_across_buckets(spark):
    random.seed(3)
    data = [(i, i // 7 * (i % 2 + 1) // 3, random.choice([None, "x", "y"])) for i in range(200)]
    df = spark.createDataFrame([(i, i // 9, v) for i, _, v in data], "t int, bucket int, v string")
    got = lag_in_order(df, ["v"], ["t"], "bucket").orderBy("t").collect()
    want = df.withColumn("p", F.lag("v").over(Window.orderBy("t"))).orderBy("t").collect()
    assert [(r["t"], r["prev_v"]) for r in got] == [(r["t"], r["p"]) for r in want]


def test_small_partitions_are_not_merged_before_rows_are_ranked(spark):
    """What follows the numbers is costly, and cores would idle."""
    rows = spark.range(64).selectExpr("id % 40 as k", "id as v")
    ranked = row_number_by(rows, ["k"], ["v"], "n")
    assert ranked.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_count_of_hot_keys_sends_a_bounded_number_of_buckets():
    assert ordered.KEY_BUCKETS <= 1 << 16


def test_events_of_one_row_group_are_several_tasks(spark):
    assert driver_tables.event_trips(spark, "/root/testdata/sf0.01").rdd.getNumPartitions() > 1
