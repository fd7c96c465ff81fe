from __future__ import annotations

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from tripguard.functions import (
    canon_amount,
    drawn,
    hour_bucket,
    int64_sql,
    keyed_pseudonym,
    rnd,
    sorted_json,
    unit_draw,
)


def one(spark, column, row="select 'trip-1' as id"):
    return spark.sql(row).select(column).first()[0]


@pytest.mark.parametrize("salt", ["demo-rotation-2026", "s", "x" * 64, "long" * 40, "ünï"])
def test_pseudonym_is_hmac(spark, salt):
    expected = hmac.new(salt.encode(), b"trip-1", hashlib.sha256).hexdigest()[:24]
    assert one(spark, keyed_pseudonym(F.col("id"), salt)) == expected


def test_pseudonym_golden(spark):
    assert one(spark, keyed_pseudonym(F.col("id"), "demo-rotation-2026")) == "d1612ba6af05e29d8d8b482e"


def test_draw_golden(spark):
    assert one(spark, unit_draw("ml_training", F.col("id"))) == 0.3124601892923145


@pytest.mark.parametrize(
    "value, digits, expected",
    [("1.005D", 2, 1.01), ("-1.005D", 2, -1.01), ("2.5D", 0, 3.0), ("1e20D", 2, 1e20),
     ("cast(null as double)", 2, None)],
)
def test_rounding(spark, value, digits, expected):
    assert one(spark, rnd(value, digits)) == expected


def test_rounding_keeps_infinity_and_nan(spark):
    assert one(spark, rnd("double('infinity')", 2)) == float("inf")
    assert one(spark, rnd("double('nan')", 2)) != one(spark, rnd("double('nan')", 2))


@pytest.mark.parametrize("value, expected", [("2.5D", 3), ("-2.5D", -3), ("1e30D", None), ("double('nan')", None)])
def test_whole_numbers(spark, value, expected):
    assert one(spark, F.expr(int64_sql(value))) == expected


def test_amount_text(spark):
    assert one(spark, canon_amount(F.lit(12.5))) == "12.5000"
    assert one(spark, canon_amount(F.lit(-0.0))) == "0.0000"
    assert one(spark, canon_amount(F.lit(1e15))) == "1.0E15"


def test_hour_bucket(spark):
    stamp = F.lit("2020-04-01T10:15:30").cast("timestamp")
    assert one(spark, hour_bucket(stamp)) == "2020-04-01T10:00:00"
    with pytest.raises(ValueError, match="bucketed by hour"):
        hour_bucket(stamp, "day")


def test_json_keys_are_sorted(spark):
    row = "select 2 as b, cast(null as int) as c, 1 as a"
    assert one(spark, sorted_json("b", "c", "a"), row) == '{"a":1,"b":2,"c":null}'


def test_draws_by_digits_equal_draws_by_number(spark):
    ids = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("i"))
    ids = ids.union(spark.createDataFrame([(None,)], "i string"))
    for rate in (-0.1, 0.0, 1e-9, 0.5, 0.8, 0.9, 1 - 2.0**-40, 1.0):
        number = unit_draw("ml_training", F.col("i")) <= F.lit(rate)
        assert ids.filter(~drawn("ml_training", F.col("i"), rate).eqNullSafe(number)).count() == 0
    # The last digits that are drawn, to either side of a draw.
    draw = int(hashlib.sha256(b"ml_training:x").hexdigest()[:8], 16)
    for rate, want in ((draw / 4294967295.0, True), ((draw - 1) / 4294967295.0, False)):
        assert one(spark, drawn("ml_training", F.lit("x"), rate)) is want
