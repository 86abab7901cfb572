from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from convoy.functions.numeric import (
    exact_sum,
    fixed_text,
    guarded_ratio,
    nan_to_null,
    parsed_or_zero,
    round_ieee,
    seconds_between,
    to_hours,
    trimmed_text,
)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, digits, expected",
    [
        (1.005, 2, 1.0),  # the binary value lies below the tie
        (0.285, 2, 0.28),
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (0.25, 1, 0.3),
        (-0.25, 1, -0.3),
        (0.0, 2, 0.0),
        (None, 2, None),
    ],
)
def test_round_ieee(spark, value, digits, expected):
    assert one(spark, round_ieee(F.lit(value).cast("double"), digits)) == expected


@pytest.mark.parametrize("value", [1e18, -1e17, 4.6e15, 1e303, math.inf, -math.inf, 2.0**52])
def test_large_values_have_no_fraction_to_round(spark, value):
    assert one(spark, round_ieee(F.lit(value), 2)) == value


def test_any_number_has_a_text(spark):
    assert one(spark, fixed_text(F.lit(1e17), 1)) == "100000000000000000.0"
    assert one(spark, fixed_text(F.lit(1e300), 2)) == "1.0E300"
    assert one(spark, fixed_text(F.lit(math.inf), 2)) == "Infinity"
    assert one(spark, fixed_text(F.lit(None).cast("double"), 2)) == "None"
    assert one(spark, trimmed_text(F.lit(1e300))) == "1.0E300"


def test_sums_are_exact_or_else_doubles(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(
            exact_sum(F.col("v"))
        ).first()[0]

    assert total(0.1, 0.2, 0.3) == 0.6
    assert total(1e300, 1.0) == 1e300
    assert total(None, 2.5) == 2.5 and total(None) is None


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ("2026-01-01T00:00:00.9+00:00", "2026-01-01T00:00:02.1+00:00", 1),
        ("2026-01-01T00:00:02.1+00:00", "2026-01-01T00:00:00.9+00:00", -1),
        ("2026-01-01T00:00:00+02:00", "2026-01-01T00:00:00+00:00", 7200),
        ("2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z", 86400),
        ("2026-01-01T00:00:00Z", None, None),
    ],
)
def test_seconds_between(spark, start, end, expected):
    assert one(spark, seconds_between(F.lit(start), F.lit(end))) == expected


def test_elapsed_time_does_not_follow_summer_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        night = F.lit("2026-03-08T05:00:00+00:00"), F.lit("2026-03-08T09:00:00+00:00")
        assert one(spark, seconds_between(*night)) == 4 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_malformed_time_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, seconds_between(F.lit("half past nine"), F.lit("2026-01-01T00:00:00Z")))


@pytest.mark.parametrize("seconds, expected", [(179, 0.0), (180, 0.1), (-180, -0.1), (5400, 1.5)])
def test_quantized_hours(spark, seconds, expected):
    assert float(one(spark, to_hours(F.lit(seconds), scale=1))) == expected


def test_exact_hours(spark):
    assert one(spark, to_hours(F.lit(1))) == 1 / 3600


@pytest.mark.parametrize("bottom, expected", [(2.0, 5.0), (0.0, None), (-1.0, None), (None, None)])
def test_guarded_ratio_never_divides_by_zero(spark, bottom, expected):
    bottom = F.lit(bottom).cast("double")
    assert one(spark, guarded_ratio(F.lit(10.0), bottom)) == expected


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1e7, 1, "10000000.0"), (1.5, 2, "1.50"), (None, 2, "None"), (-0.04, 1, "0.0")],
)
def test_fixed_text(spark, value, digits, expected):
    assert one(spark, fixed_text(F.lit(value).cast("double"), digits)) == expected


@pytest.mark.parametrize(
    "value, expected", [(12.5, "12.5"), (100.0, "100"), (0.0, "0"), (10.25, "10.25"), (20.0, "20")]
)
def test_trimmed_text(spark, value, expected):
    assert one(spark, trimmed_text(F.lit(value))) == expected


@pytest.mark.parametrize(
    "value, expected", [("1.5", 1.5), ("", 0.0), ("abc", 0.0), ("NaN", 0.0), (None, 0.0)]
)
def test_parsed_or_zero(spark, value, expected):
    assert one(spark, parsed_or_zero(F.lit(value).cast("string"))) == expected


def test_nan_to_null(spark):
    df = spark.createDataFrame([(math.nan, "NaN"), (1.0, "x")], "a double, b string")
    assert [tuple(r) for r in nan_to_null(df).collect()] == [(None, "NaN"), (1.0, "x")]
