from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from convoy.operators.anomalies import (
    anomalies_all,
    anomalies_latest,
    anomaly_feed,
    detection_summary,
    severity_feed,
)
from convoy.operators.fuel import fuel_anomalies
from convoy.operators.insights import kpi_tiles, percent_of_max, stringify, text_lines
from convoy.operators.shifts import shift_anomalies
from convoy.operators.snapshots import as_of_snapshot, latest_snapshot
from convoy.plans.detect import detection_feed
from tests.helpers import ENTRIES, PROFILES, RECORDS, reports, rows, shift

HITS = (
    "unit_no string, report_date string, odometer double, fuel_litres double, "
    "distance_km double, km_per_litre double, anomaly string"
)
SHIFT_HITS = (
    "driver string, unit_no string, hours double, hourly_rate double, "
    "odometer_in double, odometer_out double, anomaly string"
)


def test_record_text_and_duplicates(spark):
    fuel = spark.createDataFrame(
        [("U1", "2026-01-01", 1.0, 0.0, None, None, "zero_or_missing_litres")] * 2, HITS
    )
    shifts = spark.createDataFrame(
        [(None, None, 17.0, None, None, None, "excessive_shift")], SHIFT_HITS
    )
    assert rows(anomaly_feed(fuel, shifts)) == [
        ("fuel", "U1", "zero_or_missing_litres", "km/L=None, distance=None, litres=0.00"),
        ("fuel", "U1", "zero_or_missing_litres", "km/L=None, distance=None, litres=0.00"),
        ("shift", None, "excessive_shift", "hours=17.0, rate=None, unit=None"),
    ]


def test_demo_fleet(spark):
    """Thirteen drivers, three shifts over sixteen hours, four without a rate."""
    people = [(f"D{i}", f"Driver {i}", 0.0 if i < 4 else 25.0) for i in range(13)]
    made = [shift(8 * 3600, f"D{i}") for i in range(13)]
    made += [shift(17 * 3600, f"D{i}") for i in (5, 6, 7)]
    feed = detection_feed(
        reports(spark, (0.0, 50.0), (200.0, 50.0)),
        spark.createDataFrame(made, ENTRIES),
        spark.createDataFrame(people, PROFILES),
    )
    found = dict(feed.groupBy("anomaly_type").count().collect())
    assert found == {"excessive_shift": 3, "missing_hourly_rate": 4}
    assert rows(detection_summary(feed, "2026-01-06")) == [("2026-01-06", 7, 0, 7)]


def test_feed_counts_add_up(spark):
    fuel = fuel_anomalies(reports(spark, (0.0, 50.0), (10.0, 50.0), (5.0, 50.0), (9.0, 0.0)))
    entries = spark.createDataFrame([shift(0), shift(17 * 3600)], ENTRIES)
    shifts = shift_anomalies(entries, spark.createDataFrame([("D1", "Ann", 1.0)], PROFILES))
    feed = anomaly_feed(fuel, shifts)
    assert feed.count() == fuel.count() + shifts.count() == 5


def test_severity(spark):
    kinds = [
        "missing_hourly_rate",
        "odometer_backwards",
        "implausible_low_economy",
        "implausible_high_economy",
        "zero_or_missing_litres",
        "excessive_shift",
        "nonpositive_duration",
        None,
    ]
    df = spark.createDataFrame([("c", "e", k, "d") for k in kinds], RECORDS)
    assert [r["severity"] for r in severity_feed(df).collect()] == [
        "critical",
        "serious",
        "serious",
        "serious",
        "serious",
        "warning",
        "info",
        "info",
    ]
    assert severity_feed(df).first()["type"] == "missing hourly rate"


def stored(spark):
    made = [
        ("shift", "B", "t", "2", "2026-01-01"),
        ("shift", "A", "t", "1", "2026-01-02"),
        ("fuel", None, "t", "3", "2026-01-02"),
        ("fuel", "Z", "t", "4", "2026-01-02"),
    ]
    return spark.createDataFrame(made, RECORDS + ", detect_date string")


def test_stored_views(spark):
    columns = ["category", "entity", "detail"]
    assert rows(anomalies_all(stored(spark)), *columns) == [
        ("fuel", "Z", "4"),
        ("fuel", None, "3"),
        ("shift", "A", "1"),
        ("shift", "B", "2"),
    ]
    assert rows(anomalies_latest(stored(spark)), *columns) == [
        ("fuel", "Z", "4"),
        ("fuel", None, "3"),
        ("shift", "A", "1"),
    ]
    assert anomalies_latest(stored(spark), limit=1).count() == 1


def test_sorting_spreads_equal_keys(spark):
    same = spark.range(40000).selectExpr(
        "'fuel' as category",
        "'U1' as entity",
        "'t' as anomaly_type",
        "cast(id as string) as detail",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = anomalies_all(same).select(F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(set(tasks)) > 1


@pytest.mark.parametrize("day, expected", [("2026-01-01", 1), ("2026-01-05", 3), ("2025-12-31", 0)])
def test_as_of(spark, day, expected):
    assert as_of_snapshot(stored(spark), day, "detect_date").count() == expected


def test_latest_snapshot(spark):
    assert latest_snapshot(stored(spark), "detect_date").count() == 3


def test_percent_of_max(spark):
    made = [("a", 12.5), ("b", 50.0), ("c", None), ("d", 0.0)]
    df = spark.createDataFrame(made, "n string, v double")
    assert rows(percent_of_max(df, "n", "v", "h")) == [
        ("a", 25.0, "12.5h"),
        ("b", 100.0, "50h"),
        ("c", 0.0, "—"),
        ("d", 0.0, "0h"),
    ]
    assert rows(percent_of_max(df.where("n = 'c'"), "n", "v")) == [("c", 0.0, "—")]
    text = df.select("n", df.v.cast("string"))
    assert rows(percent_of_max(text, "n", "v", "h")) == rows(percent_of_max(df, "n", "v", "h"))


def test_tiles_sum_displayed_hours(spark):
    hours = spark.createDataFrame([(0.1,), (0.2,), (None,)], "hours double")
    one = spark.range(1)
    assert rows(kpi_tiles(hours, one, spark.range(7))) == [(3, 1, 0.3, 7)]
    assert rows(kpi_tiles(hours.limit(0), one.limit(0), one.limit(0))) == [(0, 0, 0.0, 0)]


def test_stringify_keeps_missing_apart_from_zero(spark):
    df = spark.createDataFrame([(1, None, 0.0)], "a int, b string, `c.d` double")
    assert rows(stringify(df)) == [("1", "", "0.0")]
    assert rows(text_lines(df)) == [("1 |  | 0.0",)]
    assert text_lines(spark.range(80)).count() == 80
    assert text_lines(spark.range(80), limit=50).count() == 50


def test_records_have_no_day_in_their_body(spark):
    feed = anomaly_feed(
        fuel_anomalies(reports(spark, (0.0, 0.0))),
        spark.createDataFrame([], SHIFT_HITS),
    )
    body = json.loads(feed.toJSON().first())
    assert list(body) == ["category", "entity", "anomaly_type", "detail"]
