from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from convoy.operators.fuel import fuel_anomalies, fuel_deltas, fuel_economy, fuel_efficiency
from tests.helpers import REPORTS, reports, rows


@pytest.mark.parametrize(
    "km, litres, label",
    [
        (99.4, 100.0, "implausible_low_economy"),  # 0.994 shows as 0.99
        (99.6, 100.0, None),  # 0.996 shows as 1.00
        (100.0, 100.0, None),
        (600.0, 100.0, None),
        (600.4, 100.0, None),  # 6.004 shows as 6.00
        (600.6, 100.0, "implausible_high_economy"),
        (300.0, 0.0, "zero_or_missing_litres"),
        (300.0, -1.0, "zero_or_missing_litres"),
        (-1.0, 0.0, "zero_or_missing_litres"),  # the first rule wins
        (300.0, None, None),
        (-1.0, None, "odometer_backwards"),
        (-1.0, 100.0, "odometer_backwards"),
        (0.0, 100.0, "implausible_low_economy"),
    ],
)
def test_rule_boundaries(spark, km, litres, label):
    hits = fuel_anomalies(reports(spark, (1000.0, 50.0), (1000.0 + km, litres)))
    assert [r["anomaly"] for r in hits.collect()] == ([label] if label else [])


def test_thresholds_are_arguments(spark):
    fills = reports(spark, (0.0, 50.0), (300.0, 100.0))
    assert fuel_anomalies(fills).isEmpty()
    assert fuel_anomalies(fills, low=3.5).first()["anomaly"] == "implausible_low_economy"
    assert fuel_anomalies(fills, high=2.5).first()["anomaly"] == "implausible_high_economy"


def test_first_fill_has_no_distance(spark):
    found = fuel_efficiency(reports(spark, (500.0, 50.0))).first()
    assert found["distance_km"] is None and found["km_per_litre"] is None
    assert fuel_anomalies(reports(spark, (500.0, 50.0))).isEmpty()
    assert not fuel_anomalies(reports(spark, (500.0, 0.0))).isEmpty()


def test_missing_odometer_blanks_its_distance_and_the_next(spark):
    fills = reports(spark, (100.0, 10.0), (None, 10.0), (140.0, 10.0), (170.0, 10.0))
    found = rows(fuel_efficiency(fills), "distance_km", "km_per_litre")
    assert found == [(None, None), (None, None), (None, None), (30.0, 3.0)]


def test_order_within_a_day_and_missing_dates_last(spark):
    fills = spark.createDataFrame(
        [
            (1, "U1", None, "t1", 400.0, 10.0),
            (2, "U1", "2026-01-01", "t2", 130.0, 10.0),
            (3, "U1", "2026-01-01", "t1", 100.0, 10.0),
            (5, "U1", "2026-01-01", None, 200.0, 10.0),
            (4, "U1", "2026-01-01", "t2", 150.0, 10.0),
        ],
        REPORTS,
    )
    found = rows(fuel_efficiency(fills), "odometer", "distance_km")
    assert found == [(100.0, None), (130.0, 30.0), (150.0, 20.0), (200.0, 50.0), (400.0, 200.0)]


def test_economy_averages_unrounded_ratios_and_counts_every_fill(spark):
    fills = reports(spark, (0.0, 10.0), (10.04, 10.0), (20.08, 10.0), (0.0, 10.0), (5.0, None))
    found = fuel_economy(fills).first()
    assert found["fills"] == 5 and found["total_litres"] == 40.0
    # -20.08 km stays in the mean; the fill without litres does not.
    assert found["avg_km_per_litre"] == 0.0


def test_economy_puts_units_without_a_ratio_last(spark):
    other = spark.createDataFrame([(9, "U0", "2026-01-01", "t", 1.0, 10.0)], REPORTS)
    both = reports(spark, (0.0, 10.0), (20.0, 10.0)).union(other)
    assert rows(fuel_economy(both), "unit_no", "avg_km_per_litre") == [("U1", 2.0), ("U0", None)]
    assert fuel_economy(both, limit=1).count() == 1


def _random_fills(spark, with_id: bool):
    """One unit, and the NULL unit, hold most rows; many keys repeat; some rows are copies."""
    rng = random.Random(7)
    made = []
    for i in range(3000):
        unit = rng.choice(["U1", "U1", "U1", None, None, f"U{rng.randint(2, 40)}"])
        day = rng.choice([None, "2026-01-01", f"2026-01-{rng.randint(2, 28):02d}"])
        time = rng.choice([None, f"t{rng.randint(0, 5)}"])
        odometer = rng.choice([None, float(rng.randint(0, 3000)), 100.0])
        made.append((i, unit, day, time, odometer, rng.choice([None, 0.0, 50.0])))
    df = spark.createDataFrame(made, REPORTS)
    return df if with_id else df.drop("id")


@pytest.mark.parametrize("heavy_rows", [1, 4, 60, 10**6])
@pytest.mark.parametrize("with_id", [True, False])
def test_slices_give_the_window_result(spark, with_id, heavy_rows):
    fills = _random_fills(spark, with_id).repartition(5)
    hot = fills.withColumn("unit_no", F.when(F.col("odometer") % 3 != 0, "U0").otherwise(F.col("unit_no")))
    hot = hot.unionByName(fills.withColumn("unit_no", F.lit(None).cast("string")))
    for some in (fills, hot):
        _same_as_one_window(some, with_id, heavy_rows)


def _same_as_one_window(fills, with_id, heavy_rows):
    columns = ["unit_no", "report_date", "created_at", "odometer", "fuel_litres", "prev_odometer"]
    ties = ["id"] if with_id else ["odometer", "fuel_litres"]
    order = [F.col(c).asc_nulls_last() for c in ("report_date", "created_at", *ties)]
    whole = fills.withColumn(
        "prev_odometer", F.lag("odometer").over(Window.partitionBy("unit_no").orderBy(*order))
    ).select(*columns)
    found = fuel_deltas(fills, heavy_rows=heavy_rows).select(*columns)
    assert whole.exceptAll(found).isEmpty() and found.exceptAll(whole).isEmpty()


def test_a_unit_with_only_copies(spark):
    copy = (1, "U1", "2026-01-01", "t", 100.0, 50.0)
    copies = spark.createDataFrame([copy] * 500, REPORTS).drop("id")
    found = fuel_deltas(copies, heavy_rows=10)
    assert found.count() == 500
    assert found.where(F.col("prev_odometer").isNull()).count() == 1


def test_a_hot_unit_uses_several_tasks(spark):
    fills = spark.range(4000).selectExpr(
        "id", "'U1' as unit_no", "'2026-01-01' as report_date",
        "concat('2026-01-01T', lpad(id % 24, 2, '0'), ':', id) as created_at",
        "cast(id as double) as odometer", "50D as fuel_litres",
    )
    found = fuel_deltas(fills, heavy_rows=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 4000


def test_one_count_tells_that_no_unit_is_heavy(spark):
    fills = _random_fills(spark, True)
    tracker = spark.sparkContext.statusTracker()
    for heavy_rows, most in ((10**6, 3), (5, 12)):
        spark.sparkContext.setJobGroup(f"building-{heavy_rows}", "counts and sampled keys")
        try:
            fuel_deltas(fills, heavy_rows=heavy_rows)
            assert 0 < len(tracker.getJobIdsForGroup(f"building-{heavy_rows}")) <= most
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_nothing_to_go_before(spark):
    assert fuel_deltas(spark.createDataFrame([], REPORTS), heavy_rows=1).collect() == []


def test_sums_do_not_depend_on_the_order_of_tasks(spark):
    fills = spark.range(3000).selectExpr(
        "id", "'U1' as unit_no", "'2026-01-01' as report_date", "cast(id as string) as created_at",
        "id * 7.1D as odometer", "0.1D + id / 3 as fuel_litres",
    )
    seen = {
        tuple(fuel_economy(fills.repartition(n, F.rand(n))).first()) for n in (1, 2, 7, 16)
    }
    assert len(seen) == 1


def test_anomalies_are_a_part_of_all_fills_whatever_the_input_order(spark):
    fills = _random_fills(spark, True)
    shown = ["unit_no", "report_date", "odometer", "fuel_litres", "distance_km", "km_per_litre"]
    hits = fuel_anomalies(fills)
    assert hits.select(*shown).exceptAll(fuel_efficiency(fills)).isEmpty()
    assert hits.where("anomaly is null").isEmpty()
    shuffled = fuel_anomalies(fills.orderBy(F.rand(3)))
    assert hits.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(hits).isEmpty()
