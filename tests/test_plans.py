"""Physical plans: one shuffle where one is enough, pruned scans, no Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from convoy.operators.anomalies import anomalies_latest
from convoy.operators.fuel import fuel_anomalies, fuel_deltas, fuel_economy
from convoy.operators.shifts import completed_shifts, driver_hours, shift_anomalies
from registry.fleet import derived
from registry.spark_queries import FLEET_QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Today's tables as plain parquet."""
    root = tmp_path_factory.mktemp("landed")
    fleet = derived(spark, SMALL)

    def table(name):
        path = str(root / name)
        fleet(name).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    tables = {n: table(n) for n in ("profiles", "time_entries", "fuel_reports")}
    return tables.__getitem__


@pytest.mark.parametrize("name", list(FLEET_QUERIES))
def test_no_python_and_no_product(spark, name):
    text = plan(FLEET_QUERIES[name](derived(spark, SMALL)))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert bad not in text


def test_fills_are_read_and_shuffled_once(landed):
    for found in (
        fuel_deltas(landed("fuel_reports")),
        fuel_economy(landed("fuel_reports"), limit=25),
        fuel_anomalies(landed("fuel_reports"), ordered=False),
    ):
        text = plan(found)
        assert text.count("FileScan") == 1 and "Join" not in text
        assert text.count("Exchange hashpartitioning(unit_no") == 1


def test_only_a_heavy_unit_is_read_again_for_its_slices(landed):
    """One exchange of all fills, one of the heavy units' slice ends."""
    fills = landed("fuel_reports")
    hot = fills.withColumn("unit_no", F.when(F.col("id") % 3 != 0, "U1").otherwise(F.col("unit_no")))
    text = plan(fuel_deltas(hot, heavy_rows=20))
    assert text.count("FileScan") == 2 and "SortMergeJoin" not in text
    # The second exchange follows a partial aggregate.
    assert len(re.findall(r"Exchange hashpartitioning\(unit_no", text)) == 2
    assert text.count("partial_max_by") == 1


def test_economy_keeps_the_top_only(landed):
    assert "TakeOrderedAndProject" in plan(fuel_economy(landed("fuel_reports"), limit=25))


def test_the_feed_is_computed_once_for_the_insights(spark):
    text = plan(FLEET_QUERIES["text_lines"](derived(spark, SMALL)))
    # Fuel economy and the feed read the fills.
    assert text.count("lag(") == 2


def test_only_hits_are_sorted(landed):
    """The sampling for the sort reads settled hits, not the scan."""
    for hits in (
        fuel_anomalies(landed("fuel_reports")),
        shift_anomalies(landed("time_entries"), landed("profiles")),
    ):
        text = plan(hits)
        assert text.index("rangepartitioning") < text.index("REBALANCE") < text.index("FileScan")


def test_open_shifts_are_filtered_in_the_scan(landed):
    text = plan(completed_shifts(landed("time_entries"), landed("profiles")))
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(clock_out\)", text)


def test_only_needed_columns_are_read(landed):
    text = plan(driver_hours(landed("time_entries"), landed("profiles")))
    read = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert {"employee_id", "clock_in", "clock_out"} in read
    assert {"id", "name", "hourly_rate"} in read


def test_shifts_are_summed_before_the_join(landed):
    text = plan(driver_hours(landed("time_entries"), landed("profiles")))
    join = text.index("Join")
    assert "partial_count" in text[join:] and "partial_sum" in text[:join]


def test_roster_is_broadcast_only_by_size(spark, landed):
    entries, roster = landed("time_entries"), landed("profiles")
    assert "BroadcastHashJoin" in plan(shift_anomalies(entries, roster))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = shift_anomalies(entries, roster)
        assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
        beyond = large.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert beyond == shift_anomalies(entries, roster).collect()


def test_times_are_parsed_once_per_shift(landed):
    text = plan(shift_anomalies(landed("time_entries"), landed("profiles"), ordered=False))
    assert text.count("unix_micros(cast(clock_in") == 1


def test_latest_day_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "a")
    for day in ("2026-01-01", "2026-01-02"):
        spark.range(5).selectExpr(
            "'c' as category", "'e' as entity", "'t' as anomaly_type", "'d' as detail"
        ).write.json(f"{path}/detect_date={day}")
    stored = spark.read.schema(
        "category string, entity string, anomaly_type string, detail string, detect_date string"
    ).json(path)
    latest = anomalies_latest(stored)
    assert re.search(r"PartitionFilters: \[[^\]]*Subquery", plan(latest))
    assert latest.count() == 5


@pytest.mark.parametrize("name", ["kpi_tiles", "kpi_tiles_uncapped"])
def test_tiles_read_each_table_once(landed, name):
    tiles = FLEET_QUERIES[name](landed)
    tiles.collect()
    explained = tiles._jdf.queryExecution().explainString(
        tiles.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    # What ran, scalar subqueries included; an exchange used again is not read again.
    final = re.findall(r"== Final Plan ==(.*?)== Initial Plan ==", explained, re.DOTALL)
    scans = {n for part in final for n in re.findall(r"Scan parquet +\((\d+)\)", part)}
    places = dict(re.findall(r"^\((\d+)\) Scan parquet.*?Location: \S+ \[(.*?)\]", explained, re.M | re.S))
    read = sorted(places[n].rsplit("/", 1)[1] for n in scans)
    assert read == ["fuel_reports", "profiles", "time_entries"]
