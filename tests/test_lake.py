from __future__ import annotations

import shutil
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from convoy.plans.extract import run_extract
from convoy.session import scratch_path, shared_folder, shuffle_partitions
from convoy.sources.catalog import (
    catalog_text,
    describe_catalog,
    register_tables,
    register_views,
    synchronize_tables,
)
from convoy.sources import lake
from convoy.sources.footers import schema_text, survey
from convoy.sources.lake import (
    ALL,
    LATEST,
    choose_days,
    day_path,
    partition_days,
    read_table,
    remember_schemas,
    table_path,
    write_snapshot,
)
from convoy.sources.operational import (
    drop_sensitive,
    jdbc_ranges,
    read_files,
    sampled_bounds,
    text_ranges,
)
from tests.helpers import PROFILES, rows


def people(spark, *made):
    return spark.createDataFrame(list(made), PROFILES)


def test_sensitive_columns_go_whatever_their_case(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, 3, 4, 5, 6)],
        "id string, Session_Token int, OTP_FAILED_ATTEMPTS int, otp_locked_until int, "
        "Otp_Secret int, PASSWORD int, password_Hash int",
    )
    assert drop_sensitive(df).columns == ["id"]


def test_nothing_sensitive_is_written(spark, root):
    df = spark.createDataFrame([("D1", "x")], "id string, PassWord string")
    write_snapshot(df, root, "profiles", "2026-07-01")
    files = spark.read.parquet(day_path(root, "profiles", "2026-07-01"))
    assert files.columns == ["id"]


def test_rerun_replaces_the_day_and_only_that(spark, root):
    assert write_snapshot(people(spark, ("D1", "A", 1.0)), root, "profiles", "2026-07-01") == 1
    both = people(spark, ("D1", "A", 1.0), ("D2", "B", 2.0))
    assert write_snapshot(both, root, "profiles", "2026-07-02") == 2
    assert write_snapshot(people(spark, ("D3", "C", 3.0)), root, "profiles", "2026-07-02") == 1
    found = read_table(spark, root, "profiles", ALL).select("id", "ingest_date").orderBy("id")
    assert rows(found) == [("D1", "2026-07-01"), ("D3", "2026-07-02")]


def test_empty_table_leaves_the_old_partition(spark, root):
    write_snapshot(people(spark, ("D1", "A", 1.0)), root, "profiles", "2026-07-01")
    nobody = spark.createDataFrame([], PROFILES)
    assert write_snapshot(nobody, root, "profiles", "2026-07-01") == 0
    assert read_table(spark, root, "profiles").count() == 1
    filtered = people(spark, ("D1", "A", 1.0)).where("hourly_rate > 5")
    assert write_snapshot(filtered, root, "profiles", "2026-07-02") == 0
    assert partition_days(spark, table_path(root, "profiles"), "ingest_date") == ["2026-07-01"]


def test_snapshot_choice(spark, root):
    for day, name in (("2026-07-01", "old"), ("2026-07-03", "new")):
        write_snapshot(people(spark, ("D1", name, 1.0)), root, "profiles", day)

    def names(snapshot):
        return sorted(r["name"] for r in read_table(spark, root, "profiles", snapshot).collect())

    assert names(LATEST) == ["new"]
    assert names(ALL) == ["new", "old"]
    assert names("2026-07-02") == ["old"]
    assert names("2026-07-03") == ["new"]
    with pytest.raises(FileNotFoundError):
        names("2026-06-30")
    assert choose_days([], LATEST) == []


def test_other_days_are_not_read(spark, root):
    for day in ("2026-07-01", "2026-07-02"):
        write_snapshot(people(spark, ("D1", "A", 1.0)), root, "profiles", day)
    read = read_table(spark, root, "profiles").inputFiles()
    assert read and all("ingest_date=2026-07-02" in f for f in read)


def test_partition_day_is_text(spark, root):
    write_snapshot(people(spark, ("D1", "A", 1.0)), root, "profiles", "2026-07-01")
    assert dict(read_table(spark, root, "profiles").dtypes)["ingest_date"] == "string"


def test_type_drift_and_missing_and_new_columns(spark, root):
    day1 = spark.createDataFrame([("U1", 5)], "unit_no string, odometer long")
    day2 = spark.createDataFrame(
        [("U1", 6.5, "x")], "unit_no string, odometer double, note string"
    )
    day1.write.parquet(day_path(root, "fuel_reports", "2026-07-01"))
    day2.write.parquet(day_path(root, "fuel_reports", "2026-07-02"))
    found = read_table(spark, root, "fuel_reports", ALL).orderBy("odometer")
    assert rows(found, "odometer", "note", "fuel_litres") == [(5.0, None, None), (6.5, "x", None)]
    assert dict(found.dtypes)["odometer"] == "double"


def test_own_writes_do_not_drift(spark, root):
    whole = spark.createDataFrame([("U1", 5)], "unit_no string, odometer long")
    write_snapshot(whole, root, "fuel_reports", "2026-07-01")
    kinds = dict(spark.read.parquet(day_path(root, "fuel_reports", "2026-07-01")).dtypes)
    assert kinds["odometer"] == "double"


def test_nan_becomes_missing_at_read(spark, root):
    odd = spark.createDataFrame([("U1", float("nan"))], "unit_no string, odometer double")
    write_snapshot(odd, root, "fuel_reports", "2026-07-01")
    assert read_table(spark, root, "fuel_reports").first()["odometer"] is None


def test_unknown_columns_travel_through(spark, root):
    changes = spark.createDataFrame([(1, "U1->U2")], "id long, what string")
    write_snapshot(changes, root, "truck_changes", "2026-07-01")
    assert read_table(spark, root, "truck_changes").columns == ["id", "what", "ingest_date"]


def test_extract_report(spark, root):
    sources = {
        "profiles": people(spark, ("D1", "A", 1.0), ("D2", "B", 2.0)),
        "loads": spark.createDataFrame([], "id long, employee_id string"),
    }
    report = run_extract(spark, sources, root, "2026-07-01")
    assert rows(report) == [
        ("profiles", "2026-07-01", 2),
        ("loads", "2026-07-01", 0),
        ("total", "2026-07-01", 2),
    ]
    assert not Path(table_path(root, "loads"), "ingest_date=2026-07-01").exists()


def test_extract_dates_itself(spark, root):
    from datetime import date

    report = run_extract(spark, {"profiles": people(spark, ("D1", "A", 1.0))}, root)
    assert report.first()["ingest_date"] == date.today().isoformat()


@pytest.mark.parametrize(
    "format, options", [("parquet", {}), ("json", {}), ("csv", {"header": True})]
)
def test_file_sources(spark, tmp_path, format, options):
    path = str(tmp_path / format)
    df = spark.createDataFrame([("D1", "s")], "id string, otp_secret string")
    df.write.format(format).options(**options).save(path)
    assert rows(read_files(spark, path, format, **options)) == [("D1",)]


def test_jdbc_ranges_cover_the_key():
    assert jdbc_ranges("id", 1, 100, 4) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "101",
        "numPartitions": "4",
    }


def test_views_tables_and_description(spark, root):
    write_snapshot(people(spark, ("D1", "A", 1.0)), root, "profiles", "2026-07-01")
    loads = spark.createDataFrame([(1, "D1")], "id long, employee_id string")
    write_snapshot(loads, root, "loads", "2026-07-01")
    write_snapshot(loads, root, "loads", "2026-07-02")
    assert register_views(spark, root) == ["profiles", "loads"]
    assert spark.table("loads").count() == 1
    lines = {r["table"]: r["line"] for r in catalog_text(describe_catalog(spark)).collect()}
    assert lines["loads"] == "- loads(id bigint, employee_id string, ingest_date string)"

    assert register_tables(spark, root, "fleet_test") == ["profiles", "loads"]
    assert spark.table("fleet_test.loads").count() == 2
    again = synchronize_tables(spark, root, "fleet_test")
    assert again["loads"] == {"added": 0, "dropped": 0, "columns": []}
    shutil.rmtree(f"{root}/raw/loads/ingest_date=2026-07-01")
    write_snapshot(loads.withColumn("weight", F.lit(2.5)), root, "loads", "2026-07-03")
    again = synchronize_tables(spark, root, "fleet_test")
    assert again["loads"] == {"added": 1, "dropped": 1, "columns": ["weight"]}
    found = spark.table("fleet_test.loads").orderBy("ingest_date")
    assert rows(found, "ingest_date", "weight") == [("2026-07-02", None), ("2026-07-03", 2.5)]
    described = describe_catalog(spark, "fleet_test").where("table = 'loads'")
    assert rows(described.orderBy("position"), "column", "type")[-1] == ("ingest_date", "string")


@pytest.mark.parametrize(
    "size, expected", [(0, 8), (10 * 1024**3, 40), (100 * 1024**4, 409_600)]
)
def test_shuffle_partitions_follow_the_input(size, expected):
    assert shuffle_partitions(size) == expected


def test_shared_folder_is_the_named_one(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_footers_are_read_in_tasks_and_remembered(spark, root, monkeypatch):
    """Files of one day differ; none is opened from the driver, none twice after a survey."""
    day = day_path(root, "fuel_reports", "2026-07-01")
    whole = spark.createDataFrame([("U1", 5)], "unit_no string, odometer long")
    exact = spark.createDataFrame([("U1", 6.5, ["a"])], "unit_no string, odometer double, tags array<string>")
    for df in (whole, exact, whole):
        df.coalesce(1).write.mode("append").parquet(day)
    pq.write_table(pa.table({"unit_no": ["U2"], "odometer": [7.5], "at": pa.array([1], pa.timestamp("us"))}),
                   f"{day}/foreign.parquet")
    opened = []
    monkeypatch.setattr(lake, "ThreadPoolExecutor", lambda **_: _NoPool(opened))
    found = read_table(spark, root, "fuel_reports").orderBy("odometer", "unit_no")
    assert rows(found, "unit_no", "odometer", "tags") == [
        ("U1", 5.0, None), ("U1", 5.0, None), ("U1", 6.5, ["a"]), ("U2", 7.5, None)]
    assert opened == []
    assert remember_schemas(spark, root, "fuel_reports") == 4
    assert remember_schemas(spark, root, "fuel_reports") == 0
    monkeypatch.setattr(lake, "survey", lambda *_: pytest.fail("known files are opened"))
    assert read_table(spark, root, "fuel_reports").count() == 4
    monkeypatch.undo()
    whole.coalesce(1).write.mode("append").parquet(day)
    assert read_table(spark, root, "fuel_reports").count() == 5
    assert remember_schemas(spark, root, "fuel_reports") == 5


class _NoPool:
    """Stands in for the pool in which the driver would open files."""

    def __init__(self, opened):
        self.opened = opened

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    def map(self, _, files):
        self.opened += files
        return []


def test_schemas_in_footers_are_those_of_the_reader(spark, tmp_path):
    kinds = (
        "a int, b decimal(12,3), c date, d timestamp, e array<struct<x: int, y: map<string, double>>>, "
        "f binary, g boolean, h float, i smallint, j timestamp_ntz"
    )
    path = str(tmp_path / "t")
    spark.createDataFrame([], kinds).coalesce(1).write.parquet(path)
    file = next(str(f) for f in Path(path).glob("part-*"))
    row = survey(spark, [(file, 1), (str(tmp_path / "none.parquet"), 1)]).orderBy("file").collect()
    assert {r["file_schema"] for r in row} == {None, schema_text(spark.read.parquet(file).schema)}


def test_ranges_of_a_text_key_cover_every_row_once(spark):
    keys = [f"D{i % 50}" for i in range(400)] + ["O'Neil", "", None, None] + ["hot"] * 300
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for parts in (1, 2, 7, 500):
        bounds = sampled_bounds(df, parts)
        assert len(bounds) < parts and bounds == sorted(set(bounds))
        ranges = text_ranges("k", bounds)
        found = [df.filter(one) for one in ranges]
        assert sum(part.count() for part in found) == len(keys)
        if parts == 7:
            # No more than a share beside the hot key, which stands on its own.
            assert max(part.filter("k is null or k <> 'hot'").count() for part in found) < 300
    assert text_ranges("k", ["O'Neil"]) == ["k < 'O''Neil' OR k IS NULL", "k >= 'O''Neil'"]
    assert sampled_bounds(df.limit(0), 5) == [] and text_ranges("k", []) == ["1 = 1"]
