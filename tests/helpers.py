"""Small builders for hand-made rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORTS = (
    "id long, unit_no string, report_date string, created_at string, "
    "odometer double, fuel_litres double"
)
ENTRIES = (
    "employee_id string, unit_no string, clock_in string, clock_out string, "
    "odometer_in double, odometer_out double"
)
PROFILES = "id string, name string, hourly_rate double"
RECORDS = "category string, entity string, anomaly_type string, detail string"


def reports(spark: SparkSession, *fills: tuple) -> DataFrame:
    """Fills of one unit, one per day, from (odometer, litres) pairs."""
    rows = [
        (i, "U1", f"2026-01-{i + 1:02d}", f"2026-01-{i + 1:02d}T08:00:00+00:00", odometer, litres)
        for i, (odometer, litres) in enumerate(fills)
    ]
    return spark.createDataFrame(rows, REPORTS)


def shift(seconds: float, employee: str = "D1", odometers=(10.0, 20.0)) -> tuple:
    """A shift of a given length that starts at midnight."""
    from datetime import datetime, timedelta, timezone

    start = datetime(2026, 1, 5, tzinfo=timezone.utc)
    end = start + timedelta(seconds=seconds)
    return (employee, "U1", start.isoformat(), end.isoformat(), *odometers)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
