"""The daily detection run over the lake."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from convoy.operators.anomalies import anomaly_feed
from convoy.operators.fuel import fuel_anomalies
from convoy.operators.shifts import shift_anomalies
from convoy.sources.anomaly_store import write_anomalies, write_run
from convoy.sources.lake import LATEST, finished_day, read_table


def detection_feed(
    reports: DataFrame, entries: DataFrame, profiles: DataFrame, *, hour_scale: int | None = None
) -> DataFrame:
    """All rule hits as records; unordered, since the store keeps a bag."""
    fuel = fuel_anomalies(reports, ordered=False)
    shift = shift_anomalies(entries, profiles, hour_scale=hour_scale, ordered=False)
    return anomaly_feed(fuel, shift)


def detect(
    spark: SparkSession,
    root: str,
    run_date: str | None = None,
    *,
    snapshot: str = LATEST,
    hour_scale: int | None = None,
) -> dict:
    """Check the whole history in one snapshot and replace the day's records.

    The latest snapshot is the newest day whose extract has finished, for all tables;
    a lake without extract reports is read at each table's newest day.

    Returns the run's summary. Running a day again gives the same partition.
    """
    day = run_date or datetime.now(UTC).date().isoformat()
    if snapshot == LATEST:
        snapshot = finished_day(spark, root) or LATEST
    feed = detection_feed(
        read_table(spark, root, "fuel_reports", snapshot),
        read_table(spark, root, "time_entries", snapshot),
        read_table(spark, root, "profiles", snapshot),
        hour_scale=hour_scale,
    )
    summary = write_anomalies(feed, root, day)
    write_run(spark, root, summary)
    return summary
