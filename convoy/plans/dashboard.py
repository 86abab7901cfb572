"""The dashboard's three result sets, each failing on its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from convoy import schemas
from convoy.operators.anomalies import first_records
from convoy.operators.fuel import fuel_economy
from convoy.operators.insights import text_rows
from convoy.operators.shifts import driver_hours
from convoy.sources.anomaly_store import read_anomalies
from convoy.sources.lake import LATEST, finished_day, read_table


def insights(
    entries: DataFrame, profiles: DataFrame, reports: DataFrame, newest: DataFrame
) -> dict[str, DataFrame]:
    """The named result sets as lazy DataFrames; ``newest`` has the records of the last run."""
    return {
        "driver_hours": driver_hours(entries, profiles, limit=schemas.DASHBOARD_TOP),
        "fuel_economy": fuel_economy(reports, limit=schemas.DASHBOARD_TOP),
        "anomalies": first_records(newest),
    }


def lake_insights(spark: SparkSession, root: str) -> dict[str, Callable[[], DataFrame]]:
    """The same sets over the lake; a missing table only fails the sets that read it.

    All tables are read as of one day, the newest whose extract has finished.
    """
    snapshot = finished_day(spark, root) or LATEST
    top = schemas.DASHBOARD_TOP

    def table(name: str) -> DataFrame:
        return read_table(spark, root, name, snapshot)

    return {
        "driver_hours": lambda: driver_hours(table("time_entries"), table("profiles"), limit=top),
        "fuel_economy": lambda: fuel_economy(table("fuel_reports"), limit=top),
        "anomalies": lambda: first_records(read_anomalies(spark, root, LATEST)),
    }


def collect_insights(
    results: Mapping[str, DataFrame | Callable[[], DataFrame]], max_rows: int | None = None
) -> dict[str, dict]:
    """Run all sets at once; text rows per name, or the name's ``error``.

    The sets are short by themselves. A caller that shows fewer rows passes ``max_rows``,
    and ``truncated`` then tells whether any are left out. Each set runs in a
    scheduler pool of its own, so none waits for another.
    """

    def run(name: str, result) -> dict:
        try:
            df = result() if callable(result) else result
            df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            rows, truncated = text_rows(df, max_rows)
            return {"columns": df.columns, "rows": rows, "truncated": truncated}
        except Exception as problem:  # noqa: BLE001 - one set must not take the others along
            return {"columns": [], "rows": [], "error": str(problem)}

    with ThreadPoolExecutor(max_workers=max(1, len(results))) as pool:
        pending = {name: pool.submit(run, name, result) for name, result in results.items()}
        return {name: job.result() for name, job in pending.items()}
