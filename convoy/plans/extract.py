"""The daily extract: operational tables into the lake, and a report of it."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy import schemas
from convoy.sources.lake import file_schema, write_report, write_snapshot


def run_extract(
    spark: SparkSession, sources: Mapping[str, DataFrame], root: str, run_date: str | None = None
) -> DataFrame:
    """Write a snapshot of every source and return ``(table, ingest_date, rows)``.

    The tables do not depend on each other, so their jobs are submitted side by
    side and short ones fill the gaps of long ones. The report has one row per
    table and one, named ``total``, for all; it is also kept in the lake.
    """
    day = run_date or datetime.now(UTC).date().isoformat()
    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        pending = {
            table: pool.submit(write_snapshot, df, root, table, day)
            for table, df in sources.items()
        }
        rows = {table: job.result() for table, job in pending.items()}
    found = [(table, day, count) for table, count in rows.items()]
    found.append(("total", day, sum(rows.values())))
    report = spark.createDataFrame(found, schemas.EXTRACT_REPORT)
    kinds = [(table, file_schema(df, table)) for table, df in sources.items()]
    stored = spark.createDataFrame(kinds, "table string, file_schema string")
    write_report(report.join(F.broadcast(stored), "table", "left"), root, day)
    return report
