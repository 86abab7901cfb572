"""Stored detection runs: JSON lines below ``anomalies/detect_date=<day>``, replaced by versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy import schemas
from convoy.operators.anomalies import summary_columns
from convoy.sources.lake import ALL, LATEST, folder_bytes
from convoy.sources.versions import current, publish

_WITH_DAY = T.StructType(
    [*schemas.ANOMALY.fields, T.StructField(schemas.DETECT_KEY, T.StringType(), True)]
)
_RUNS = T.StructType([*schemas.RUN.fields, T.StructField(schemas.DETECT_KEY, T.StringType(), True)])


def feed_path(root: str) -> str:
    return f"{root}/anomalies"


def runs_path(root: str) -> str:
    return f"{root}/detection_runs"


def write_anomalies(feed: DataFrame, root: str, detect_date: str) -> dict:
    """Replace the records of one day, also by nothing, and return the run's summary.

    The rebalance evens out file sizes and splits an oversized partition. The
    counts are taken by the write, after that shuffle, so a lost executor
    cannot count a record twice. Readers see the old records until the new version
    is complete.
    """
    counts = Observation(f"detect-{detect_date}")
    records = feed.select(*schemas.ANOMALY.names).hint("rebalance")
    records = records.observe(counts, *summary_columns())

    def write(path: str) -> None:
        records.write.option("ignoreNullFields", "false").json(path)

    publish(feed.sparkSession, feed_path(root), schemas.DETECT_KEY, detect_date, write)
    totals = {"total": 0, "fuel": 0, "shift": 0, **counts.get}
    place = f"{feed_path(root)}/{schemas.DETECT_KEY}={detect_date}"
    return {schemas.DETECT_KEY: detect_date, **totals, "output": place}


def write_run(spark: SparkSession, root: str, summary: dict) -> None:
    """Keep the summary of a run, so a run without records is still known."""
    row = tuple(summary[name] for name in schemas.RUN.names)
    one = spark.createDataFrame([row], schemas.RUN).coalesce(1)
    publish(spark, runs_path(root), schemas.DETECT_KEY, summary[schemas.DETECT_KEY], one.write.json)


def _stored(spark: SparkSession, base: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", base).json(paths)
    return rows.select(*schema.names)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    days = current(spark, runs_path(root), schemas.DETECT_KEY)
    return _stored(spark, runs_path(root), _RUNS, list(days.values()))


def read_anomalies(spark: SparkSession, root: str, run: str = ALL, *, by_run: bool = False):
    """Stored records of all runs, of the latest run, or of one day.

    ``latest`` means the newest day that has records, as a maximum over the
    rows would give; it is found from the stored totals of the runs, one row per day, or
    from folder listings where no run is stored. With ``by_run`` it is the newest day
    that ran, which may have no records.
    """
    days = current(spark, feed_path(root), schemas.DETECT_KEY)
    if run == LATEST:
        runs = current(spark, runs_path(root), schemas.DETECT_KEY)
        if runs and not by_run:
            filled = read_runs(spark, root).filter("total > 0")
            run = filled.agg(F.max(schemas.DETECT_KEY)).first()[0]
        else:
            run = max(runs) if runs else _newest_filled(spark, days)
    paths = list(days.values()) if run == ALL else [days[run]] if run in days else []
    return _stored(spark, feed_path(root), _WITH_DAY, paths)


def _newest_filled(spark: SparkSession, days: dict[str, str]) -> str | None:
    """The newest day whose folder holds any bytes."""
    for day, path in reversed(days.items()):
        if folder_bytes(spark, path):
            return day
    return None
