"""Detection triggered by arriving snapshots instead of by a timer.

The work is the batch job itself. The stream only carries the finished days,
so its checkpoint remembers which of them have been checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from convoy import schemas
from convoy.plans.detect import detect
from convoy.sources.lake import report_path


def detect_arrivals(spark: SparkSession, root: str, checkpoint: str | None = None) -> list[dict]:
    """Detect on every day whose extract finished since the last call.

    A day announces itself by its extract report, which is written after all
    its tables. A day extracted again is checked again, and since detection
    replaces the day's records, a batch repeated after a failure does no harm.
    Returns the summaries, oldest day first.
    """
    summaries: list[dict] = []

    def check(batch: DataFrame, _: int) -> None:
        # One value per day of the lake.
        days = sorted(r[0] for r in batch.select(schemas.INGEST_KEY).distinct().collect())
        summaries.extend(detect(batch.sparkSession, root, day, snapshot=day) for day in days)

    finished = spark.readStream.schema(schemas.EXTRACT_REPORT).json(report_path(root))
    query = (
        finished.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint or f"{root}/_detect_arrivals")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return summaries
