"""Choosing one daily snapshot out of a table that holds several."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy import schemas


def latest_snapshot(df: DataFrame, key: str = schemas.INGEST_KEY) -> DataFrame:
    """Rows of the newest day. The day is a scalar subquery, so files are pruned by it."""
    newest = df.select(F.max(key)).scalar()
    return df.where(F.col(key) == newest)


def as_of_snapshot(df: DataFrame, day: str, key: str = schemas.INGEST_KEY) -> DataFrame:
    """Rows of the newest day not after ``day``."""
    newest = df.where(F.col(key) <= day).select(F.max(key)).scalar()
    return df.where(F.col(key) == newest)
