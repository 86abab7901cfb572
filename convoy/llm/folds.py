"""Which labelled rows a model learns from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept for testing: crc32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y) of documents whose label is 0 or 1; the larger of repeated labels counts."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(column).cast("int").alias("y")
    )
