"""Sort keys with explicit NULL placement, and a sort that spreads equal keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ascending(*names: str) -> list[Column]:
    """Ascending keys with NULLs at the end."""
    return [F.col(n).asc_nulls_last() for n in names]


def descending(*names: str) -> list[Column]:
    """Descending keys with NULLs at the end."""
    return [F.col(n).desc_nulls_last() for n in names]


def spread_sort(df: DataFrame, *keys: Column, settle: bool = False) -> DataFrame:
    """Global sort in which rows with equal keys need not share a task.

    Spark sorts by range partitions, and all rows equal on every key fall into
    one range. Two last keys let the sampled ranges cut through such a group: a
    hash of the row, and a number that tells exact copies apart. The hash comes
    first because the number may change when a lost task runs again; only
    copies, which are interchangeable, may then change places. The order of the
    named keys is untouched.

    Sampling the ranges runs everything since the last shuffle a second time.
    ``settle`` puts a shuffle in front, which pays when few rows are left of a
    long scan.
    """
    if settle:
        df = df.hint("rebalance")
    return df.orderBy(*keys, row_hash(df), F.monotonically_increasing_id())


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns: equal for copies, different for other rows."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def comparable(*names: str) -> Column:
    """One struct that compares like ``ascending(*names)``, NULLs largest."""
    parts = []
    for i, n in enumerate(names):
        parts += [F.col(n).isNull().alias(f"n{i}"), F.col(n).alias(f"v{i}")]
    return F.struct(*parts)
