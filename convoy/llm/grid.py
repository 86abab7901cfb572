"""Vectors as whole numbers: exact distances, and sums that any order of tasks gives alike."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole numbers up to here are exact as doubles.
_EXACT = 1 << 53


def finite(vector: str) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(good, F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """Each component as the floor of ``scale`` times its double."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * scale).cast("long"))


def check_range(vectors: DataFrame, column: str, dims: int) -> int:
    """The largest absolute component; an error where squared distances would not be exact."""
    each = F.array_max(F.transform(column, lambda v: F.abs(v.cast("double"))))
    peak = int(vectors.agg(F.max(each)).first()[0] or 0)
    if dims * (4 * peak) ** 2 >= 1 << 63 or dims * 2 * peak >= 1 << 31:
        raise ValueError(f"components up to {peak} are too large for exact distances")
    return peak


def kind(peak: int, dims: int) -> type:
    """Doubles where every product and sum of a distance is exact in them, else integers."""
    return np.float64 if 4 * dims * max(peak, 1) ** 2 < _EXACT else np.int64


def matrix(column: pa.Array | pa.ChunkedArray, dims: int, number: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(number).reshape(-1, dims)


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    return (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)


def floor_means(sums: np.ndarray, counts: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Floors of the means; what no vector chose stays as it is."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], old)


def summed(partial: DataFrame, rows: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) from partial rows (entry, values), the last value being the count.

    What reaches the driver has one row per entry and component.
    """
    placed = partial.select("entry", F.posexplode("values").alias("place", "value"))
    totals = placed.groupBy("entry", "place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((rows, dims + 1), np.int64)
    out[totals.column("entry").to_numpy(), totals.column("place").to_numpy()] = totals.column(
        "value"
    ).to_numpy()
    return out[:, :dims], out[:, dims]


class Sums:
    """Partial sums of a task: one row of components and a count for each entry."""

    def __init__(self, rows: int, dims: int):
        self.values = np.zeros((rows, dims + 1), np.int64)

    def add(self, entry: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(entry, kind="stable")
        present, first = np.unique(entry[order], return_index=True)
        if len(present):
            self.values[present, :-1] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
            self.values[present, -1] += np.diff(np.append(first, len(order)))

    def batch(self) -> pa.RecordBatch:
        entry = np.flatnonzero(self.values[:, -1])
        values = self.values[entry]
        ends = np.arange(len(entry) + 1, dtype=np.int32) * values.shape[1]
        listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1)))
        return pa.RecordBatch.from_arrays([pa.array(entry), listed], names=["entry", "values"])


SUMS = "entry long, values array<long>"
