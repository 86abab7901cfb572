"""Intermediate tables in the shared folder, and Arrow columns as flat buffers."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.session import scratch_path

# Bytes of text that one step of a Python task holds as arrays.
SLICE_BYTES = 1 << 20


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and its lineage cut."""
    return written(df, label)[0]


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``landed``, with the path of the table, for tables that are soon replaced."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of ``written`` that no result reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def whole_row(df: DataFrame, alias: str = "row") -> Column:
    """All columns as one struct, beside which no name of theirs can clash."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns]).alias(alias)


def released(df: DataFrame) -> DataFrame:
    """``df``, once the shuffle files of finished steps are given back.

    Spark's cleaner removes them when the driver collects its garbage, which a long job
    may not do before the disks hold the files of all of its steps.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, null as empty, and the offsets of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts have about ``size`` bytes, one row at least.

    ``column`` holds the texts or, as numbers, their lengths.
    """
    lengths = batch.column(column)
    if not pa.types.is_integer(lengths.type):
        lengths = pc.binary_length(lengths)
    lengths = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow list column from flat values and the length of each list."""
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
