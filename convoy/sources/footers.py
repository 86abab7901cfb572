"""Schemas of parquet files, read from their footers inside tasks.

The driver lists a day's files; tasks open the footers and hand back one digest per file. What
a survey finds is kept per day beside the lake, with the files' names and sizes, and a day is
surveyed again only if these have changed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
# Footers that one task reads, about.
_PER_TASK = 64
KEPT = "file string, bytes long, file_schema string"


def nullable(schema: T.StructType) -> T.StructType:
    """The schema as a reader hands it out: every part may be missing."""

    def part(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, part(f.dataType), True) for f in kind.fields])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(part(kind.elementType), True)
        if isinstance(kind, T.MapType):
            return T.MapType(part(kind.keyType), part(kind.valueType), True)
        return kind

    return part(schema)


def schema_text(schema: T.StructType) -> str:
    return nullable(schema).json()


def _of_file(path: str) -> str | None:
    """The schema of one file, or None where tasks cannot open its file system."""
    from pyarrow import fs, parquet
    from pyspark.sql.pandas.types import from_arrow_schema

    try:
        files, place = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        with files.open_input_file(place) as source:
            found = parquet.read_schema(source)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    own = (found.metadata or {}).get(_SPARK_SCHEMA)
    if own:
        return schema_text(T.StructType.fromJson(json.loads(own)))
    return schema_text(from_arrow_schema(found.remove_metadata()))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_of_file(path) for path in batch.column("file").to_pylist()]
        columns = [batch.column("file"), batch.column("bytes"), pa.array(found, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "bytes", "file_schema"])


def survey(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """(file, bytes, file_schema) of the files given as (path, bytes)."""
    listed = spark.createDataFrame(files, "file string, bytes long")
    tasks = max(1, -(-len(files) // _PER_TASK))
    return listed.repartition(tasks, "file").mapInArrow(_read, KEPT)
