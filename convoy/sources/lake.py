"""The lake: ``raw/<table>/ingest_date=<day>`` as parquet, one snapshot per day."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy import schemas
from convoy.functions.numeric import nan_to_null
from convoy.sources.footers import KEPT, schema_text, survey
from convoy.sources.operational import drop_sensitive
from convoy.sources.versions import current, publish

LATEST = "latest"
ALL = "all"


def table_path(root: str, table: str) -> str:
    return f"{root}/raw/{table}"


def day_path(root: str, table: str, day: str) -> str:
    return f"{table_path(root, table)}/{schemas.INGEST_KEY}={day}"


def report_path(root: str) -> str:
    return f"{root}/extract_runs"


def write_report(report: DataFrame, root: str, day: str) -> None:
    """Keep the report of a day's extract; it marks the day as complete."""
    target = f"{report_path(root)}/{schemas.INGEST_KEY}={day}"
    report.coalesce(1).write.mode("overwrite").json(target)


def known_schemas(spark: SparkSession, root: str, table: str) -> dict[str, str]:
    """The file schema of each day that an extract has written, from the stored reports."""
    if not partition_days(spark, report_path(root), schemas.INGEST_KEY):
        return {}
    kept = f"table string, file_schema string, {schemas.INGEST_KEY} string"
    rows = spark.read.schema(kept).json(report_path(root))
    rows = rows.filter((F.col("table") == table) & F.col("file_schema").isNotNull())
    return {r[schemas.INGEST_KEY]: r["file_schema"] for r in rows.collect()}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in their declared types; missing ones as NULL, others kept."""
    present = set(df.columns)
    declared = {
        f.name: (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType)
        for f in schemas.TABLES[table].fields
    }
    return nan_to_null(df.withColumns(declared) if declared else df)


def file_schema(df: DataFrame, table: str) -> str:
    """The schema, as JSON, of the files that ``write_snapshot`` makes of ``df``."""
    return schema_text(_cast_declared(drop_sensitive(df), table).schema)


def _cast_declared(df: DataFrame, table: str) -> DataFrame:
    """Declared columns that the source has, in their declared types."""
    kinds = {f.name: f.dataType for f in schemas.TABLES[table].fields if f.name in df.columns}
    return df.withColumns({n: F.col(f"`{n}`").cast(t) for n, t in kinds.items()}) if kinds else df


def write_snapshot(
    df: DataFrame, root: str, table: str, day: str, *, rows_per_file: int = 0
) -> int:
    """Replace one day of one table and return its row count.

    Only the partition of ``day`` is swapped, and only when the job commits; a
    table without rows leaves the lake as it is. Rows are counted by the write
    itself, so the source is read once. A positive ``rows_per_file`` splits
    the output of a large task over several files.
    """
    written = Observation(f"{table}-{day}")
    minimal = _cast_declared(drop_sensitive(df), table)
    (
        minimal.observe(written, F.count(F.lit(1)).alias("rows"))
        .withColumn(schemas.INGEST_KEY, F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(schemas.INGEST_KEY)
        .parquet(table_path(root, table))
    )
    return written.get.get("rows", 0)


def partition_days(spark: SparkSession, path: str, key: str) -> list[str]:
    """The days below ``path`` in order: one listing of one folder, no data files."""
    return [day for day, _ in _partitions(spark, path, key)]


def _partitions(spark: SparkSession, path: str, key: str) -> list[tuple[str, object]]:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{key}="):
            found.append((name.split("=", 1)[1], status.getPath()))
    return sorted(found)


def finished_day(spark: SparkSession, root: str) -> str | None:
    """The newest day whose extract has written its report, which comes after all tables."""
    days = partition_days(spark, report_path(root), schemas.INGEST_KEY)
    return days[-1] if days else None


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of the files right below a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(s.getLen() for s in files.listStatus(folder)) if files.exists(folder) else 0


def choose_days(days: list[str], snapshot: str) -> list[str]:
    """``latest``, ``all``, or the newest day not after a given date."""
    if snapshot == ALL:
        return days
    eligible = days if snapshot == LATEST else [d for d in days if d <= snapshot]
    return eligible[-1:]


def read_table(
    spark: SparkSession, root: str, table: str, snapshot: str = LATEST
) -> DataFrame:
    """One table of the lake at one snapshot, or over all of them.

    Days outside the choice are not even listed. Files that differ in
    physical types are read apart and cast to the declared types, since one
    parquet scan cannot read a column both as integers and as doubles.
    """
    path = table_path(root, table)
    days = choose_days(partition_days(spark, path, schemas.INGEST_KEY), snapshot)
    if not days:
        raise FileNotFoundError(f"no snapshot of {table} for {snapshot!r} below {path}")
    parts = [conform(df, table) for df in _by_schema(spark, root, table, days)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    others = [c for c in merged.columns if c != schemas.INGEST_KEY]
    return merged.select(*[f"`{c}`" for c in others], schemas.INGEST_KEY)


def _by_schema(spark: SparkSession, root: str, table: str, days: list[str]) -> list[DataFrame]:
    """One scan per distinct file schema; a table has few over its life.

    Days that an extract has reported are grouped without opening a file. Files of other days
    may differ from each other, so their footers count.
    """
    known = known_schemas(spark, root, table)
    groups: dict[str, list[str]] = {}
    for day in days:
        if day in known:
            groups.setdefault(known[day], []).append(day_path(root, table, day))
    foreign = [day for day in days if day not in known]
    for file, schema in _file_schemas(spark, root, table, foreign):
        groups.setdefault(schema, []).append(file)
    return [
        _several(spark, root, table, T.StructType.fromJson(json.loads(schema)), paths)
        for schema, paths in groups.items()
    ]


def survey_path(root: str, table: str) -> str:
    return f"{root}/schema_surveys/{table}"


def _file_schemas(
    spark: SparkSession, root: str, table: str, days: list[str]
) -> list[tuple[str, str]]:
    """(file, schema) of all files of days that no extract has reported.

    Remembered surveys count where names and sizes of the files are still the same; the
    footers of the rest are read in tasks. Only a file system that tasks cannot open is left to
    Spark's own inference, a file at a time.
    """
    files = {day: _files(spark, root, table, day) for day in days}
    found = _remembered(spark, root, table, files)
    rest = [file for day in days for file in files[day] if file[0] not in found]
    if rest:
        rows = survey(spark, rest).collect()
        found |= {r["file"]: r["file_schema"] for r in rows if r["file_schema"]}
        closed = [file for file, _ in rest if file not in found]
        with ThreadPoolExecutor(max_workers=8) as pool:
            kinds = pool.map(lambda f: schema_text(spark.read.parquet(f).schema), closed)
            found |= dict(zip(closed, kinds, strict=True))
    return [(file, found[file]) for day in days for file, _ in files[day]]


def _remembered(
    spark: SparkSession, root: str, table: str, files: dict[str, list[tuple[str, int]]]
) -> dict[str, str]:
    """Schemas from kept surveys of days whose files have not changed since."""
    kept = current(spark, survey_path(root, table), schemas.INGEST_KEY) if files else {}
    paths = [kept[day] for day in files if day in kept]
    if not paths:
        return {}
    rows = spark.read.schema(KEPT).json(paths).collect()
    before = {(r["file"], r["bytes"]): r["file_schema"] for r in rows}
    return {
        file[0]: before[file] for listed in files.values() for file in listed if file in before
    }


def remember_schemas(spark: SparkSession, root: str, table: str) -> int:
    """Survey the days that no extract has reported and that changed; how many files were opened."""
    days = partition_days(spark, table_path(root, table), schemas.INGEST_KEY)
    reported = known_schemas(spark, root, table)
    files = {day: _files(spark, root, table, day) for day in days if day not in reported}
    known = _remembered(spark, root, table, files)
    opened = 0
    for day, listed in files.items():
        if listed and any(file not in known for file, _ in listed):
            rows = survey(spark, listed).filter("file_schema IS NOT NULL")
            publish(spark, survey_path(root, table), schemas.INGEST_KEY, day, rows.write.json)
            opened += len(listed)
    return opened


def _files(spark: SparkSession, root: str, table: str, day: str) -> list[tuple[str, int]]:
    """The data files of one day and their sizes: one listing, none is opened."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(day_path(root, table, day))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = [(s.getPath().getName(), s.getLen()) for s in files.listStatus(folder)]
    return [
        (f"{day_path(root, table, day)}/{name}", size)
        for name, size in sorted(listed)
        if not name.startswith(("_", "."))
    ]


def _several(
    spark: SparkSession, root: str, table: str, schema: T.StructType, paths: list[str]
) -> DataFrame:
    # The day is declared as text; Spark would otherwise infer a date.
    own = [f for f in schema.fields if f.name != schemas.INGEST_KEY]
    full = T.StructType([*own, T.StructField(schemas.INGEST_KEY, T.StringType(), True)])
    reader = spark.read.schema(full).option("basePath", table_path(root, table))
    return reader.parquet(*paths)
