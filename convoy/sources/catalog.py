"""Registering the lake's tables, and describing what is registered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy import schemas
from convoy.sources.anomaly_store import feed_path, read_anomalies
from convoy.sources.lake import ALL, LATEST, partition_days, read_table, table_path
from convoy.sources.versions import current

# Partitions that one statement adds or drops.
_AT_ONCE = 500

_DESCRIPTION = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
    ]
)


def register_views(spark: SparkSession, root: str, snapshot: str = LATEST) -> list[str]:
    """One temporary view per table folder, plus ``anomalies``; returns their names.

    A view stays on the snapshot found now; register again after an extract.
    """
    made = []
    for table in schemas.TABLES:
        if partition_days(spark, table_path(root, table), schemas.INGEST_KEY):
            read_table(spark, root, table, snapshot).createOrReplaceTempView(table)
            made.append(table)
    if current(spark, feed_path(root), schemas.DETECT_KEY):
        read_anomalies(spark, root, ALL).createOrReplaceTempView("anomalies")
        made.append("anomalies")
    return made


def register_tables(spark: SparkSession, root: str, database: str) -> list[str]:
    """External catalog tables over the folders, one each, with their partitions."""
    return list(synchronize_tables(spark, root, database))


def synchronize_tables(spark: SparkSession, root: str, database: str) -> dict[str, dict]:
    """External catalog tables over the folders, brought up to date; what changed in each.

    The folder listing is held against the catalog's partitions: new days are added, days that
    are gone are dropped, and no other folder is opened. Columns that the newest day has gained
    are added; vanished ones stay. Of a detection day the current version is registered.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    made = {}
    for table in schemas.TABLES:
        path = table_path(root, table)
        days = partition_days(spark, path, schemas.INGEST_KEY)
        if days:
            columns = read_table(spark, root, table, LATEST).drop(schemas.INGEST_KEY).schema
            wanted = {(f"{schemas.INGEST_KEY}={day}",) for day in days}
            made[table] = _registered(spark, database, table, columns, "parquet", path, wanted)
    runs = current(spark, feed_path(root), schemas.DETECT_KEY)
    if runs:
        base = feed_path(root)
        wanted = {tuple(p.removeprefix(f"{base}/").split("/")) for p in runs.values()}
        # A day written without versions has no second folder.
        wanted = {p for p in wanted if len(p) == 2}
        made["anomalies"] = _registered(
            spark, database, "anomalies", schemas.ANOMALY, "json", base, wanted
        )
    return made


def _registered(
    spark: SparkSession,
    database: str,
    table: str,
    columns: T.StructType,
    format: str,
    path: str,
    wanted: set[tuple[str, ...]],
) -> dict:
    """One table whose partitions, as ``key=value`` parts of their folders, are those wanted."""
    name = f"`{database}`.`{table}`"
    keys = [part.split("=", 1)[0] for part in next(iter(wanted), ())]
    listed = [_column(f) for f in columns.fields] + [f"`{k}` string" for k in keys]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(listed)}) USING {format} "
        f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)}) LOCATION '{path}'"
    )
    known = set(spark.table(name).columns)
    gained = [f for f in columns.fields if f.name not in known]
    if gained:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(map(_column, gained))})")
    have = {tuple(r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    added, gone = sorted(wanted - have), sorted(have - wanted)
    for at in range(0, len(added), _AT_ONCE):
        some = " ".join(map(_partition, added[at : at + _AT_ONCE]))
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {some}")
    for at in range(0, len(gone), _AT_ONCE):
        some = ", ".join(map(_partition, gone[at : at + _AT_ONCE]))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {some}")
    if added or gone or gained:
        spark.catalog.refreshTable(name)
    return {"added": len(added), "dropped": len(gone), "columns": [f.name for f in gained]}


def _column(field: T.StructField) -> str:
    return f"`{field.name}` {field.dataType.simpleString()}"


def _partition(parts: tuple[str, ...]) -> str:
    pairs = [part.split("=", 1) for part in parts]
    return f"PARTITION ({', '.join(f"`{k}` = '{v}'" for k, v in pairs)})"


def describe_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Columns of every registered table or view, partition columns last."""
    rows = []
    for table in spark.catalog.listTables(database):
        name = table.name if table.isTemporary or not database else f"{database}.{table.name}"
        columns = sorted(spark.catalog.listColumns(name), key=lambda c: c.isPartition)
        rows += [(table.name, i, c.name, c.dataType) for i, c in enumerate(columns, start=1)]
    return spark.createDataFrame(rows, _DESCRIPTION)


def catalog_text(description: DataFrame) -> DataFrame:
    """One line per table: ``- table(column type, ...)``."""
    pair = F.struct("position", F.concat_ws(" ", "column", "type").alias("text"))
    ordered = F.array_sort(F.collect_list(pair))
    return (
        description.groupBy("table")
        .agg(ordered.alias("columns"))
        .select(
            "table",
            F.concat(
                F.lit("- "),
                "table",
                F.lit("("),
                F.array_join(F.col("columns.text"), ", "),
                F.lit(")"),
            ).alias("line"),
        )
        .orderBy("table")
    )
