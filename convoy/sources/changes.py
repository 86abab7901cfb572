"""What came and what went between two daily snapshots, kept as a table of its own.

The difference is one of bags: rows of the day count plus one, rows of the day before minus
one, and what does not cancel out is a change. A corrected row thus goes with its old values
and comes with the new ones. Only columns that some rule reads take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy import schemas
from convoy.sources.lake import partition_days, read_table, table_path
from convoy.sources.versions import current, publish

# Copies of a row that came, or minus those that went.
COPIES = "copies"


def changes_path(root: str, table: str) -> str:
    return f"{root}/changes/{table}"


def compared_columns(df: DataFrame, table: str) -> list[str]:
    """The declared columns, and the id that makes the order of a day definite."""
    names = [*schemas.TABLES[table].names, "id"]
    return [n for n in dict.fromkeys(names) if n in df.columns]


def day_before(spark: SparkSession, root: str, table: str, day: str) -> str | None:
    days = partition_days(spark, table_path(root, table), schemas.INGEST_KEY)
    return max((d for d in days if d < day), default=None)


def difference(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """Rows that are not equally often in both, with ``copies``."""
    signed = new.withColumn(COPIES, F.lit(1))
    if old is not None:
        signed = signed.unionByName(old.withColumn(COPIES, F.lit(-1)), allowMissingColumns=True)
    net = signed.groupBy(*[f"`{c}`" for c in signed.columns if c != COPIES])
    return net.agg(F.sum(COPIES).alias(COPIES)).filter(F.col(COPIES) != 0)


def write_changes(
    spark: SparkSession, root: str, table: str, day: str, since: str | None = None
) -> str:
    """Keep the difference between a day's snapshot and that of ``since``, or the one before."""
    since = since or day_before(spark, root, table, day)
    new = read_table(spark, root, table, day)
    new = new.select(*compared_columns(new, table))
    old = None
    if since:
        old = read_table(spark, root, table, since)
        # Undeclared ids may have changed their type.
        kinds = {c: F.col(c).cast(new.schema[c].dataType) for c in compared_columns(old, table) if c in new.columns}
        old = old.select(*[kind.alias(c) for c, kind in kinds.items()])
    changed = difference(new, old)
    base = changes_path(root, table)
    return publish(spark, base, schemas.INGEST_KEY, day, changed.write.parquet)


def read_changes(spark: SparkSession, root: str, table: str, day: str) -> DataFrame:
    """The changes of one day; its files are all that is read."""
    days = current(spark, changes_path(root, table), schemas.INGEST_KEY)
    if day not in days:
        raise FileNotFoundError(f"no changes of {table} for {day}")
    return spark.read.parquet(days[day])


def came(changes: DataFrame) -> DataFrame:
    """Rows that came, each as often as it did."""
    rows = changes.filter(F.col(COPIES) > 0)
    each = F.explode(F.sequence(F.lit(1).cast("long"), COPIES))
    return rows.withColumn("_each", each).drop("_each", COPIES)


def went(changes: DataFrame) -> DataFrame:
    """Rows that went."""
    return changes.filter(F.col(COPIES) < 0).drop(COPIES)
