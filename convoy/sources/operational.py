"""Full reads of operational tables, split over tasks by the source format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy import schemas

# Fixed value: rows fetched per round trip.
PAGE_ROWS = 1000
# Sampled keys for each range of a text key.
BOUND_SAMPLE = 64


def drop_sensitive(df: DataFrame) -> DataFrame:
    """Without the columns on the deny list, whatever their case."""
    return df.drop(*[c for c in df.columns if c.lower() in schemas.SENSITIVE])


def read_files(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    """A whole table from parquet, JSON or CSV files, minus sensitive columns."""
    return drop_sensitive(spark.read.format(format).options(**options).load(path))


def jdbc_ranges(key: str, low: int, high: int, partitions: int) -> dict[str, str]:
    """Options that read a table in parallel ranges of a numeric key.

    The ranges cover every row: the outermost two are open, the first takes NULLs.
    """
    return {
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(partitions),
    }


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def text_ranges(key: str, bounds: list[str]) -> list[str]:
    """Predicates that cut a table into half-open ranges of a text key.

    ``bounds`` are in the order of whoever evaluates them. The outermost ranges are open, and
    rows without a key belong to the first, so every row fulfils exactly one predicate.
    """
    if not bounds:
        return ["1 = 1"]
    named = [quoted(b) for b in bounds]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(named, named[1:], strict=False)]
    return [f"{key} < {named[0]} OR {key} IS NULL", *inner, f"{key} >= {named[-1]}"]


def sampled_bounds(
    keys: DataFrame, partitions: int, per_partition: int = BOUND_SAMPLE
) -> list[str]:
    """Up to ``partitions`` - 1 keys that part the rows about evenly.

    ``keys`` has one column. Its rows are sampled by hash, so that equal keys are sampled
    alike and the same table gives the same bounds; the sample is small whatever the table's size.
    """
    name = f"`{keys.columns[0]}`"
    rows = keys.select(F.col(name).cast("string").alias("key")).filter("key IS NOT NULL")
    total, fineness = rows.count(), 1 << 40
    rate = min(fineness, -(-partitions * per_partition * fineness // max(total, 1)))
    some = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    picked = some.filter(F.pmod(F.xxhash64("key"), F.lit(fineness)) < rate)
    # A key that more rows have than a part should hold is a bound in any case.
    heavy = some.filter(F.col("n") * partitions > total)
    listed = picked.unionByName(heavy).distinct().orderBy("key").collect()
    share, seen, bounds = sum(r["n"] for r in listed) / partitions, 0, []
    for row in listed:
        if seen >= share * (len(bounds) + 1) and len(bounds) < partitions - 1:
            bounds.append(row["key"])
        seen += row["n"]
    return bounds


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str | None = None,
    partitions: int = 32,
    page_rows: int = PAGE_ROWS,
    **options: str,
) -> DataFrame:
    """A whole database table, minus sensitive columns.

    With a ``key`` the read is split over ``partitions`` tasks: a numeric key between its
    bounds, which one pushed-down query finds first; any other by ranges of its text between
    sampled keys. These the database itself puts in order, since its collation need not
    be that of Spark.
    """

    def load(**more: str) -> DataFrame:
        settings = {"url": url, "fetchsize": str(page_rows), **options, **more}
        return spark.read.format("jdbc").options(**settings).load()

    if key is None:
        return drop_sensitive(load(dbtable=table))
    bounds = load(query=f"select min({key}) as lo, max({key}) as hi from {table}")
    if isinstance(bounds.schema[0].dataType, T.NumericType):
        low, high = bounds.select(F.col(bounds.columns[0]).cast("long"), F.col(bounds.columns[1]).cast("long")).first()
        ranges = {} if low is None else jdbc_ranges(key, low, high, partitions)
        return drop_sensitive(load(dbtable=table, **ranges))
    named = sampled_bounds(load(query=f"select {key} from {table}"), partitions)
    if named:
        some = ", ".join(map(quoted, named))
        ordered = f"select {key} from {table} where {key} in ({some}) group by {key} order by {key}"
        named = [r[0] for r in load(query=ordered).coalesce(1).collect()]
    properties = {"fetchsize": str(page_rows), **options}
    parts = spark.read.jdbc(url, table, predicates=text_ranges(key, named), properties=properties)
    return drop_sensitive(parts)
