"""The value of the preceding row in a group, also when one group is huge.

One shuffle by group and one window serve all groups that fit a task. A count per group,
which reads the group column alone, tells whether any holds more than a fair share of the
rows. Only such groups are cut into slices along the order, at quantiles of a sample of their
keys, as a range shuffle would; the window then runs by group and slice, and the last
value of each slice is carried to the next one. There are fewer heavy groups, and fewer cuts, than
shuffle partitions, so cuts and carried values are small enough to broadcast at any size.
"""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from convoy.functions.ordering import ascending, comparable

# A group of so many rows never needs more than one task.
HEAVY_ROWS = 1_000_000
# Sampled keys per slice, and how fine a share of rows can be sampled.
_SAMPLED = 16
_FINENESS = 1 << 40


def with_previous(
    df: DataFrame,
    group: str,
    order: list[str],
    value: str,
    output: str,
    *,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add ``output``: the ``value`` of the row before, within ``group``.

    The first row of a group gets NULL, and a NULL ``value`` is passed on as
    NULL. Rows are ordered by ``order`` with NULLs last. A group with more than
    ``heavy_rows`` rows and more than its share of a task is spread over several.
    """
    cuts = _cuts(df, group, order, heavy_rows)
    if cuts is None:
        within = Window.partitionBy(group).orderBy(*ascending(*order))
        return df.withColumn(output, F.lag(value).over(within))
    sliced = _sliced(df, group, order, cuts)
    boxed = F.struct(F.col(value).alias("v"))
    within = Window.partitionBy(group, "_slice").orderBy(*ascending(*order))
    marked = sliced.drop("_cut").withColumn("_before", F.lag(boxed).over(within))

    # One row per slice of a heavy group.
    heavy = sliced.filter("_cut").groupBy(F.col(group).alias("_of"), F.col("_slice").alias("_at"))
    ends = heavy.agg(F.max_by(boxed, comparable(*order)).alias("_end"))
    onward = Window.partitionBy("_of").orderBy("_at")
    carried = ends.select("_of", "_at", F.lag("_end").over(onward).alias("_carry"))
    same = marked[group].eqNullSafe(carried["_of"]) & (marked["_slice"] == carried["_at"])
    found = F.coalesce("_before", "_carry")["v"]
    joined = marked.join(F.broadcast(carried), same, "left").withColumn(output, found)
    return joined.drop("_slice", "_before", "_of", "_at", "_carry")


def _cuts(df: DataFrame, group: str, order: list[str], heavy_rows: int) -> DataFrame | None:
    """Where the heavy groups are cut: one row each, None if there is none."""
    spark = df.sparkSession
    counts = df.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(ceil((total or 0) / tasks), heavy_rows)
    if most is None or most <= share:
        return None
    heavy = counts.filter(F.col("n") > share)
    kept = F.least(F.lit(_FINENESS), F.ceil(F.lit(_SAMPLED * _FINENESS) / share).cast("long"))
    picked = F.pmod(F.xxhash64(*order), F.lit(_FINENESS)) < kept
    rows = df.filter(picked).select(F.col(group).alias("of"), comparable(*order).alias("key"))
    # Equal keys fall on one side of every cut, so each is needed once.
    keys = rows.groupBy("of", "key").count().select("of", "key")
    listed = keys.join(F.broadcast(heavy), keys["of"].eqNullSafe(heavy["g"]))
    listed = listed.groupBy("g").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list("key")).alias("keys")
    )
    pieces = F.ceil(F.col("n") / share).cast("int")
    place = lambda i: (i * F.size("keys") / pieces).cast("int")
    chosen = F.transform(
        F.sequence(F.lit(1), pieces - 1), lambda i: F.get("keys", place(i))
    )
    cut = listed.select("g", F.array_distinct(chosen).alias("cuts"))
    return _blocks(spark, cut)


def _blocks(spark, cut: DataFrame) -> DataFrame:
    """The cuts of each group in blocks, so that a key is placed in two short steps."""
    rows = []
    for row in cut.collect():
        width = isqrt(len(row["cuts"])) + 1
        blocks = [row["cuts"][i : i + width] for i in range(0, len(row["cuts"]), width)]
        rows.append((row["g"], width, [block[0] for block in blocks], blocks))
    kinds = cut.schema
    keys = kinds["cuts"].dataType
    schema = T.StructType(
        [
            T.StructField("_of", kinds["g"].dataType),
            T.StructField("_width", T.IntegerType()),
            T.StructField("_heads", keys),
            T.StructField("_blocks", T.ArrayType(keys)),
        ]
    )
    return spark.createDataFrame(rows, schema)


def _sliced(df: DataFrame, group: str, order: list[str], cuts: DataFrame) -> DataFrame:
    """Rows with ``_slice``, the number of cuts not after them, and whether there are any cuts."""
    key = comparable(*order)
    upto = lambda some: F.size(F.filter(some, lambda c: c <= key))
    block = upto(F.col("_heads"))
    inside = upto(F.get(F.col("_blocks"), block - 1))
    place = F.when(block > 0, (block - 1) * F.col("_width") + inside).otherwise(0)
    joined = df.join(F.broadcast(cuts), df[group].eqNullSafe(cuts["_of"]), "left")
    cut = F.col("_width").isNotNull()
    return joined.select(
        *[df[f"`{c}`"] for c in df.columns],
        cut.alias("_cut"),
        F.when(cut, place).otherwise(0).alias("_slice"),
    )
