"""Exact histogram of encoded lengths; suffix sums answer every context limit.

Null texts count as documents of no tokens. Other columns than the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.tables import landed, slices
from convoy.llm.tokens import default_path, encoder

# Lengths that one window holds when sums are carried from the longest to the shortest.
_BLOCK = 1024


def _lengths(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                lengths = np.array([len(ids) // 4 for ids in tool.encode(texts)], np.int64)
                length, count = np.unique(lengths, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(length), pa.array(count)], names=["length", "n_docs"]
                )

    return run


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(length, n_docs) over all documents; partial histograms are summed before the shuffle."""
    part = docs.select("text").mapInArrow(
        _lengths(path or default_path()), "length long, n_docs long"
    )
    return part.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per distinct length with what holds for that context limit.

    ``docs_at_least`` and ``tokens_at_least`` are suffix sums; ``tokens_within`` is the
    total if every document is cut to the limit, ``docs_cut`` how many are cut, and
    ``share_within`` the share of documents that fit. Between two lengths the total
    grows by the next ``docs_at_least`` a token, so the rows answer every limit.

    The histogram, one row per distinct length, is landed first: two sums read it, and
    texts are to be encoded once.
    """
    block = F.floor(F.col("length") / _BLOCK)
    base = landed(histogram, "lengths").withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    base = base.withColumn("block", block)
    totals = base.groupBy("block").agg(
        F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens")
    )
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    ever = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = totals.select(
        "block",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("docs").over(ever).alias("all_docs"),
        F.sum("tokens").over(ever).alias("all_tokens"),
    )
    here = Window.partitionBy("block").orderBy(F.desc("length"))
    summed = base.join(carried, "block").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.sum("n_docs").over(here) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum("n_tokens").over(here) + F.col("tokens_after")).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    return summed.select(
        "length",
        "n_docs",
        "n_tokens",
        "docs_at_least",
        "tokens_at_least",
        (F.col("docs_at_least") - F.col("n_docs")).alias("docs_cut"),
        (
            F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")
        ).alias("tokens_within"),
        (1 - (F.col("docs_at_least") - F.col("n_docs")) / F.col("all_docs")).alias("share_within"),
    )


def totals_within(table: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, tokens_within, docs_cut) for any context limits, from ``limit_table``."""
    asked = sorted(set(map(int, limits)))
    length, docs = F.col("length"), F.col("n_docs")
    sums = [
        F.struct(
            F.lit(limit).alias("context_limit"),
            F.sum(F.least(length, F.lit(limit)) * docs).alias("tokens_within"),
            F.sum(F.when(length <= limit, 0).otherwise(docs)).alias("docs_cut"),
        )
        for limit in asked
    ]
    return table.agg(F.array(*sums).alias("rows")).select(F.inline("rows"))


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that so large a share of documents does not exceed."""
    picked = [
        F.min(F.when(F.col("share_within") >= s - 1e-12, F.col("length"))).alias(str(i))
        for i, s in enumerate(shares)
    ]
    row = F.explode(
        F.array(*[F.struct(F.lit(s).alias("share"), F.col(str(i)).alias("length"))
                  for i, s in enumerate(shares)])
    )
    return table.agg(*picked).select(row.alias("r")).select("r.share", "r.length")
