"""Harmonic packing of documents into sequences of a fixed capacity.

A piece is in class k if k of its size fill a sequence: its length is at most capacity / k
and more than capacity / (k + 1). Documents are cut into whole sequences and then at the
largest capacity / k that fits, so nearly all pieces fill their class exactly. Each
class's sequences take k pieces each, independently in every shard; what does not fill
a sequence moves on to a common shard of 64, and so on to a single one, after which at
most one unfinished sequence per class is left, and these are joined where they fit.

Null texts are empty: their piece is the closing id alone. One row is one document, also
if ids repeat or are null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.tables import landed, slices
from convoy.llm.tokens import default_path, encoder

CAPACITY = 2048
CLOSING = 1
# A rest shorter than this is not cut again.
LEAST = 64
# Shards that come together in a round.
TOGETHER = 64
_MERGED = 7


def cuts(length: int, capacity: int = CAPACITY, least: int = LEAST) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document, in order."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest >= least:
        k = -(-capacity // rest)
        pieces.append((capacity // k, k))
        rest -= capacity // k
    if rest:
        pieces.append((rest, capacity // rest))
    return pieces


def _pieces(path: str, capacity: int, least: int, with_ids: bool):
    closing = CLOSING.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows: list[tuple] = []
                for doc_id, ids in zip(
                    part.column("doc_id").to_pylist(), tool.encode(texts), strict=True
                ):
                    ids += closing
                    total, start = len(ids) // 4, 0
                    for length, kind in cuts(total, capacity, least):
                        own = ids[4 * start : 4 * (start + length)]
                        crc = zlib.crc32(own)
                        rows.append(
                            (doc_id, start, length, crc, total, kind, own if with_ids else None)
                        )
                        start += length
                columns = list(zip(*rows, strict=True)) or [()] * 7
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k", "ids"],
                )

    return run


def _id(step: int | Column, shard: Column, kind: Column, place: Column) -> Column:
    """A sequence's number, from where it was filled."""
    high = F.lit(step).cast("long") * (1 << 20) + shard
    return (high * (1 << 12) + kind) * (1 << 28) + place


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    least: int = LEAST,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset) per piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers, or null
    unless asked for. Sequences may hold up to 4095 classes, so capacity is below 4096.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(path or default_path(), capacity, least, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int, ids binary",
    )
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards))
    rest = pieces.withColumn("shard", shard)
    packed, step = [], 0
    while True:
        rest = landed(_numbered(rest), "pieces")
        whole = F.col("place") * F.col("k") + F.col("k") <= F.col("n")
        packed.append(
            rest.filter(whole).withColumn(
                "sequence_id", _id(step, F.col("shard"), F.col("k"), F.col("place"))
            )
        )
        rest = rest.filter(~whole).drop("place", "n", "offset")
        if shards == 1:
            break
        shards = -(-shards // TOGETHER)
        rest = rest.withColumn("shard", F.floor(F.col("shard") / TOGETHER).cast("long"))
        step = min(step + 1, _MERGED - 1)
    # At most one unfinished sequence per class: as many rows as there are classes.
    open_ = landed(_numbered(rest), "pieces")
    sizes = open_.groupBy("k").agg(F.sum("length").alias("size")).collect()
    bins: list[int] = []
    places: dict[int, tuple[int, int]] = {}
    for row in sorted(sizes, key=lambda r: (-r["size"], r["k"])):
        fit = next((i for i, used in enumerate(bins) if used + row["size"] <= capacity), None)
        if fit is None:
            bins.append(0)
            fit = len(bins) - 1
        places[row["k"]] = (fit, bins[fit])
        bins[fit] += row["size"]
    if places:
        joined = F.create_map(
            *[x for k, (i, base) in places.items()
              for x in (F.lit(k), F.struct(F.lit(i).alias("i"), F.lit(base).alias("base")))]
        )
        here = joined[F.col("k")]
        zero = F.lit(0)
        packed.append(
            open_.withColumn("sequence_id", _id(_MERGED, zero, zero, here["i"])).withColumn(
                "offset", F.col("offset") + here["base"]
            )
        )
    out = packed[0]
    for part in packed[1:]:
        out = out.unionByName(part)
    return out.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


def _numbered(pieces: DataFrame) -> DataFrame:
    """Each piece's sequence within its class and shard, and its offset there."""
    group = Window.partitionBy("k", "shard")
    row = F.row_number().over(group.orderBy("doc_id", "start", "length", "ids_crc32"))
    numbered = pieces.withColumn("n", F.count(F.lit(1)).over(group)).withColumn("row", row - 1)
    numbered = numbered.withColumn("place", F.floor(F.col("row") / F.col("k")).cast("long"))
    before = Window.partitionBy("k", "shard", "place").orderBy("row")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return numbered.withColumn("offset", offset).drop("row")
