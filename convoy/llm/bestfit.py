"""Best-fit packing with bounds that certify it.

Documents of at most a sequence are never cut; of a longer one the rest comes first and
whole sequences follow. Pieces shorter than a sequence are dealt over partitions by a hash.
Each partition packs its pieces by best-fit decreasing, and dual-feasible functions of its
lengths give a lower bound on its sequences. A partition that meets the bound is
certified. Partitions with a gap exchange the documents of their sequences that have room,
and certified ones add the emptiest of theirs; these are dealt anew and packed again, and a
result is taken where it needs fewer sequences. That goes on until the bound of the whole
table is met, nothing is gained, or ``rounds`` are over. What a round leaves is whole.

Null texts are empty: their piece is the closing id alone. One row is one document, also if
ids repeat or are null. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.tables import landed, slices
from convoy.llm.tokens import encoder, public_path

CAPACITY = 2048
CLOSING = 0
# Pieces that a task packs at once, about.
SHARD = 32_768
# Exchanges at most.
ROUNDS = 4
# The last of the step functions that bounds are taken from, alone and behind a threshold.
STEPS, STEPS_BEHIND = 24, 4

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, key long"
_PLACED = f"{_PIECE}, bin long, offset long, loose boolean"
# A number of a sequence: the round, the partition, the place there.
_ROUND, _PARTITION = 1 << 55, 1 << 23


def cuts(total: int, capacity: int = CAPACITY) -> list[int]:
    """The lengths of a document's pieces, in order."""
    if total <= capacity:
        return [total]
    rest = total % capacity
    return [rest] * (rest > 0) + [capacity] * (total // capacity)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece, by best-fit decreasing; equal lengths in their order.

    The bins that have a given room are listed under it, and the rooms that any bin has are
    the bits of one number, so the tightest room that suffices is its lowest bit from there.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    having: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = having[room].pop()
            if not having[room]:
                rooms ^= 1 << room
        else:
            room, number, opened = capacity, opened, opened + 1
        bins[i], offsets[i] = number, capacity - room
        if room > length:
            having[room - length].append(number)
            rooms |= 1 << (room - length)
    return bins, offsets


def least_bins(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """A lower bound on the bins for ``counts[x]`` pieces of each length x, the best of

    - f(e): lengths above capacity - e count as whole bins, those below e as nothing;
    - u(k): x counts floor((k + 1) x / capacity) / k, or x itself if that is no fraction;
    - u(k) behind f(e).

    Each is dual feasible: what fits into one bin never counts more than one. The sums are of
    whole numbers.
    """
    counts = np.asarray(counts, np.int64)
    x = np.arange(len(counts))
    present = np.flatnonzero(counts)
    if not len(present):
        return 0
    best = -(-int((counts * x).sum()) // capacity)
    # Prefix sums answer every threshold e at once.
    number = np.concatenate(([0], np.cumsum(counts)))
    weight = np.concatenate(([0], np.cumsum(counts * x)))
    e = np.unique(np.concatenate((present, capacity + 1 - present)))
    e = np.append(e[(e >= 1) & (e <= capacity // 2)], 1)
    large = number[-1] - number[capacity - e + 1]
    middle = weight[capacity - e + 1] - weight[e]
    best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(1, STEPS + 1):
        exact = (k + 1) * x % capacity == 0
        # In units of 1 / (k * capacity).
        value = np.where(exact, k * x, (k + 1) * x // capacity * capacity) * counts
        unit = k * capacity
        best = max(best, -(-int(value.sum()) // unit))
        if k <= STEPS_BEHIND:
            upto = np.concatenate(([0], np.cumsum(value)))
            inner = upto[capacity - e + 1] - upto[e]
            best = max(best, int((large + -(-inner // unit)).max()))
    return best


def _pieces(path: str, capacity: int, with_ids: bool):
    closing = CLOSING.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "key"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows: list[tuple] = []
                for doc_id, ids in zip(
                    part.column("doc_id").to_pylist(), tool.encode(texts), strict=True
                ):
                    ids += closing
                    start = 0
                    for piece, length in enumerate(cuts(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + length)]
                        kept = own if with_ids else None
                        rows.append((doc_id, piece, start, length, zlib.crc32(own), kept, key))
                        start += length
                        key += 1
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    return run


def _packed(step: int, capacity: int):
    """Best-fit decreasing over one partition, against what its pieces had before."""

    def run(part: pa.Table) -> pa.Table:
        part = part.combine_chunks().sort_by("key")
        lengths = part.column("length").to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        count = int(bins.max()) + 1
        numbers = step * _ROUND + part.column("partition")[0].as_py() * _PARTITION + bins
        before = part.column("bin")
        if before.null_count == 0 and len(pc.unique(before)) <= count:
            _, bins = np.unique(before.to_numpy(), return_inverse=True)
            numbers, offsets = before.to_numpy(), part.column("offset").to_numpy()
            count = int(bins.max()) + 1
        used = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
        gap = count > least_bins(np.bincount(lengths, minlength=capacity + 1), capacity)
        loose = used < capacity if gap else np.zeros(count, bool)
        loose[np.argmin(used)] = used.min() < capacity
        kept = [c for c in part.column_names if c not in ("bin", "offset", "partition")]
        out = part.select(kept)
        out = out.append_column("bin", pa.array(numbers, pa.int64()))
        out = out.append_column("offset", pa.array(offsets, pa.int64()))
        return out.append_column("loose", pa.array(loose[bins]))

    return run


def _round(pieces: DataFrame, step: int, partitions: int, by: str, capacity: int) -> DataFrame:
    dealt = F.pmod(F.xxhash64(by, F.lit(step)), F.lit(partitions))
    parts = pieces.withColumn("partition", dealt).groupBy("partition")
    return landed(parts.applyInArrow(_packed(step, capacity), _PLACED), "fitted")


def best_fit_packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    path: str | None = None,
    with_ids: bool = False,
    shard: int = SHARD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of every piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers, or null unless
    asked for. A partition holds about ``shard`` pieces.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = texts.mapInArrow(_pieces(path or public_path("byte_bpe_50k.json"), capacity, with_ids), _PIECE)
    pieces = landed(cut, "pieces")
    short = pieces.filter(F.col("length") < capacity)
    # One row per length below the capacity.
    lengths = {r["length"]: r["count"] for r in short.groupBy("length").count().collect()}
    counts = np.bincount(list(lengths), list(lengths.values()), capacity + 1).astype(np.int64)
    least = least_bins(counts, capacity)
    whole = pieces.filter(F.col("length") == capacity)
    done = [whole.withColumn("sequence_id", 2 * F.col("key") + 1).withColumn("offset", F.lit(0))]

    begins = F.count_if(F.col("offset") == 0)
    partitions, settled = ceil(counts.sum() / shard), 0
    fresh = short.withColumns({"bin": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    state = _round(fresh, 0, partitions, "key", capacity) if partitions else None
    for step in range(1, rounds + 1):
        if state is None or partitions == 1:
            break
        sums = state.groupBy("loose").agg(begins.alias("bins"), F.count(F.lit(1)).alias("n"))
        known = {r["loose"]: (r["bins"], r["n"]) for r in sums.collect()}
        bins, n = known.get(True, (0, 0))
        settled += known.get(False, (0, 0))[0]
        if not n or settled + bins <= least:
            break
        done.append(_numbered(state.filter(~F.col("loose"))))
        partitions = ceil(n / shard)
        state = _round(state.filter("loose").drop("loose"), step, partitions, "bin", capacity)
    if state is not None:
        done.append(_numbered(state))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


def _numbered(placed: DataFrame) -> DataFrame:
    return placed.withColumn("sequence_id", 2 * F.col("bin")).drop("bin", "loose")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences, lower bound on them) of a packed table, from one row per length."""
    lengths = packed.groupBy("length").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("offset") == 0).alias("bins")
    )
    rows = lengths.collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in rows:
        counts[row["length"]] = row["n"]
    return sum(r["bins"] for r in rows), least_bins(counts, capacity)
