"""Vector codes by equal-average search.

Vectors of whole numbers are cut into equal parts, and every part position has a codebook. A
part and an entry differ by at least the squared gap of their component sums over the
number of components. Entries are sorted by sum, and a search begins where the part's own sum
falls and goes outward on both sides; a side ends where that bound strictly exceeds the
best distance met, since an entry with an equal distance may still have the lower index.
Parts of a block are sorted by sum too, so neighbours look at the same entries.

Vectors that are null or hold null or non-finite components are left out. Shorter vectors
count as filled up with zeros to the longest, and that to a multiple of the parts. Repeated
rows are vectors of their own; rows without a vec_id are coded but are no first entries. With
fewer rows than entries a codebook is as short. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm import grid
from convoy.llm.tables import landed

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Parts that are searched for together, and entries that a search goes outward at once.
BLOCK, STRIDE = 256, 16
# Vectors that a step of a task holds.
STEP = 4096
# Labels with more than one in so many rows are summed up beside the shuffle, not through it.
HEAVY = 1000


class Codebook:
    """The entries of one part position, sorted by their sums."""

    def __init__(self, entries: np.ndarray, number: type):
        total = entries.sum(axis=1)
        self.order = np.argsort(total, kind="stable")
        self.sums = total[self.order]
        self.entries = entries[self.order].astype(number)
        self.norms = (self.entries * self.entries).sum(axis=1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of every part, and how many distances were taken."""
        total = parts.sum(axis=1).astype(np.int64)
        by_sum = np.argsort(total, kind="stable")
        entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        taken = 0
        for at in range(0, len(parts), BLOCK):
            rows = by_sum[at : at + BLOCK]
            entry[rows], distance[rows], some = self._block(parts[rows], total[rows])
            taken += some
        return entry, distance, taken

    def _block(self, x: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        dims, size = x.shape[1], len(self.sums)
        norms = (x * x).sum(axis=1)
        best = np.full(len(x), np.iinfo(np.int64).max)
        index = np.full(len(x), size)
        middle = int(np.searchsorted(self.sums, total[len(total) // 2]))
        # Entries between the sums of the block's parts come first, then both sides in turn.
        low = max(min(int(np.searchsorted(self.sums, total[0])), middle) - 1, 0)
        high = min(max(int(np.searchsorted(self.sums, total[-1])), middle) + 1, size)
        taken = self._look(x, norms, np.arange(len(x)), low, high, best, index)
        going = [np.arange(len(x)), np.arange(len(x))]
        while len(going[0]) or len(going[1]):
            for side in (0, 1):
                rows, edge = going[side], low - 1 if side == 0 else high
                if not len(rows) or not 0 <= edge < size:
                    going[side] = rows[:0]
                    continue
                gap = total[rows] - self.sums[edge]
                rows = going[side] = rows[gap * gap <= best[rows] * dims]
                if not len(rows):
                    continue
                if side == 0:
                    start, stop = max(low - STRIDE, 0), low
                    low = start
                else:
                    start, stop = high, min(high + STRIDE, size)
                    high = stop
                taken += self._look(x, norms, rows, start, stop, best, index)
        return index, best, taken

    def _look(self, x, norms, rows, start, stop, best, index) -> int:
        """Hold the entries from ``start`` to ``stop`` against the best ones so far."""
        far = norms[rows, None] - 2 * (x[rows] @ self.entries[start:stop].T)
        far += self.norms[start:stop]
        nearest = far.min(axis=1)
        own = np.where(far == nearest[:, None], self.order[start:stop], len(self.order)).min(axis=1)
        nearest = nearest.astype(np.int64)
        win = (nearest < best[rows]) | ((nearest == best[rows]) & (own < index[rows]))
        best[rows[win]], index[rows[win]] = nearest[win], own[win]
        return len(rows) * (stop - start)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            yield batch.slice(at, STEP)


def _coded(books: np.ndarray, number: type):
    """Nearest entries of the parts of a step: (vectors, codes, distances)."""
    tools = [Codebook(book, number) for book in books]
    width = books.shape[2]

    def run(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = grid.matrix(part.column("point"), len(tools) * width, number)
        found = [
            tool.nearest(x[:, width * p : width * (p + 1)])[:2] for p, tool in enumerate(tools)
        ]
        codes, far = (np.stack(some, axis=1) for some in zip(*found, strict=True))
        return x, codes, far

    return run


def _sums(books: np.ndarray, number: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, width = books.shape
        coded, sums = _coded(books, number), grid.Sums(parts * size, width)
        for part in _steps(batches):
            x, codes, _ = coded(part)
            for p in range(parts):
                sums.add(p * size + codes[:, p], x[:, width * p : width * (p + 1)])
        yield sums.batch()

    return run


def _final(books: np.ndarray, number: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _coded(books, number)
        for part in _steps(batches):
            _, codes, far = coded(part)
            text = ["".join([f"{c:02x}" for c in row]) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), part.column("label"), pa.array(text, pa.string()),
                 pa.array(far.sum(axis=1))],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def coded(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector.

    ``code`` has two hex digits a part, so ``entries`` is at most 256. The driver holds the
    codebooks; sums reach it as one row per entry and component.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = rows.filter(grid.finite("embedding"))
    label = rows.schema["label"].dataType.simpleString()
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    dims = parts * max(1, -(-(longest or 0) // parts))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("embedding"))
    points = rows.select(
        "vec_id", "label", F.concat(grid.whole("embedding", scale), zeros).alias("point")
    )
    number = grid.kind(grid.check_range(points, "point", dims), dims)
    points = landed(points.withColumn("point", F.col("point").cast("array<int>")), "points")
    seeds = points.filter("vec_id IS NOT NULL").orderBy("vec_id", "point")
    seeds = seeds.select("point").limit(entries).toArrow()
    if not seeds.num_rows:
        schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    width = dims // parts
    books = grid.matrix(seeds.column("point"), dims, np.int64).reshape(-1, parts, width)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    for _ in range(rounds):
        flat = books.reshape(-1, width)
        partial = points.select("point").mapInArrow(_sums(books, number), grid.SUMS)
        sums, counts = grid.summed(partial, len(flat), width)
        books = grid.floor_means(sums, counts, flat).reshape(books.shape)
    numbers = ",".join(map(str, books.reshape(-1).tolist()))
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    final = points.mapInArrow(
        _final(books, number), f"vec_id long, label {label}, code string, error long"
    )
    return with_label_error(landed(final, "codes")).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def with_label_error(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Add ``label_error``, the sum of ``error`` over equal labels.

    Labels with more than one in ``heavy`` rows are fewer than ``heavy``: their sums are
    broadcast. The rows of all others meet theirs in a shuffle that no label crowds.
    """
    sums = rows.groupBy(F.col("label").alias("same")).agg(
        F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")
    )
    sums = landed(sums, "labels")
    share = (sums.agg(F.sum("n")).first()[0] or 0) / heavy
    large = F.broadcast(sums.filter(F.col("n") > share).drop("n"))
    small = sums.filter(F.col("n") <= share).drop("n")
    same = F.col("label").eqNullSafe(F.col("same"))
    common = rows.join(large, same)
    rest = rows.join(large, same, "left_anti").join(small, same)
    return common.unionByName(rest).drop("same")
