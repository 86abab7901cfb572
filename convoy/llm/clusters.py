"""Exact k-means on whole numbers, with bounds from the centroids' history.

Every vector keeps its distance to each centroid as last evaluated, rounded down, and the
round of that. A centroid can have come no nearer than by the norm of its total
displacement since then, which the retained history of centroids gives; summed drifts of
the single rounds would loosen the bound more. The distance to the own centroid is
evaluated in every round. A centroid is passed over only if its loosened bound lies beyond
it for certain; all others are evaluated again, in whole numbers, so every assignment is
that of a full scan (ties to the smaller number).

The driver holds the history: rounds times centroids times components. Each round writes
the vectors with their bounds to the shared folder and removes the round before it.

Vectors that are null, of another length, or hold null or non-finite components are left
out. Repeated rows are vectors of their own. Rows without a vec_id are assigned like others
but are no first centroids. With fewer rows than centroids there are as many
centroids as rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm import grid
from convoy.llm.tables import lists, removed, written

CENTROIDS = 40
ROUNDS = 5
DIMS = 64
SCALE = 256
SALT = "2"
# Vectors that a step of a task holds.
STEP = 4096
# Bounds must differ by more than double arithmetic can be wrong.
_SLACK = 1e-9

_RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
    "centroid_sha256 string"
)
_STATE = "vec_id long, point array<int>, cluster int, distance long, seen array<float>, since array<byte>"


def _below(distance: np.ndarray) -> np.ndarray:
    """Square roots of whole numbers as single floats that are not above them."""
    return np.nextafter(np.sqrt(distance).astype(np.float32), np.float32(-1))


def evaluate(
    x: np.ndarray, history: np.ndarray, cluster: np.ndarray, seen: np.ndarray, since: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroids of the last round of ``history``, (cluster, distance, evaluations).

    ``seen`` and ``since`` are brought up to date in place.
    """
    now = len(history) - 1
    book = history[now]
    moved = np.sqrt(((history[now] - history) ** 2).sum(axis=2).astype(np.float64))
    own = ((x - book[cluster]) ** 2).sum(axis=1)
    at = np.arange(len(book))
    bound = seen - moved[since, at] * (1 + _SLACK)
    near = bound <= np.sqrt(own.astype(np.float64))[:, None] * (1 + _SLACK) + _SLACK
    near[np.arange(len(x)), cluster] = False
    best, distance = cluster.copy(), own.copy()
    rows = np.arange(len(x))
    seen[rows, cluster], since[rows, cluster] = _below(own), now
    for j in np.flatnonzero(near.any(axis=0)):
        some = np.flatnonzero(near[:, j])
        far = ((x[some] - book[j]) ** 2).sum(axis=1)
        seen[some, j], since[some, j] = _below(far), now
        win = (far < distance[some]) | ((far == distance[some]) & (j < best[some]))
        best[some[win]], distance[some[win]] = j, far[win]
    return best, distance, int(near.sum()) + len(x)


def _first(book: np.ndarray, number: type):
    """All distances to the first centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _steps(batches):
            x = grid.matrix(part.column("point"), book.shape[1], number)
            far = grid.squares(x, book.astype(number)).astype(np.int64)
            best = far.argmin(axis=1)
            distance = far[np.arange(len(x)), best]
            yield _state(part, best, distance, _below(far), np.zeros(far.shape, np.int8))

    return run


def _next(history: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = history.shape[1:]
        for part in _steps(batches):
            x = grid.matrix(part.column("point"), dims, np.int64)
            cluster = part.column("cluster").to_numpy().astype(np.int64)
            seen = grid.matrix(part.column("seen"), k, np.float32)
            since = grid.matrix(part.column("since"), k, np.int8)
            best, distance, _ = evaluate(x, history, cluster, seen, since)
            yield _state(part, best, distance, seen, since)

    return run


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            yield batch.slice(at, STEP)


def _state(part, best, distance, seen, since) -> pa.RecordBatch:
    sizes = np.full(len(best), seen.shape[1])
    return pa.RecordBatch.from_arrays(
        [
            part.column("vec_id"),
            part.column("point"),
            pa.array(best.astype(np.int32)),
            pa.array(distance),
            lists(seen.reshape(-1), sizes),
            lists(since.reshape(-1), sizes),
        ],
        names=["vec_id", "point", "cluster", "distance", "seen", "since"],
    )


def _sums(k: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = grid.Sums(k, dims)
        for part in _steps(batches):
            sums.add(
                part.column("cluster").to_numpy(),
                grid.matrix(part.column("point"), dims, np.int64),
            )
        yield sums.batch()

    return run


def clustered(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    salt: str = SALT,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector.

    The first centroids are the vectors with the smallest SHA-256 of ``<salt>:<vec_id>``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.filter(grid.finite("embedding") & (F.size("embedding") == dims))
    points = rows.select("vec_id", grid.whole("embedding", scale).alias("point"))
    peak = grid.check_range(points, "point", dims)
    points = points.withColumn("point", F.col("point").cast("array<int>"))
    text = F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string"))
    seeds = points.filter("vec_id IS NOT NULL").withColumn("h", F.sha2(text, 256))
    seeds = seeds.orderBy("h", "point").limit(centroids).select("point").toArrow()
    if not seeds.num_rows:
        return spark.createDataFrame([], _RESULT)
    book = grid.matrix(seeds.column("point"), dims, np.int64)
    history = book[None]
    first = _first(book, grid.kind(peak, dims))
    state, path = written(points.mapInArrow(first, _STATE), "clusters")
    for _ in range(rounds):
        partial = state.select("cluster", "point").mapInArrow(_sums(len(book), dims), grid.SUMS)
        sums, counts = grid.summed(partial, len(book), dims)
        book = grid.floor_means(sums, counts, book)
        history = np.concatenate((history, book[None]))
        before = path
        state, path = written(state.mapInArrow(_next(history), _STATE), "clusters")
        removed(spark, before)

    inertia = {r[0]: r[1] for r in state.groupBy("cluster").agg(F.sum("distance")).collect()}
    known = [
        (j, inertia.get(j, 0), sum(inertia.values()), _digest(row))
        for j, row in enumerate(book.tolist())
    ]
    # One row per centroid.
    about = F.broadcast(
        spark.createDataFrame(
            known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    )
    joined = state.select("vec_id", "cluster", "distance").join(about, "cluster")
    return joined.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _digest(numbers: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
