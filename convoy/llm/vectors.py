"""Near-duplicate embeddings with an inverted multi-index.

Two codebooks, one per half of the vector, span a grid of cells. A vector lies in the
cell of its nearest codeword pair and visits cells in the order of their distance
(multi-sequence traversal) until a pair at the similarity threshold would be met with the
target recall; everything met is verified in double precision.

Vectors of different lengths never link. Each common length has an index of its own; the
vectors of any other length are one cell, compared as a whole.

Rows without a vec_id are left out, and repeated rows count once. Vectors that are null,
zero or not finite link with nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.graph import components
from convoy.llm.tables import landed, lists

COSINE = 0.9
# The codebooks are fitted on at most so many vectors, those with the smallest hashes.
SAMPLE = 20_000
# Vectors per cell aimed at, and the most codewords of a half.
PER_CELL = 32
CODEWORDS = 256
# Share of pairs exactly at the threshold that one of the two directions has to meet.
RECALL = 0.999
# The commonest lengths of vectors that get an index, if they have more vectors than a block.
INDEXES = 8
# Rows of a cell that one task compares with as many visitors.
BLOCK = 2048


class MultiIndex:
    """Two codebooks and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, codewords: int, cosine: float, recall: float):
        rng = np.random.default_rng(7)
        self.half = sample.shape[1] // 2
        self.books = [
            _codebook(part, codewords, rng)
            for part in (sample[:, : self.half], sample[:, self.half :])
        ]
        self.visits = self._calibrated(sample, cosine, recall, rng)

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        parts = (x[:, : self.half], x[:, self.half :])
        return [_squared(p, book) for p, book in zip(parts, self.books, strict=True)]

    def home(self, x: np.ndarray) -> np.ndarray:
        one, other = self.distances(x)
        return one.argmin(axis=1) * len(self.books[1]) + other.argmin(axis=1)

    def visited(self, x: np.ndarray) -> np.ndarray:
        """The ``visits`` nearest cells of each vector.

        The t nearest cells are among those whose ranks (p, q) in the two sorted
        lists, from 1, have p * q <= t.
        """
        one, other = self.distances(x)
        order = [np.argsort(d, axis=1, kind="stable") for d in (one, other)]
        ranked = [np.take_along_axis(d, o, 1) for d, o in zip((one, other), order, strict=True)]
        p, q = np.meshgrid(*[np.arange(d.shape[1]) for d in (one, other)], indexing="ij")
        near = (p + 1) * (q + 1) <= self.visits
        p, q = p[near], q[near]
        cells = order[0][:, p] * len(self.books[1]) + order[1][:, q]
        if len(p) <= self.visits:
            return cells
        total = ranked[0][:, p] + ranked[1][:, q]
        best = np.argpartition(total, self.visits - 1, axis=1)[:, : self.visits]
        return np.take_along_axis(cells, best, 1)

    def _calibrated(self, sample, cosine: float, recall: float, rng) -> int:
        """Cells to visit so that ``recall`` of the pairs at the threshold are met.

        Each vector gets a partner in a random direction at exactly that cosine.
        """
        x = sample[:2000]
        noise = rng.standard_normal(x.shape)
        noise -= (noise * x).sum(1, keepdims=True) * x
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        partner = self.home(cosine * x + sqrt(1 - cosine**2) * noise)
        one, other = self.distances(x)
        i, j = np.divmod(partner, len(self.books[1]))
        rows = np.arange(len(x))
        there = one[rows, i] + other[rows, j]
        ranks = np.array(
            [
                (np.searchsorted(np.sort(b), t - a, side="left")).sum()
                for a, b, t in zip(one, other, there, strict=True)
            ]
        )
        return int(np.quantile(ranks, recall, method="higher")) + 1


def _squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ book.T + (book**2).sum(1), 0)


def _codebook(x: np.ndarray, codewords: int, rng, rounds: int = 10) -> np.ndarray:
    """Lloyd's k-means from distinct rows."""
    rows = np.unique(x, axis=0)
    book = rows[rng.choice(len(rows), min(codewords, len(rows)), replace=False)]
    for _ in range(rounds):
        near = _squared(x, book).argmin(axis=1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(book))
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Unit vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _located(indexes: dict[int, MultiIndex]):
    """Home cell and visited cells of vectors; without an index there is one cell, 0."""

    def placed(part: pa.RecordBatch, index: MultiIndex | None, dims: int) -> pa.RecordBatch:
        if index is None:
            home, cells = np.zeros(part.num_rows, np.int64), np.zeros((part.num_rows, 1), np.int64)
        else:
            x = _matrix(part.column("embedding"), dims)
            home, cells = index.home(x), index.visited(x)
        visits = lists(cells.reshape(-1).astype(np.int32), np.full(len(cells), cells.shape[1]))
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(home.astype(np.int32)), visits],
            names=[*part.schema.names, "home", "visits"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths).tolist():
                some = batch.take(pa.array(np.flatnonzero(lengths == dims)))
                for at in range(0, some.num_rows, 1024):
                    yield placed(some.slice(at, 1024), indexes.get(dims), dims)

    return run


def _compare(cosine: float):
    """Links between the rows of a block and its visitors.

    A pair that meets in both directions counts for the visitor only, else for both.
    Of the links between them, a spanning forest goes on.
    """

    def run(key, own: pa.Table, visitors: pa.Table) -> pa.Table:
        ids, links, least = [], [], []
        dims = key[0].as_py()
        if own.num_rows and visitors.num_rows:
            x, y = _matrix(visitors.column("embedding"), dims), _matrix(own.column("embedding"), dims)
            a, b = visitors.column("rep").to_numpy(), own.column("rep").to_numpy()
            q, m = np.nonzero((x @ y.T >= cosine) & (a[:, None] != b[None, :]))
            if len(q):
                wa, wb = visitors.column("copies").to_numpy(), own.column("copies").to_numpy()
                home = visitors.column("home").to_numpy()
                seen = own.column("visits").combine_chunks().flatten().to_numpy()
                seen = seen.reshape(own.num_rows, -1)
                alone = np.concatenate(
                    [
                        ~(seen[m[i : i + 65536]] == home[q[i : i + 65536], None]).any(axis=1)
                        for i in range(0, len(q), 65536)
                    ]
                )
                node = np.concatenate((a, b))
                count = np.zeros(len(node), np.int64)
                np.add.at(count, q, wb[m])
                np.add.at(count, len(a) + m[alone], wa[q[alone]])
                label, before = node.copy(), None
                while before is None or (label != before).any():
                    before = label.copy()
                    low = np.minimum(label[q], label[len(a) + m])
                    np.minimum.at(label, q, low)
                    np.minimum.at(label, len(a) + m, low)
                told = np.flatnonzero((count > 0) | (label != node))
                ids, links, least = node[told], count[told], label[told]
        return pa.table(
            {
                "rep": pa.array(ids, pa.int64()),
                "links": pa.array(links, pa.int64()),
                "least": pa.array(least, pa.int64()),
            }
        )

    return run


def _fitted(
    groups: DataFrame, dims: int, count: int, cosine: float, sample: int, recall: float
) -> MultiIndex:
    """The index of the vectors of one length."""
    some = groups.filter(F.col("dims") == dims)
    picked = some.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("embedding")
    fitted = _matrix(picked.toArrow().column("embedding"), dims)
    codewords = max(2, min(CODEWORDS, round(sqrt(count / PER_CELL))))
    return MultiIndex(fitted, codewords, cosine, recall)


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    sample: int = SAMPLE,
    recall: float = RECALL,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Equal vectors are one from the start. A cell with many rows or visitors is
    compared in blocks, so a hot cell spreads over tasks.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull()).dropDuplicates()
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    zero = F.forall("embedding", lambda v: v == 0)
    usable = F.col("embedding").isNotNull() & F.coalesce(finite & ~zero, F.lit(False))
    groups = rows.filter(usable).groupBy("embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    groups = landed(groups.withColumn("dims", F.size("embedding")), "vectors")
    sizes = groups.groupBy("dims").count().filter((F.col("count") > BLOCK) & (F.col("dims") > 1))
    common = sizes.orderBy(F.desc("count"), "dims").limit(INDEXES).collect()
    indexes = {
        r["dims"]: _fitted(groups, r["dims"], r["count"], cosine, sample, recall) for r in common
    }
    placed = landed(
        groups.mapInArrow(
            _located(indexes),
            "embedding array<float>, rep long, copies long, dims int, home int, visits array<int>",
        ),
        "cells",
    )
    own = placed.withColumn("cell", F.col("home"))
    visitors = placed.select(
        "rep", "copies", "embedding", "dims", "home", F.explode("visits").alias("cell")
    )
    # As many rows as there are cells. Landed, so that Spark broadcasts them by their known size.
    at = ["dims", "cell"]
    blocks = lambda df, name: df.groupBy(*at).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name)
    )
    cells = landed(blocks(own, "parts").join(blocks(visitors, "turns"), at), "blocks")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    turn = F.pmod(F.xxhash64("rep"), F.col("turns")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = own.join(cells, at).withColumn("part", part).withColumn("turn", every("turns"))
    visitors = visitors.join(cells, at).withColumn("turn", turn).withColumn("part", every("parts"))
    keys = [*at, "part", "turn"]
    visitors = visitors.toDF(*visitors.columns)  # columns of its own beside those of ``own``
    met = own.drop("home").groupBy(*keys).cogroup(visitors.groupBy(*keys))
    found = landed(
        met.applyInArrow(_compare(cosine), "rep long, links long, least long"), "links"
    )
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("rep").alias("a"), F.col("least").alias("b")))

    known = groups.join(counts, "rep", "left").join(
        classes, groups["rep"] == classes["node"], "left"
    )
    known = known.select(
        F.col("embedding").alias("same"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    joined = rows.join(known, rows["embedding"] == known["same"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )
