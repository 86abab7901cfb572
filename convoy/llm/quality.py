"""Document quality by regularised quadratic discriminant analysis of text statistics.

Each class has a mean and a covariance shrunk towards a multiple of the identity; the
score is the calibrated difference of the two Gaussian log densities, computed from
Mahalanobis distances with Cholesky factors that are made once. Null texts are empty; one row
comes out per input row. Only the text is an input of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.folds import held_out, labelled
from convoy.llm.hashing import word_hashes
from convoy.llm.tables import flat, landed, lists, slices

# The model is fitted on at most so many labelled rows, those with the smallest hashes.
SAMPLE = 50_000
SHRINK = 0.1
ACCEPT = 0.7

_KINDS = {
    "lower": range(0x61, 0x7B), "upper": range(0x41, 0x5B), "digit": range(0x30, 0x3A),
    "space": [0x20, 0x09], "line": [0x0A], "stop": b".", "comma": b",;:", "shout": b"!",
    "ask": b"?", "bar": b"|", "sign": b"#$%&*@^~+=", "bracket": b"()[]{}<>", "slash": b"/\\_-",
    "quote": b"'\"`", "wide": range(0x80, 0x100),
}
_KIND = np.full(256, len(_KINDS), np.int64)
for _i, _bytes in enumerate(_KINDS.values()):
    _KIND[list(_bytes)] = _i
_LINE = np.ones(256, bool)
_LINE[:] = False
_LINE[0x0A] = True
FEATURES = [*_KINDS, "other", "words", "word_length", "variety", "line_length", "new_lines"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics, (texts, features): root shares of byte kinds, logs of lengths."""
    n, kinds = len(offsets) - 1, len(_KINDS) + 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    counts = np.bincount(owner * kinds + _KIND[data], minlength=n * kinds).reshape(n, kinds)
    shares = np.sqrt(counts / np.maximum(size, 1)[:, None])
    words, ends = word_hashes(data, offsets)
    n_words = np.diff(ends)
    lines, line_ends = word_hashes(data, offsets, _LINE)
    n_lines = np.diff(line_ends)
    letters = size - counts[:, 3] - counts[:, 4]
    return np.column_stack(
        (
            shares,
            np.log1p(n_words),
            np.log1p(letters / np.maximum(n_words, 1)),
            _distinct_share(words, ends),
            np.log1p(size / np.maximum(n_lines, 1)),
            _distinct_share(lines, line_ends),
        )
    )


def _distinct_share(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Distinct values among each text's values; 1 where there are none."""
    distinct = [len(np.unique(values[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    count = np.diff(ends)
    return np.where(count > 0, np.array(distinct) / np.maximum(count, 1), 1.0)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            x = statistics(*flat(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), lists(x.reshape(-1), np.full(len(x), x.shape[1]))],
                names=["doc_id", "x"],
            )


@dataclass
class Discriminant:
    """Two Gaussians over scaled statistics, and the calibration of their difference."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, shrink: float = SHRINK) -> Discriminant:
        centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = (x - centre) / scale
        means, factors = [], []
        for label in (0, 1):
            own = z[y == label]
            mean = own.mean(axis=0)
            spread = (own - mean).T @ (own - mean) / max(len(own) - 1, 1)
            level = max(np.trace(spread) / len(mean), 1e-3)
            spread = (1 - shrink) * spread + shrink * level * np.eye(len(mean))
            means.append(mean)
            factors.append(np.linalg.inv(np.linalg.cholesky(spread)))
        model = cls(centre, scale, means, factors)
        model._calibrate(x, y)
        return model

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density under class 1 minus that under class 0, per feature."""
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            distance = (((z - mean) @ factor.T) ** 2).sum(axis=1)
            density.append(np.log(np.diag(factor)).sum() - distance / 2)
        return np.clip((density[1] - density[0]) / x.shape[1], -50, 50)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.difference(x) + self.offset)))

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """A logistic curve over the difference, by Newton's method with a little ridge."""
        d = self.difference(x)
        design = np.column_stack((d, np.ones(len(d))))
        w = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            slope = design.T @ (p - y) + 1e-2 * (w - [1.0, 0.0])
            curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
            step = np.linalg.solve(curve, slope)
            w = w - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        self.slope, self.offset = max(float(w[0]), 1e-3), float(w[1])


def _scored(model: Discriminant | None, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, width)
            scores = np.full(len(x), 0.5) if model is None else model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"]
            )

    return run


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    shrink: float = SHRINK,
    accept: float = ACCEPT,
) -> DataFrame:
    """(doc_id, held_out, score, predicted); learned from labels of documents not held out.

    Without labels of both classes every score is 0.5.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = landed(texts.mapInArrow(_measured, "doc_id long, x array<double>"), "statistics")
    known = labelled(labels, "quality").filter(~held_out())
    train = measured.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = train.select("x", "y").toArrow()
    y = rows.column("y").to_numpy()
    model = None
    if len(set(y.tolist())) == 2:
        x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
        model = Discriminant.fit(x, y, shrink)
    scored = measured.mapInArrow(_scored(model, len(FEATURES)), "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= accept).cast("int").alias("predicted"),
    )
